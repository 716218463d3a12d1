import math
import random
import sys
import zlib
from collections import Counter

import numpy as np
import pytest

from seqflow.llm import lm

from .data import documents, edge_rows, prose

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def words(text):
    return (text or "").encode().lower().split()


def corpus():
    rng = random.Random(9)
    return edge_rows() + [(i, prose(rng, rng.randint(5, 250)), "en", "s", 0) for i in range(250)]


def expected(rows):
    counts, n_docs = Counter(), 0
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    for i, t, *_ in rows:
        if not held(i):
            counts.update(words(t))
            n_docs += 1
    total, kinds = sum(counts.values()) + n_docs, len(counts) + (n_docs > 0)
    out = []
    for i, t, *_ in rows:
        c = [counts[w] for w in words(t)] + [n_docs]
        out.append((i, held(i), len(c), sum(x > 0 for x in c), total, round(sum(math.log10((x + 1) / (total + kinds + 1)) for x in c), 4)))
    return out


@pytest.mark.parametrize("frequent", [1 << 18, 20])
def test_base_scores_match_brute_force(spark, frequent):
    rows = corpus()
    got = lm.score_documents(documents(spark, rows), frequent=frequent, rounds=1, least_windows=0).collect()
    mine = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got]
    assert sorted(map(repr, mine)) == sorted(map(repr, expected(rows)))
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)


def network(seed=1):
    rng = np.random.default_rng(seed)
    size = max(lm.read_ranks(TOKENIZER).values()) + 1
    unigram = np.zeros(size)
    unigram[rng.choice(size, 3000, replace=False)] = rng.integers(1, 500, 3000)
    classes = lm.Classes(size, unigram)
    classes.fit_pairs(rng.integers(0, 3, (lm.INPUTS, lm.INPUTS)).astype(float), rng.integers(0, 5, lm.INPUTS).astype(float),
                      rng.integers(0, 5, lm.INPUTS).astype(float), rng.integers(0, 2, (lm.INPUTS, lm.INPUTS)).astype(float), 50)
    w = lm.new_weights()
    for k in w:
        w[k] = w[k] + 0.1 * rng.standard_normal(w[k].shape).astype(np.float32)
    return lm.Network(w, classes), size


def test_each_subword_is_scored_once_from_its_own_past():
    net, size = network()
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, size, n) for n in (0, 1, 5, 23, 24, 25, 47, 48, 200)]
    got = net.log_probs(np.concatenate(texts), np.array([len(t) for t in texts]))
    c = net.classes
    for t, g in zip(texts, got):
        ids = [size] * (lm.BACK + 1) + t.tolist() + [size + 1]
        total = 0.0
        for pos in range(lm.BACK + 1, len(ids)):
            first = (pos - lm.BACK - 1) // lm.STEP * lm.STEP  # the window's first input
            past = ids[first:pos]
            x = net.e[c.row[past]]
            q, k, v = x[-1] @ net.w["q"] * lm.DIM ** -0.5, x @ net.w["k"], x @ net.w["v"]
            s = k @ q + net.w["age"][np.arange(len(past))[::-1]]
            p = np.exp(s - s.max())
            h = x[-1] + p / p.sum() @ v
            h = h + np.maximum(h @ net.w["w1"] + net.w["b1"], 0) @ net.w["w2"]
            row = c.row[past[-1]]
            j, o = divmod(int(c.outcome[ids[pos]]), lm.SLOTS)
            for lo, goal in ((h @ net.w["wg"] + net.group[row], j), (h @ net.w["ws"][j] + net.slot[j][row], o)):
                total += lo[goal] - np.log(np.exp(lo).sum())
            total += c.rare[ids[pos]]
        assert abs(total - g) < 1e-2 + 1e-4 * abs(total)


def test_probabilities_add_up_to_one():
    net, size = network(3)
    c = net.classes
    assert np.allclose(np.exp(c.group).sum(1), 1, atol=1e-4) and np.allclose(np.exp(c.slot).sum(2), 1, atol=1e-4)
    assert sorted(c.number) == list(range(lm.INPUTS))
    rare = np.exp(c.rare[:size][c.row[:size] == 1])
    assert abs(rare.sum() - 1) < 1e-3


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) + 0.1 * rng.standard_normal(v.shape) for k, v in lm.new_weights().items()}
    base = rng.standard_normal((lm.INPUTS, lm.GROUPS)), rng.standard_normal((lm.GROUPS, lm.INPUTS, lm.SLOTS))
    x, y = rng.integers(0, lm.INPUTS, (3, lm.WINDOW)), rng.integers(-1, lm.INPUTS, (3, lm.STEP))
    _, g = lm.gradients(w, *base, x, y)
    for n in w:
        for _ in range(4):
            i = tuple(rng.integers(0, s) for s in w[n].shape)
            i = (x[0, i[0] % lm.WINDOW], i[1]) if n == "E" else i
            old = w[n][i]
            w[n][i] = old + 1e-5
            up, _ = lm.gradients(w, *base, x, y)
            w[n][i] = old - 1e-5
            down, _ = lm.gradients(w, *base, x, y)
            w[n][i] = old
            assert abs((up - down) / 2e-5 - g[n][i]) < 1e-6


def test_gradients_where_exponentials_leave_the_range():
    """Scores and logits of hundreds: the same gradients as in double precision, nothing infinite."""
    rng = np.random.default_rng(3)
    w = {k: v * 60 if k in ("q", "k") else v for k, v in lm.new_weights().items()}
    base = [(400 * rng.standard_normal(s)).astype(np.float32) for s in ((lm.INPUTS, lm.GROUPS), (lm.GROUPS, lm.INPUTS, lm.SLOTS))]
    x, y = rng.integers(0, lm.INPUTS, (5, lm.WINDOW)), rng.integers(-1, lm.INPUTS, (5, lm.STEP))
    _, g = lm.gradients(w, *base, x, y)
    _, exact = lm.gradients({k: v.astype(float) for k, v in w.items()}, *(b.astype(float) for b in base), x, y)
    assert all(np.isfinite(g[k]).all() and np.allclose(g[k], exact[k], atol=1e-3 * max(1, abs(exact[k]).max())) for k in w)
    _, g = lm.gradients(w, *base, x, np.full_like(y, -1))  # no target counts
    assert all(not g[k].any() for k in w)


def test_a_step_of_training_is_few_array_operations():
    """All groups are multiplied at once; a softmax and products for each by itself took 609 calls."""
    rng = np.random.default_rng(6)
    base = np.zeros((lm.INPUTS, lm.GROUPS), np.float32), np.zeros((lm.GROUPS, lm.INPUTS, lm.SLOTS), np.float32)
    x, y = rng.integers(0, lm.INPUTS, (lm.BATCH_WINDOWS, lm.WINDOW)), rng.integers(0, lm.INPUTS, (lm.BATCH_WINDOWS, lm.STEP))
    w, calls = lm.new_weights(), Counter()
    before = sys.getprofile()
    sys.setprofile(lambda frame, event, arg: calls.update([event]))
    try:
        lm.gradients(w, *base, x, y)
    finally:
        sys.setprofile(before)
    assert calls["call"] + calls["c_call"] < 400


def test_words_encoded_together_are_as_encoded_apart():
    coder = lm.Subwords(lm.read_ranks(TOKENIZER))
    for words in ([], [b"the"], [b"the", b"quartz", "\u00fcber".encode(), b"a-b_c", b"x" * 40], [b"two\xc2\xa0parts", b"of"], [b"y" * 600, b"and"]):
        flat, size = coder.encode_all(words)
        each = [coder.encode(w) for w in words]
        assert size.tolist() == [len(x) for x in each] and flat.tolist() == [i for x in each for i in x]


def test_training_lowers_the_held_out_loss():
    rng = np.random.default_rng(5)
    base = np.zeros((lm.INPUTS, lm.GROUPS), np.float32), np.zeros((lm.GROUPS, lm.INPUTS, lm.SLOTS), np.float32)

    def windows(n):
        lang = rng.integers(0, 4, n)[:, None]
        ids = 2 + lang * 20 + rng.integers(0, 20, (n, lm.WINDOW + 1))
        return ids[:, :-1], ids[:, lm.BACK + 1:]

    test = windows(200)
    before, _ = lm.gradients(lm.new_weights(), *base, *test)
    w, n = lm.train(lm.new_weights(), *base, (windows(48) for _ in range(150)), 0.01)
    after, _ = lm.gradients(w, *base, *test)
    assert n == 7200 and after < before - 1.5  # from near log(1024) towards log(20)


def test_empty_and_untrained(spark):
    assert lm.score_documents(documents(spark, [])).count() == 0
    held = [i for i in range(100) if lm.is_held_out(i)][:3]
    got = lm.score_documents(documents(spark, [(i, "some text", "en", "s", 0) for i in held])).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got] == [(3, 0, 0, 0.0)] * 3
    assert all(np.isfinite(r["score"]) for r in got)


def test_every_training_subword_is_a_target_once(spark):
    """Short texts, texts of common words and long ones: each gives as many targets as it has subwords, and its end."""
    rng = random.Random(4)
    rows = edge_rows() + [(i, prose(rng, n), "en", "s", 0) for i, n in enumerate((0, 1, 2, 3, 14, 15, 16, 60, 400, 3000))] + [(50, "the of and to in", "en", "s", 0)]
    ranks = lm.read_ranks(TOKENIZER)
    size = max(ranks.values()) + 1
    shared = spark.sparkContext.broadcast(("all-targets", ranks))
    classes = lm.Classes(size, np.random.default_rng(3).integers(0, 900, size).astype(float))
    docs = documents(spark, rows, extra=False).selectExpr("doc_id", "text AS t")
    got = Counter()
    pieces = lm.training_pieces(docs, shared, classes).withColumn("shard", lm.F.pmod("key", lm.F.lit(3)).cast("int"))
    pieces = lm.written(pieces.repartition(3, "shard").sortWithinPartitions("shard", "key"), "test-pieces")
    for b in pieces.toArrow().to_batches():
        x, y = lm.cut_windows(b)
        for i, j in zip(*np.nonzero(y >= 0)):
            got[tuple(x[i, :lm.BACK + 1 + j].tolist()), int(y[i, j])] += 1
    coder, expected, across = lm.Subwords(ranks), Counter(), Counter()
    lead = {i for t, i in ranks.items() if t[:1] == b" "}
    for i, t, *_ in rows:
        if not lm.is_held_out(i):
            ids = [s for w in words(t) for s in coder.encode(w)]
            stream = [0] * (lm.BACK + 1) + [int(classes.row[s]) for s in ids] + [0]
            starts = [s in lead for s in ids] + [True]
            for k in range(len(ids) + 1):
                at = k // lm.STEP * lm.STEP
                expected[tuple(stream[at:k + lm.BACK + 1]), stream[k + lm.BACK + 1]] += 1
                if starts[k]:
                    across[stream[k + lm.BACK], stream[k + lm.BACK + 1]] += 1
    assert got == expected
    table = lm.across_counts(pieces)
    assert {(int(a), int(b)): int(table[a, b]) for a, b in zip(*np.nonzero(table))} == across


def test_shards_do_not_depend_on_batches():
    import pyarrow as pa

    b = pa.RecordBatch.from_pydict({"shard": pa.array([0] * 7 + [2] * 3 + [5] * 9, pa.int32()), "v": list(range(19))})
    cuts = ([b], [b.slice(0, 4), b.slice(4, 1), b.slice(5, 5), b.slice(10)])
    a, c = ([(s, [x.column("v").to_pylist() for x in own]) for s, own in lm._blocks(iter(i), 4)] for i in cuts)
    assert a == c == [(0, [[0, 1, 2, 3], [4, 5, 6]]), (2, [[7, 8, 9]]), (5, [[10, 11, 12, 13], [14, 15, 16, 17], [18]])]
