import random
import re
from collections import Counter

import numpy as np
import pytest

from seqflow.llm import collocations as co

from .data import documents, edge_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(rows):
    f = Counter()
    for r in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (r[1] or "").translate(LOWER)):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            f.update((r[2] or "und", *w[i:i + k]) for i in range(len(w)) for k in range(1, 5) if i + k <= len(w))
    return f


def brute(rows, least, top, scale=2_000_000, cover=80):
    f = brute_counts(rows)
    n = Counter()
    for p, c in f.items():
        if len(p) == 2:
            n[p[0]] += c
    cands = {p: c for p, c in f.items() if len(p) > 2 and c >= least}
    covered = {}
    for p, c in cands.items():
        w = p[1:]
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                q = (p[0], *w[i:i + size])
                covered[q] = max(covered.get(q, 0), c)
    out = []
    for lang in n:
        mine = []
        for p, a in cands.items():
            if p[0] != lang or 100 * covered.get(p, 0) >= cover * a:
                continue
            score, _, left, right = min((scale * a // (f[p[:k + 1]] + f[lang, *p[k + 1:]]), k, f[p[:k + 1]], f[lang, *p[k + 1:]]) for k in range(1, len(p) - 1))
            mine.append((-score, -a, " ".join(p[1:]).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(mine)[:top])]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(13)
    vocab = [f"w{i}" for i in range(25)] + ["Émile", "x y", "z\x1cq", "\U0001f600", "a", "A"]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    out = edge_rows()
    for i in range(250):
        words = rng.choices(vocab, weights, k=rng.randint(0, 120)) + [f"rare{rng.randint(0, 999)}"]
        words += rng.choice([["new", "york", "city", "hall"], ["san", "jose"], ["of", "the"] * 9, []])
        rng.shuffle(words) if i % 3 == 0 else None
        text = "".join(w + rng.choice([" ", " ", " ", "\t ", ", ", ".", "\n", "  "]) for w in words)
        out.append((i, text, rng.choice(["en", "en", "en", "de", None, "und"]), "s", 0))
    return out


@pytest.mark.parametrize("budget", [1 << 22, 2000, 60])
def test_counts_by_brute_force(spark, rows, budget, monkeypatch):
    monkeypatch.setattr(co, "CHUNK_BYTES", 3000)
    nodes, totals = co.phrase_counts(documents(spark, rows).repartition(3), 5, budget)
    expected = {(p[0], " ".join(p[1:])): c for p, c in brute_counts(rows).items() if c >= 5}
    got = nodes.collect()
    assert len(got) == len(expected)
    assert {(r["lang"], r["phrase"]): r["f"] for r in got} == expected
    assert all(r["size"] == r["phrase"].count(" ") + 1 for r in got)


@pytest.mark.parametrize("least, top, budget", [(5, 10_000, 500), (8, 7, 1 << 22)])
def test_phrases_by_brute_force(spark, rows, least, top, budget):
    got = co.collocations(documents(spark, rows), least=least, top=top, budget=budget).collect()
    expected = brute(rows, least, top)
    assert sorted(map(tuple, got)) == expected and len(expected) > 20


def test_products_past_64_bits(spark, rows):
    scale = 10**17
    got = co.collocations(documents(spark, rows), least=8, scale=scale).collect()
    assert sorted(map(tuple, got)) == brute(rows, 8, 2000, scale)


def test_wide_word_lists_are_counted_alike():
    rng = np.random.default_rng(1)
    words = [f"v{i}" for i in range(60_000)]
    codes = rng.integers(0, 60_001, 5000).astype("<u4")
    codes[:2500] = codes[2500:]
    s = co.Suffixes("en", words, codes.tobytes(), np.full(co.BITS // 32, (1 << 32) - 1, np.uint32), co.Listed())
    at, counts = s.count()
    expected = Counter(zip(*(w.tolist() for w in s.at), strict=True))
    assert dict(zip(zip(*(w.tolist() for w in at), strict=True), counts.tolist(), strict=True)) == dict(expected)
    assert s.base ** 4 > 1 << 63


def test_empty_table(spark):
    assert co.collocations(documents(spark, [])).count() == 0
    assert co.collocations(documents(spark, edge_rows()[1:4])).count() == 0
