import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from seqflow.llm import packing, word_ids
from seqflow.llm.queries import WORD_BPE

from .data import documents, edge_rows, prose

PATH = public_tokenizers.path(WORD_BPE)


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    return edge_rows() + [(i, prose(rng, rng.choice([3, 40, 300, 900, 5000])), "en", "s", 0) for i in range(120)]


def brute(sizes, capacity):
    """The levels of the open windows after placing `sizes`, each choice by the whole sum of squares."""
    levels, chosen = [], []
    for s in sizes:
        best = None
        for at in [*sorted(range(len(levels)), key=lambda i: -levels[i]), None]:
            new = levels + [s] if at is None else [h + s if i == at else h for i, h in enumerate(levels)]
            if max(new) > capacity:
                continue
            counts = np.bincount([h for h in new if h < capacity], minlength=1)
            total = int((counts ** 2).sum())
            if best is None or total < best[0]:
                best = (total, new, 0 if at is None else levels[at])
        levels = [h for h in best[1] if h < capacity]
        chosen.append(best[2])
    return sorted(levels), chosen


@pytest.mark.parametrize("capacity", [8, 37, 64])
def test_levels_by_brute_force(capacity):
    rng = random.Random(capacity)
    sizes = [rng.randint(1, capacity - 1) for _ in range(300)]
    w, chosen = packing.Windows(capacity, 10**9, lambda window: None), []
    for s in sizes:
        chosen.append(w.level(s))
        w.place((None, 0, bytes(4 * s)))
    levels, expected = brute(sizes, capacity)
    assert chosen == expected
    assert sorted(h for h, n in w.at.items() for _ in n) == levels
    assert (w.twice[:capacity] == 2 * np.bincount(levels, minlength=capacity)).all()


def test_settle_bounds_the_open_windows():
    closed = []
    w = packing.Windows(64, 10, closed.append)
    for i in range(500):
        w.place((i, 0, bytes(4 * 33)))
        assert w.open <= 10
    w.finish()
    sizes = [sum(len(p[2]) // 4 for p in c) for c in closed]
    assert sum(sizes) == 500 * 33 and sizes.count(64) >= len(sizes) - 6 and all(s & (s - 1) == 0 for s in sizes)


def check(got, docs, tokenizer, capacity):
    """Every id in one piece, sequences without a gap, no padding."""
    assert len(got.groupby("sequence_id")) == got["sequence_id"].nunique()
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        ends = s["length"].cumsum()
        assert (s["offset"] == ends - s["length"]).all() and (s["sequence_tokens"] == ends.iloc[-1]).all()
        n = int(ends.iloc[-1])
        assert n == capacity or (n < capacity and n & (n - 1) == 0)
    assert (got["ids"].map(len) == 4 * got["length"]).all() and (got["length"] > 0).all()
    own = sorted((b"".join(g.sort_values("start")["ids"]) for _, g in got.groupby("doc_id")), key=lambda b: (len(b), b))
    expected = {}
    for key, text in docs:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
        expected.setdefault(key, []).append(ids)
    for key, g in got.groupby("doc_id", dropna=False):
        texts = expected.pop(None if key != key else int(key))
        assert sum(g["length"]) == sum(len(t) // 4 for t in texts)
        if len(texts) == 1:
            assert b"".join(g.sort_values("start")["ids"]) == texts[0] and (g["doc_tokens"] == len(texts[0]) // 4).all()
    assert not expected and own


@pytest.mark.parametrize("capacity", [64, 4096])
def test_pieces(spark, rows, tokenizer, capacity):
    docs = documents(spark, rows).repartition(3)
    df = packing.pack_documents(docs, PATH, capacity=capacity, max_open=20)
    check(df.toPandas(), [(r[0], r[1]) for r in rows], tokenizer, capacity)


def test_query_checksums(spark, tokenizer):
    from seqflow.llm.queries import op11_packing

    sf = "/root/testdata/sf0.001"
    got = op11_packing(spark, sf).toPandas()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    assert set(got["doc_id"]) == set(texts)
    for doc, g in got.groupby("doc_id"):
        ids = np.array(tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids + [2], "<u4")
        assert (g["doc_tokens"] == len(ids)).all() and g["length"].sum() == len(ids)
        for r in g.itertuples():
            assert zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32


def test_few_documents_are_cut(spark, rows):
    """Documents that fit a sequence are cut only where windows are settled at the end."""
    got = packing.pack_documents(documents(spark, rows).coalesce(1), PATH).toPandas().dropna(subset=["doc_id"])
    pieces = got[got["doc_tokens"] < 4096].groupby("doc_id").size()
    assert (pieces > 1).mean() < 0.35


def test_ids_of_single_characters_and_odd_words(tokenizer):
    with open(PATH, encoding="utf-8") as f:
        words = word_ids.WordIds(f.read(), keep=500)
    rng = random.Random(5)
    texts = [f"A{chr(c)}b{chr(c)}.'s X" for c in [*range(1, 0x3100), 0x1F600, 0xFB01]]
    texts += ["It's WE'LL I'd!'s don't'T", "<|endoftext|> a", "H̱É İi̇", None, "", "  ", "x" * 500]
    texts += ["".join(rng.choice("aBé.,'!1 \n\t́\x1c") for _ in range(60)) for _ in range(300)]
    array = pa.array(texts)
    for at in (0, 7, len(texts) - 300):
        ids, bounds = word_ids.encode(array[at:], words)
        for i, t in enumerate(texts[at:]):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids, repr(t)


def test_empty_table(spark):
    assert packing.pack_documents(documents(spark, []), PATH).count() == 0
