import random

import pytest

import corpus_pipeline
from seqflow.llm import decontaminate, simhash
from seqflow.llm.decontaminate import normal
from tests.llm.test_simhash import plain_fingerprint

from .data import documents, prose


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A corpus with planted junk, copies, shared passages and leaks."""
    rng = random.Random(7)
    rows, quality = [], {}
    items = [(i, prose(rng, 30)) for i in range(8)]
    passage = prose(rng, 80)
    for i in range(240):
        text, source = prose(rng, rng.randint(60, 140)), f"src{i % 5}"
        quality[i] = 1
        if i % 6 == 5:
            text, quality[i] = " ".join(w.upper() + "!!" for w in text.split()), 0
        elif i % 24 == 3:
            text = rows[i - 3][1]  # an exact copy of a clean one
        elif i % 24 == 8:
            text = text + "\n" + passage + "\n" + prose(rng, 40)
        elif i % 24 == 10:
            text = text + " " + items[i // 24 % 8][1] + " " + prose(rng, 20)
        rows.append((i, text, "en", source, len(text)))
    d = str(tmp_path_factory.mktemp("corpus"))
    documents(spark, rows, extra=False).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, q, 0) for i, q in quality.items()], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, rows, quality, items, passage


def test_stages_take_effect_and_keep_clean_documents(spark, folder):
    d, rows, quality, items, passage = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    ids, before = [set(range(240))], {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}  # what the last of these stages is given
        docs = corpus_pipeline.written(stage(spark, docs, d), f"test-{name}")
        assert docs.dtypes == spark.read.parquet(f"{d}/documents.parquet").dtypes
        ids.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    accepted, single, cut, clean = ids[1:]
    assert sum(quality[i] for i in ids[0] - accepted) == 0 and len(accepted - {i for i, q in quality.items() if q}) <= 2
    assert accepted - single == {i for i in accepted if i % 24 == 3}
    assert cut == single
    # an item that two documents hold is a short repeated passage, which the stage before may have cut from the second
    leaked = {i for i in cut if any(normal(t) in normal(before[i]) for _, t in items)}
    assert len(leaked) >= 8 and cut - clean == leaked
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    holders = [i for i in sorted(clean) if " ".join(passage.split()[:60]) in " ".join(texts[i].split())]
    assert len(holders) == 1
    assert all(texts[i] == rows[i][1] for i in clean if i % 24 not in (8, 10))
    assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())


def test_run_returns_the_mix(spark, folder):
    d, *_ = folder
    got = corpus_pipeline.run(spark, d).toPandas()
    assert list(got.columns) == ["doc_id", "source", "size", "source_size", "target", "taken"]
    assert (got["taken"] <= 2 * got["size"]).all() and got["taken"].sum() > 0
    for _, part in got.groupby("source"):
        assert abs(part["taken"].sum() - part["target"].iloc[0]) <= 96


def test_empty_tables(spark, folder, tmp_path):
    d, *_ = folder
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{d}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_contract():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "substring_dedup", "decontamination", "mix_sources"]
    assert (corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.MAX_BITS) == (3, 2)
    assert simhash.WIDTH == 64 and decontaminate.Q == 8
    assert plain_fingerprint("") == 0
