import random

import numpy as np
import pytest

from seqflow.llm import cotrain

from .data import documents, edge_rows, prose


def corpus():
    rng = random.Random(4)
    rows, quality = edge_rows(), {}
    for i in range(500):
        text = prose(rng, rng.randint(20, 120))
        bad = rng.random() < 0.25
        if bad:
            kind = rng.randrange(3)
            text = " ".join(w + "%%%" for w in text.split()) if kind == 0 else text.upper() if kind == 1 else " ".join([text.split()[0]] * 60)
        quality[i] = int(not bad)
        rows.append((i, text, "en", f"src{i % 5}" if rng.random() < 0.5 else ("junk" if bad else "good"), len(text)))
    return rows, quality


def labels(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id long, quality int")


def test_held_out_accuracy(spark):
    rows, quality = corpus()
    marked = [(i, q) for i, q in quality.items() if i % 2] + [(i, 1 - q) for i, q in list(quality.items())[:3] if i % 2 and not q] + [(None, 1), (3000, 0), (5, None)]
    docs = documents(spark, rows)
    got = cotrain.score_documents(docs, labels(spark, marked)).collect()
    assert len(got) == len(rows)
    test = [r for r in got if r["doc_id"] in quality and r["doc_id"] % 2 == 0]
    right = np.mean([r["accepted"] == bool(quality[r["doc_id"]]) for r in test])
    assert right >= 0.95
    good = [r for r in test if quality[r["doc_id"]]]
    assert np.mean([r["accepted"] for r in good]) >= 0.97
    assert all(0 <= r[c] <= 1 for r in got for c in ("p_text", "p_meta", "score"))
    kept = cotrain.accepted(docs, labels(spark, marked))
    assert kept.columns == docs.columns
    assert sorted(map(repr, (r["doc_id"] for r in kept.collect()))) == sorted(repr(r["doc_id"]) for r in got if r["accepted"])


def test_views_hand_each_other_confident_labels():
    rng = np.random.default_rng(1)

    def draw(n):
        y = (rng.random(n) < 0.7).astype(float)
        return y, (y[:, None] * 2 - 1) * 1.2 + rng.standard_normal((n, 6)), (y[:, None] * 2 - 1) * 1.0 + rng.standard_normal((n, 4))

    y, a, b = draw(80)
    fit, held = cotrain.held_out(y, np.arange(80))
    yp, pa, pb = draw(800)
    yt, ta, tb = draw(2000)
    alone = cotrain.CoTrained(a, b, y, fit, held, cotrain.LocalPool(pa[:0], pb[:0]))
    both = cotrain.CoTrained(a, b, y, fit, held, cotrain.LocalPool(pa, pb))
    assert min(both.handed) > 20
    acc = [np.mean((m.scores(ta, tb)[:, 2] >= 0.5) == (yt > 0)) for m in (alone, both)]
    assert acc[1] >= acc[0] - 0.01 and acc[1] > 0.95


@pytest.mark.parametrize("pairs, accepted", [([], True), ([(i, 1) for i in range(60)], True), ([(i, 0) for i in range(60)], False)])
def test_one_class_or_no_labels(spark, pairs, accepted):
    rows, _ = corpus()
    got = cotrain.score_documents(documents(spark, rows[:100]), labels(spark, pairs)).collect()
    assert len(got) == 100 and {r["accepted"] for r in got} == {accepted}


def test_empty_documents(spark):
    assert cotrain.score_documents(documents(spark, []), labels(spark, [(1, 1), (2, 0)])).count() == 0


def test_held_out_has_a_quarter_of_each_class():
    y = np.array([0.0] * 3 + [1.0] * 57 + [2.0])
    for seed in range(50):
        fit, held = cotrain.held_out(y, np.arange(61) + 100 * seed)
        assert [int(held[y == c].sum()) for c in (0, 1, 2)] == [1, 15, 1] and [int(fit[y == c].sum()) for c in (0, 1, 2)] == [2, 42, 1]


@pytest.mark.parametrize("n_bad", [1, 2, 3])
def test_scarce_class_is_learned(spark, n_bad):
    rows, quality = corpus()
    bad = [i for i, q in quality.items() if not q][:n_bad]
    good = [i for i, q in quality.items() if q][:57]
    got = cotrain.score_documents(documents(spark, rows), labels(spark, [(i, 0) for i in bad] + [(i, 1) for i in good])).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len({round(r["score"], 9) for r in got}) > 10  # no constant stands in for the model
    assert np.mean([by_id[i]["score"] for i in bad]) < np.mean([by_id[i]["score"] for i in good])


def test_thresholds_against_sorted_documents():
    rng = np.random.default_rng(3)
    odds = rng.normal(1, 4, 3000)
    bins = cotrain.bins_of(odds)
    counts = np.bincount(bins, minlength=cotrain.BINS)
    for share, rate in ((0.1, 0.7), (0.4, 0.9), (0.0, 0.5), (1.0, 0.5)):
        low, high = cotrain.thresholds(counts, rate, share, 0.95)
        least = int(cotrain.bins_of(np.log(19.0))) + 1
        for got, limit, part in ((np.sum(bins >= high), share * rate, bins[bins >= least]), (np.sum(bins <= low), share * (1 - rate), cotrain.BINS - 1 - bins[bins <= cotrain.BINS - 1 - least])):
            exp, best = 0, np.sort(part)[::-1]
            for v in np.unique(best)[::-1]:  # whole bins, surest first, while they fit
                n = int(np.sum(best >= v))
                if n > limit * len(odds):
                    break
                exp = n
            assert got == exp


def test_rounds_against_plain_loops(spark):
    """The exchange over a table of many parts gives what document-by-document loops give; no document is left out."""
    rows, quality = corpus()
    docs = documents(spark, rows).repartition(5)
    marks = labels(spark, [(i, q) for i, q in quality.items() if i % 5 == 0])
    features = cotrain.feature_table(docs, "doc_id", cotrain.COLS)
    model = cotrain.fit(features, marks, rounds=2)
    table = features.toArrow()
    x, ids = cotrain.unpacked(table["x"].combine_chunks()), np.array(table["_id"].to_pylist(), float)
    known = {i: q for i, q in quality.items() if i % 5 == 0}
    on = sorted(known)
    at = {i: int(np.flatnonzero(ids == i)[0]) for i in on}
    lx, y = x[[at[i] for i in on]], np.array([float(known[i]) for i in on])
    pool = x[[k for k, i in enumerate(ids) if i not in known]]
    fit, held = cotrain.held_out(y, np.array(on))
    cut = lambda v: (v[:, :cotrain.TEXT_DIM], v[:, cotrain.TEXT_DIM:])
    w = [cotrain.fit_logistic(v[fit], y[fit], 2.0) for v in cut(lx)]
    rate = y[fit].mean()
    for turn in (1, 2):
        given = [[], []]
        for k in (0, 1):
            a, b = cotrain._platt(cotrain.log_odds(cut(lx)[k][held], w[k]), y[held])
            bins = cotrain.bins_of(a * cotrain.log_odds(cut(pool)[k], w[k]) + b)
            low, high = cotrain.thresholds(np.bincount(bins, minlength=cotrain.BINS), rate, 0.1 * turn, 0.95)
            given[1 - k] = [(i, float(v >= high)) for i, v in enumerate(bins) if v <= low or v >= high]
        new = []
        for k in (0, 1):
            d = cut(pool)[k].shape[1] + 1
            g, h = np.zeros(d), np.zeros((d, d))
            for i, label in given[k]:
                z = np.append(cut(pool)[k][i], 1.0).astype(float)
                s = float(np.clip(z @ w[k], -30, 30))
                g += z * (label - 1 / (1 + np.exp(-s)))
                h += np.outer(z, z) * (np.tanh(abs(s) / 2) / (2 * abs(s)) if abs(s) > 1e-4 else 0.25)
            c = min(1.0, 0.1 * turn * fit.sum() / max(1, len(given[k])))
            new.append(cotrain.fit_logistic(cut(lx)[k][fit], y[fit], 2.0, others=(w[k], c * g, c * h)) if given[k] else w[k])
        w = new
        assert min(map(len, given)) > 0
    assert model.handed == [len(g) for g in given]
    for a, b in zip(model.w, w):
        np.testing.assert_allclose(a, b, rtol=1e-3, atol=1e-3)


def test_rare_junk_among_many_takes_part(spark):
    """One document in thousands, unlike the others, is scored in every round (nothing is sampled)."""
    rng = random.Random(9)
    rows, quality = corpus()
    many = rows + [(10_000 + i, prose(rng, 30), "en", "good", 100) for i in range(4000)] + [(50_000, "%%% " * 200, "en", "junk", 800)]
    features = cotrain.feature_table(documents(spark, many), "doc_id", cotrain.COLS)
    seen = cotrain.TablePool(features, np.array([1, 2])).total(lambda xt, xm: np.array([len(xt), np.sum(xt[:, ord("%")] > 0.8)], float))
    assert seen.tolist() == [len([r for r in many if r[0] not in (1, 2)]), 1]
    got = {r["doc_id"]: r["accepted"] for r in cotrain.score_documents(documents(spark, many), labels(spark, [(i, q) for i, q in quality.items() if i % 2])).collect()}
    assert not got[50_000] and np.mean([got[10_000 + i] for i in range(4000)]) > 0.97


def test_repeated_labelled_rows_are_one(spark):
    rows, quality = corpus()
    marks = labels(spark, [(i, q) for i, q in quality.items() if i % 2])
    once = {r["doc_id"]: r["score"] for r in cotrain.score_documents(documents(spark, rows), marks).collect() if r["doc_id"] is not None}
    more = cotrain.score_documents(documents(spark, rows + [r for r in rows if r[0] == 1] * 400), marks).collect()
    assert len(more) == len(rows) + 400 * sum(r[0] == 1 for r in rows)
    assert np.mean([abs(r["score"] - once[r["doc_id"]]) < 0.05 for r in more if r["doc_id"] is not None]) > 0.95
