"""Quality classifier by co-training on two views of a document.

One view is the text (byte frequencies, and statistics of words, case, signs and repetition of the whole
text), the other the metadata (language, source, length class). Each has a logistic model, first fitted on the
labelled documents. In every round each view labels all other documents, and those it is most sure of, in the
proportion of the classes, join the training set of the other view; the share of documents handed over grows by
`share` a round. Both views are then calibrated on held-out labelled documents, a quarter of each class, and a
logistic combination of the calibrated log odds scores every document.

What joins a view weighs like labelled documents, but no more in sum than `share` times the round of their number.
Its log-likelihood enters the fit as its tangent quadratic bound at the view's present weights, so that a round
needs sums of a fixed size only.

Scale: the features of every document are written once (1.4 KB a document). Labelled documents are a seeded sample
of at most `labelled`; nothing else is sampled. A round is two passes over the features: a histogram of the log
odds of all documents, which gives the thresholds, then gradients and curvatures of the documents beyond them. Tasks
send one sum each, which are added up by GROUPS tasks before the driver adds those. The models (a few hundred
weights) travel with the tasks.

Defined cases: null and empty texts have zero features, a null language or source is a value of its own, a
null length counts as 0; where a document has several labels the least counts, null labels and labels
without a document none; labelled rows that repeat an id are one, that with the least features; with one labelled
document of a class, it is both fitted and held out; with labels of one class only, or none, every document gets that
class's score (accepted if there are none); repeated rows are scored alike; an empty table gives no rows; other
columns are ignored (in `accepted` passed on).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqflow.llm.common import hash_sample, written

META_BUCKETS = 96
EXTRA = 10
#: the histogram of calibrated log odds has BINS bins from -SPAN to SPAN
BINS, SPAN = 4096, 12.0
#: tasks that add up the sums of all others
GROUPS = 32
TEXT_DIM = 256 + EXTRA
META_DIM = META_BUCKETS + 2
SCORES = "p_text double, p_meta double, score double"


def text_features(texts: Sequence[str | None]) -> np.ndarray:
    out = np.zeros((len(texts), TEXT_DIM), np.float32)
    for i, t in enumerate(texts):
        if not t:
            continue
        raw = t.encode()
        n = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        out[i, :256] = np.sqrt(n / len(raw))
        words, lines = raw.split(), raw.splitlines()
        letters = max(1, int(n[65:91].sum() + n[97:123].sum()))
        w = max(1, len(words))
        out[i, 256:] = (np.log1p(len(words)), len(raw) / w / 10, n[65:91].sum() / letters, n[48:58].sum() / len(raw),
                        (n[33:48].sum() + n[58:65].sum() + n[91:97].sum() + n[123:127].sum()) / len(raw), len(set(words)) / w,
                        np.log1p(w / max(1, len(set(words)))), len(set(lines)) / max(1, len(lines)), np.log1p(len(raw) / max(1, len(lines))) / 5,
                        n[128:].sum() / len(raw))
    return out


def meta_features(lang: Sequence, source: Sequence, n_chars: Sequence) -> np.ndarray:
    out = np.zeros((len(lang), META_DIM), np.float32)
    for i, (a, b, n) in enumerate(zip(lang, source, n_chars)):
        n = 0.0 if n is None or n != n else max(0.0, float(n))
        for k, v in (("l", a), ("s", b), ("n", int(np.log2(n + 1)))):
            out[i, xxhash.xxh32_intdigest(f"{k}={v}") % META_BUCKETS] = 1
        out[i, META_BUCKETS:] = np.log1p(n) / 10, 1
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 12,
                 others: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Weights (the last one the intercept) by Newton steps; features are scaled inside.

    others: weights, and at these the gradient and the curvature of the log-likelihood of further rows."""
    scale = np.maximum(x.std(0), 1e-3)
    mean = x.mean(0)
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1), x.dtype)]).astype(np.float32)
    w = np.zeros(z.shape[1])
    back = np.diag(np.append(1 / scale, 1.0)).astype(float)  # scaled to plain weights
    back[-1, :-1] = -mean / scale
    penalty = np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (y - p) - penalty * w
        h = ((z * (p * (1 - p) + 1e-5)[:, None].astype(np.float32)).T @ z).astype(np.float64) + np.diag(penalty)
        if others:
            at, g0, h0 = others
            g = g + back.T @ (g0 - h0 @ (back @ w - at))
            h = h + back.T @ h0 @ back
        step = np.linalg.solve(h, g)
        w += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-4:
            break
    return back @ w


def log_odds(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w[:-1] + w[-1], -30, 30)


def _sigmoid(s: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-s))


def held_out(y: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fitted, held out): of each class every fourth row by a seeded hash of its key, one at least, is held out. A row
    that is alone in its class is both."""
    fit, held = np.ones(len(y), bool), np.zeros(len(y), bool)
    order = np.array([xxhash.xxh64_intdigest(str(k), seed=7) for k in keys], np.uint64)
    for label in np.unique(y):
        own = np.flatnonzero(y == label)
        own = own[np.argsort(order[own], kind="stable")]
        held[own[::4]] = True
        if len(own) > 1:
            fit[own[::4]] = False
    return fit, held


def bins_of(odds: np.ndarray) -> np.ndarray:
    return np.clip((odds + SPAN) * (BINS / (2 * SPAN)), 0, BINS - 1).astype(int)


def thresholds(counts: np.ndarray, rate: float, share: float, sure: float) -> tuple[int, int]:
    """(low, high): the documents in bins up to low are handed over as 0, from high on as 1. At most `share` of
    all, in whole bins, in the proportion `rate` of the ones, and only what is at least `sure`."""
    total, edge = counts.sum(), int(bins_of(np.log(sure / (1 - sure)))) + 1
    ones, zeros = np.cumsum(counts[::-1]), np.cumsum(counts)
    high = BINS - int(np.searchsorted(ones, share * rate * total, "right"))
    low = int(np.searchsorted(zeros, share * (1 - rate) * total, "right")) - 1
    return min(low, BINS - 1 - edge), max(high, edge)


def bound_sums(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Number of rows, and gradient and curvature of the tangent quadratic lower bound of their log-likelihood at w."""
    z = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    s = np.clip(z @ w, -30, 30)
    curve = np.where(np.abs(s) < 1e-4, 0.25, np.tanh(np.abs(s) / 2) / np.maximum(2 * np.abs(s), 1e-9))
    return np.concatenate([[len(x)], z.T @ (y - _sigmoid(s)), ((z * curve[:, None]).T @ z).ravel()])


class LocalPool:
    """Unlabelled documents in memory."""

    def __init__(self, xt: np.ndarray, xm: np.ndarray):
        self.xt, self.xm = xt, xm

    def total(self, sums: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray | None:
        """The sum over all documents of a function of both views; None if there are none."""
        return sums(self.xt, self.xm) if len(self.xt) else None


class TablePool:
    """Unlabelled documents in a written table of features: all rows but those with the ids in `known`."""

    def __init__(self, rows: DataFrame, known: np.ndarray):
        self.rows, self.known = rows, np.sort(known)

    def total(self, sums: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray | None:
        known = self.known  # bounded, as the weights in `sums`: both travel with the function

        def own(batches):
            out = None
            for b in batches:
                ids = b.column("_id")
                free = pc.invert(pc.fill_null(pc.is_in(ids, value_set=pa.array(known, pa.int64())), False))
                x = unpacked(b.column("x").filter(free))
                if len(x):
                    part = sums(x[:, :TEXT_DIM], x[:, TEXT_DIM:])
                    out = part if out is None else out + part
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["sums"])

        def added(batches):
            out = None
            for b in batches:
                for v in b.column("sums").to_pylist():
                    out = np.frombuffer(v) if out is None else out + np.frombuffer(v)
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["sums"])

        parts = self.rows.select("_id", "x").mapInArrow(own, "sums binary").repartition(GROUPS).mapInArrow(added, "sums binary")
        got = parts.collect()  # at most GROUPS rows
        return np.sum([np.frombuffer(r["sums"]) for r in got], axis=0) if got else None


def unpacked(x: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(x.to_pylist()), np.float32).reshape(-1, TEXT_DIM + META_DIM)


class CoTrained:
    """The fitted views, their calibrations and their combination."""

    def __init__(self, xt: np.ndarray, xm: np.ndarray, y: np.ndarray, fit: np.ndarray, held: np.ndarray, pool: LocalPool | TablePool,
                 rounds: int = 4, sure: float = 0.95, share: float = 0.1, ridge: float = 2.0):
        """xt, xm, y: both views and labels of the labelled documents; `fit` are fitted, `held` calibrate; pool: the others."""
        self.constant, self.handed = None, [0, 0]
        if len(np.unique(y)) < 2:
            self.constant = float(y.mean()) if len(y) else 1.0
            return
        views, rate = (xt, xm), y[fit].mean()
        self.w = [fit_logistic(v[fit], y[fit], ridge) for v in views]
        for turn in range(1, rounds + 1):
            w, cal = list(self.w), [_platt(log_odds(v[held], k), y[held]) for v, k in zip(views, self.w)]

            def odds(k: int, x: np.ndarray, w=w, cal=cal) -> np.ndarray:
                return bins_of(cal[k][0] * log_odds(x, w[k]) + cal[k][1])

            def histograms(pt: np.ndarray, pm: np.ndarray, odds=odds) -> np.ndarray:
                return np.concatenate([np.bincount(odds(k, x), minlength=BINS) for k, x in enumerate((pt, pm))]).astype(float)

            counts = pool.total(histograms)
            if counts is None:
                break
            cuts = [thresholds(c, rate, share * turn, sure) for c in counts.reshape(2, BINS)]

            def sums(pt: np.ndarray, pm: np.ndarray, odds=odds, cuts=cuts, w=w) -> np.ndarray:
                out = []
                for k, x in enumerate((pt, pm)):  # what the other view is sure of
                    b = odds(1 - k, (pt, pm)[1 - k])
                    on = (b <= cuts[1 - k][0]) | (b >= cuts[1 - k][1])
                    out.append(bound_sums(x[on], (b[on] >= cuts[1 - k][1]).astype(float), w[k]))
                return np.concatenate(out)

            got = pool.total(sums)
            for k, v in enumerate(views):
                d = v.shape[1] + 1
                own, got = got[:1 + d + d * d], got[1 + d + d * d:]
                self.handed[k] = int(own[0])
                if own[0]:
                    weight = min(1.0, share * turn * fit.sum() / own[0])
                    self.w[k] = fit_logistic(v[fit], y[fit], ridge, others=(w[k], weight * own[1:d + 1], weight * own[d + 1:].reshape(d, d)))
        self.cal = [_platt(log_odds(x[held], w), y[held]) for x, w in zip(views, self.w)]
        self.mix = fit_logistic(self._odds(xt[held], xm[held]), y[held], 1.0)

    def _odds(self, xt: np.ndarray, xm: np.ndarray) -> np.ndarray:
        return np.stack([np.clip(a * log_odds(x, w) + b, -12, 12) for x, w, (a, b) in zip((xt, xm), self.w, self.cal)], 1)

    def scores(self, xt: np.ndarray, xm: np.ndarray) -> np.ndarray:
        """Columns p_text, p_meta, score."""
        if self.constant is not None:
            return np.full((len(xt), 3), self.constant)
        odds = self._odds(xt, xm)
        return np.hstack([_sigmoid(odds), _sigmoid(log_odds(odds, self.mix))[:, None]])


def _platt(s: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    n1 = y.sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (len(y) - n1 + 2))
    w = fit_logistic(s[:, None], target, 1e-3)
    return float(w[0]), float(w[1])


def feature_table(docs: DataFrame, id_col: str, cols: dict[str, str]) -> DataFrame:
    """_id and x (both views, as 32-bit floats) of every document, written."""

    def run(batches):
        for b in batches:
            t = text_features(b.column("text").to_pylist())
            m = meta_features(b.column("lang").to_pylist(), b.column("source").to_pylist(), b.column("n_chars").to_pylist())
            x = np.hstack([t, m]).astype(np.float32)
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array([v.tobytes() for v in x], pa.binary())], names=["_id", "x"])

    # only the columns that are used, under names that can't clash
    used = docs.select(F.col(id_col).cast("long").alias("_id"), *[F.col(c).cast("double" if k == "n_chars" else "string").alias(k) for k, c in cols.items()])
    return written(used.mapInArrow(run, "_id long, x binary"), "quality-features")


COLS = {"text": "text", "lang": "lang", "source": "source", "n_chars": "n_chars"}


def fit(features: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "quality", labelled: int = 8000, rounds: int = 4) -> CoTrained:
    marks = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("double").alias("y")).where("_id IS NOT NULL AND y IS NOT NULL")
    marks = marks.groupBy("_id").agg(F.min("y").alias("y"))
    has = written(marks.join(features.select("_id"), "_id", "left_semi"), "quality-labels")
    picked = written(hash_sample(has, ["_id"], labelled, has.count(), "quality"), "quality-sample")  # at most `labelled` rows
    rows = features.join(F.broadcast(picked), "_id").groupBy("_id").agg(F.min("y").alias("y"), F.min("x").alias("x")).orderBy("_id").toArrow().combine_chunks()
    ids, y = rows["_id"].to_numpy(), (rows["y"].to_numpy() > 0.5).astype(float)
    x = unpacked(rows["x"])
    return CoTrained(x[:, :TEXT_DIM], x[:, TEXT_DIM:], y, *held_out(y, ids), TablePool(features, ids), rounds)


def scorer(docs: DataFrame, model: CoTrained) -> Callable[..., Column]:
    """A function of the text, language, source and length columns that gives struct (p_text, p_meta, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(SCORES)
    def score(text: pd.Series, lang: pd.Series, source: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
        parts = []
        for a in range(0, len(text), 1000):
            s = slice(a, a + 1000)
            parts.append(shared.value.scores(text_features(text[s].tolist()), meta_features(lang[s].tolist(), source[s].tolist(), n_chars[s].tolist())))
        return pd.DataFrame(np.vstack(parts) if parts else np.zeros((0, 3)), columns=["p_text", "p_meta", "score"])

    return score


def score_documents(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", threshold: float = 0.5, **options) -> DataFrame:
    """doc_id, p_text, p_meta, score, accepted."""
    features = feature_table(docs, id_col, COLS)
    shared = docs.sparkSession.sparkContext.broadcast(fit(features, labels, id_col=id_col, **options))

    def run(batches):
        for b in batches:
            x = unpacked(b.column("x"))
            got = shared.value.scores(x[:, :TEXT_DIM], x[:, TEXT_DIM:])
            yield pa.RecordBatch.from_arrays([b.column("_id"), *[pa.array(c) for c in got.T.astype(float)]], names=["doc_id", "p_text", "p_meta", "score"])

    rows = features.mapInArrow(run, "doc_id long, " + SCORES)
    return rows.withColumn("accepted", F.col("score") >= threshold)


def accepted(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", threshold: float = 0.5, **options) -> DataFrame:
    """The documents that are not rejected, with the columns they have."""
    model = fit(feature_table(docs, id_col, COLS), labels, id_col=id_col, **options)
    s = scorer(docs, model)("text", F.col("lang").cast("string"), F.col("source").cast("string"), F.col("n_chars").cast("double"))
    return docs.where(s["score"] >= threshold)
