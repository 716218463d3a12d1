"""URL filter: host and path rules first, then a ratio of two character language models.

Two smoothed variable-order Markov models over 40 symbols (letters, one digit class, URL signs, one class
for the rest) are counted on the URLs that the allow rules and the block rules decide. A context of up
to three symbols counts if it was seen `min_context` times, else the next shorter one; orders are
interpolated by Witten-Bell weights. A URL's score is the mean over its characters of
log P(accepted) - log P(rejected); a logistic calibration on the held-out fifth of the decided URLs turns
it into a probability, and a URL below one half is blocked.

Scale: one pass counts (each task sends at most 2 * 40**4 cells), one pass calibrates (8,192 bins), one
pass scores. The model has 40**4 cells (10 MB), whatever the input.

Defined cases: null URLs, and those without `://`, have an empty host and path; a URL with no characters
to score, and every URL where one of the two classes has no examples, is allowed unless a rule says
otherwise; repeated rows are judged alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqflow.llm.common import ascii_lower

SIGNS = "./-_?=&#%+:"
SYMBOLS = 1 + 26 + 1 + len(SIGNS) + 1  # pad, letters, digits, signs, other
CONTEXT = 3
CELLS = SYMBOLS ** (CONTEXT + 1)
BINS, SPAN = 4096, 8.0

_LUT = np.full(256, SYMBOLS - 1, np.int64)
_LUT[0] = 0
for _k, _c in enumerate("abcdefghijklmnopqrstuvwxyz"):
    _LUT[ord(_c)] = _LUT[ord(_c.upper())] = 1 + _k
_LUT[ord("0"):ord("9") + 1] = 27
for _k, _c in enumerate(SIGNS):
    _LUT[ord(_c)] = 28 + _k


def split_url(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = ascii_lower(F.coalesce(F.regexp_extract(url, pattern, 1), F.lit("")))
    return host, F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls. rules: (verdict, host + path prefix)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: len(x[1])):
        h, _, p = r.partition("/")
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit("/" + p))
        rule, verdict = F.when(fits, r).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def _codes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each character of each text, the cell of its three predecessors and itself; the text it is in."""
    raw = [t.encode("utf-8").replace(b"\0", b"\x01") for t in texts]
    s = _LUT[np.frombuffer(b"\0\0\0" + b"\0\0\0".join(raw), np.uint8)]
    code = s[3:].copy()
    for back in range(1, CONTEXT + 1):
        code += s[3 - back:len(s) - back] * SYMBOLS ** back
    at = s[3:] > 0
    return code[at], np.repeat(np.arange(len(raw)), [len(r) for r in raw])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, CELLS), np.int64)
    for b in batches:
        texts, good = b.column("t").to_pylist(), np.array(b.column("good").to_pylist(), bool)
        code, of = _codes(texts)
        for k in (0, 1):
            counts[k] += np.bincount(code[good[of] == bool(k)], minlength=CELLS)
    for k in (0, 1):
        cell = np.flatnonzero(counts[k])
        yield pa.RecordBatch.from_pydict({"cls": np.full(len(cell), k, np.int32), "cell": cell, "n": counts[k][cell]})


def log_model(counts: np.ndarray, min_context: int) -> np.ndarray:
    """log P(symbol | three before it) for every cell, from the counts of all cells."""
    c = counts.reshape((SYMBOLS,) * (CONTEXT + 1)).astype(np.float64)
    p = np.full(SYMBOLS, 1.0 / (SYMBOLS - 1))
    for order in range(CONTEXT + 1):
        n = c.sum(axis=tuple(range(CONTEXT - order)))  # counts of this order
        total, kinds = n.sum(-1, keepdims=True), (n > 0).sum(-1, keepdims=True)
        with np.errstate(invalid="ignore", divide="ignore"):
            p = np.where(total >= max(min_context, 1), (n + kinds * p) / (total + kinds), np.broadcast_to(p, n.shape))
    return np.log(p).reshape(-1)


def _scores(texts: Sequence[str], diff: np.ndarray) -> np.ndarray:
    code, of = _codes(texts)
    total = np.bincount(of, diff[code], minlength=len(texts))
    return total / np.maximum(np.bincount(of, minlength=len(texts)), 1)


def fit_logistic(x: np.ndarray, n0: np.ndarray, n1: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """(a, b) of P(class 1) = 1 / (1 + exp(-(a x + b))) on counts of both classes at each x."""
    m0, m1 = n0.sum(), n1.sum()
    y1, y0 = (m1 + 1) / (m1 + 2), 1 / (m0 + 2)  # Platt's smoothed targets
    n, y = n0 + n1, n0 * y0 + n1 * y1
    a, b = 0.0, float(np.log((m1 + 1) / (m0 + 1)))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([((y - n * p) * x).sum() - 1e-6 * a, (y - n * p).sum()])
        w = n * p * (1 - p) + 1e-12
        h = np.array([[(w * x * x).sum() + 1e-6, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-9]])
        step = np.clip(np.linalg.solve(h, g), -5, 5)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], *, id_col: str = "page_id", url_col: str = "url",
                min_context: int = 2, folds: int = 5) -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block), score, p_allow."""
    spark = pages.sparkSession
    url = F.col(url_col).cast("string")
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    text = ascii_lower(F.coalesce(F.when(F.instr(url, "://") > 0, rest).otherwise(url), F.lit("")))
    host, path = split_url(url)
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), text.alias("t"))
    rule, said = longest_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("said", said)
    decided = rows.where(F.col("rule").isNotNull()).select("t", (F.col("said") == "allow").alias("good"))
    held = F.pmod(F.crc32(F.col("t")), F.lit(folds)) == 0

    cells = (decided.where(~held).mapInArrow(_count, "cls int, cell long, n long")
             .groupBy("cls", "cell").agg(F.sum("n").alias("n")).toArrow())
    counts = np.zeros((2, CELLS), np.int64)
    counts[cells["cls"].to_numpy(), cells["cell"].to_numpy()] = cells["n"].to_numpy()
    both = bool(counts[0].any() and counts[1].any())
    diff = (log_model(counts[1], min_context) - log_model(counts[0], min_context)).astype(np.float32) if both else np.zeros(CELLS, np.float32)
    table = spark.sparkContext.broadcast(diff)

    @F.pandas_udf("double")
    def score(t: pd.Series) -> pd.Series:
        return pd.Series(_scores(t.tolist(), table.value))

    at = F.least(F.lit(BINS - 1), F.greatest(F.lit(0), F.floor((score("t") + SPAN) * (BINS / (2 * SPAN)))))
    bins = decided.where(held).groupBy(at.alias("bin"), "good").count().collect() if both else []
    n = np.zeros((2, BINS))
    for r in bins:
        n[int(r["good"]), int(r["bin"])] = r["count"]
    x = (np.arange(BINS) + 0.5) * (2 * SPAN / BINS) - SPAN
    a, b = fit_logistic(x, n[0], n[1]) if n[0].any() and n[1].any() else (1.0, 0.0)

    rows = rows.withColumn("score", score("t"))
    rows = rows.withColumn("p_allow", F.lit(1.0) / (1 + F.exp(-(a * F.col("score") + b))))
    method = F.when((F.length("t") == 0) | F.lit(not both) | (F.col("p_allow") >= 0.5), "allow").otherwise("block")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("said", method).alias("verdict"), "score", "p_allow")
