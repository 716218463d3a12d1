"""Op 69 with the configured loss: a linear classifier on logits, fitted by limited-memory BFGS.

The objective is the (weighted) mean of a loss on the logit z = x . coefficients + intercept, plus `reg` / 2 times the
squared coefficients. Losses: `default` (binary cross entropy), `weighted` (with a weight on positives), `focal` (static or
label-dependent alpha), or a function of (z, y) that gives losses and derivatives by z.

One epoch is one step of the optimiser. It reads the checkpointed rows once: every task adds up losses and gradients at
several step lengths for its rows, Spark sums the partial results, and the driver, which only ever holds vectors
of the model's size, takes the step. After each epoch the validation rows give loss and confusion counts the same
way, so the fit leaves a run log that ops 72-75 read: it stops early by the validation loss, ends where a class gets
no precision, keeps the coefficients of the best F2, and, for focal loss with `dynamic`, moves alpha by recent recall.

Rows with a null label are refused, as are labels other than 0 and 1 and features that are null, not finite or of
another number than the first row's. An empty training table gives a model of zeros with an empty log.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqflow.functions.scalar import threshold_label
from seqflow.operators.runlogs import BEST_METRICS
from seqflow.session import materialize

LossFunction = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]

# fixed values: the step, the limits and the recall of the alpha rule, in the order raise to, lower to
ALPHA_STEP, ALPHA_LIMITS, ALPHA_RECALL, ALPHA_EPOCHS = 0.025, (0.9, 0.1), 0.9, 5

STEPS = (1.0, 0.5, 0.25, 2.0)  # step lengths tried in one pass
MEMORY, SHRINK, ARMIJO = 10, 1 / 16, 1e-4


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.maximum(z, 0) + np.log1p(np.exp(-np.abs(z)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    e = np.exp(-np.abs(z))
    return np.where(z >= 0, 1, e) / (1 + e)


def cross_entropy(pos_weight: float = 1.0) -> LossFunction:
    def loss(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = 1 + (pos_weight - 1) * y
        return (1 - y) * z + w * _softplus(-z), (1 - y) - w * _sigmoid(-z)
    return loss


def focal(gamma: float = 2.0, alpha: float = 0.5, by_label: bool = False) -> LossFunction:
    """alpha * (1 - exp(-bce))**gamma * bce; by_label: 1 - alpha for negatives."""
    def loss(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a = np.where(y == 1, alpha, 1 - alpha) if by_label else alpha
        bce, slope = cross_entropy()(z, y)
        miss = -np.expm1(-bce)  # 1 - probability of the right class
        inner = gamma * miss ** (gamma - 1) * (1 - miss) * bce if gamma else 0.0
        return a * miss ** gamma * bce, a * (inner + miss ** gamma) * slope
    return loss


@dataclass
class LinearModel:
    coefficients: np.ndarray
    intercept: float

    def logit(self, x: Column) -> Column:
        w = F.array(*[F.lit(float(c)) for c in self.coefficients]) if len(self.coefficients) else F.array().cast("array<double>")
        return F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v) + F.lit(float(self.intercept))

    def score(self, df: DataFrame, x: str = "x", keys: tuple[str, ...] = ("part_number", "subpart_no"), threshold: float = 0.5,
              machine: str = "M1", real_label: str | None = None) -> DataFrame:
        """Op 71: probability of NG, thresholded label and the score-row shape."""
        p = 1 / (1 + F.exp(-self.logit(F.col(x))))
        cols = [F.lit(machine).alias("machine"), *[F.col(k) for k in keys]]
        if real_label:
            cols.append(F.col(real_label).cast("double").alias("real_label"))
        return df.select(*cols, threshold_label(p, threshold).alias("label"), (1 - p).alias("prob_OK"), p.alias("prob_NG"))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(self.coefficients.tolist(), float(self.intercept))]
        spark.createDataFrame(rows, "coefficients array<double>, intercept double").write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> LinearModel:
        r = spark.read.schema("coefficients array<double>, intercept double").parquet(path).first()
        return LinearModel(np.array(r["coefficients"], float), r["intercept"])


@dataclass
class Fit:
    model: LinearModel  # of the best epoch, or of the last without validation rows
    last: LinearModel
    epochs: list[dict] = field(default_factory=list)
    alpha: float | None = None

    def run_log(self, spark: SparkSession, run_id: str = "run") -> DataFrame:
        """The log that ops 72-75 read: one row per epoch."""
        names = ["train_loss", *BEST_METRICS]
        rows = [(run_id, e["epoch"], *[float(e[n]) if e.get(n) is not None else None for n in names]) for e in self.epochs]
        return spark.createDataFrame(rows, "run_id string, epoch long, " + ", ".join(f"{n} double" for n in names))


def _rows(df: DataFrame, x: str, label: str, weight: str | None) -> DataFrame:
    y = F.col(label).cast("double")
    y = F.when(y.isin(0.0, 1.0), y).otherwise(F.raise_error(F.concat(F.lit("label must be 0 or 1, got "), F.coalesce(y.cast("string"), F.lit("NULL")))).cast("double"))
    return df.select(F.col(x).cast("array<double>").alias("x"), y.alias("y"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"))


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for b in batches:
        flat, sizes = b.column(0).flatten().to_numpy(zero_copy_only=False), b.column(0).value_lengths().to_numpy(zero_copy_only=False)
        if b.num_rows and (b.column(0).null_count or (sizes != dim).any() or not np.isfinite(flat).all()):
            raise ValueError(f"every row needs {dim} finite features")
        yield flat.reshape(-1, dim), b.column(1).to_numpy(), b.column(2).to_numpy()


def _summed(rows: DataFrame, dim: int, points: np.ndarray, of: Callable) -> np.ndarray:
    """For each point (coefficients and intercept) the sum over all rows of the vectors that `of` gives for a block of
    rows (x, y, w, z). Tasks send one row per point and place."""
    schema = pa.schema([("k", pa.int32()), ("i", pa.int32()), ("v", pa.float64())])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x, y, w in _blocks(batches, dim):
            part = np.stack([of(x, y, w, x @ p[:-1] + p[-1]) for p in points])
            total = part if total is None else total + part
        if total is not None:
            k, i = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(k.ravel().astype(np.int32)), pa.array(i.ravel().astype(np.int32)), pa.array(total.ravel())], schema=schema)

    got = rows.mapInArrow(partial, "k int, i int, v double").groupBy("k", "i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((len(points), 1 + max((r["i"] for r in got), default=0)))
    for r in got:
        out[r["k"], r["i"]] = r["v"]
    return out


def _gradients(rows: DataFrame, dim: int, points: np.ndarray, loss: LossFunction, reg: float, intercept: bool, total: float) -> tuple[np.ndarray, np.ndarray]:
    """Objective and gradient at each point, in one pass."""
    def of(x: np.ndarray, y: np.ndarray, w: np.ndarray, z: np.ndarray) -> np.ndarray:
        value, slope = loss(z, y)
        return np.concatenate([[(w * value).sum()], x.T @ (w * slope), [(w * slope).sum()]])

    s = _summed(rows, dim, points, of) / total
    gradient = s[:, 1:]
    gradient[:, :-1] += reg * points[:, :-1]
    if not intercept:
        gradient[:, -1] = 0
    return s[:, 0] + reg / 2 * (points[:, :-1] ** 2).sum(axis=1), gradient


def _direction(g: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    q, kept = g.copy(), []
    for s, y in reversed(pairs):
        a = (s @ q) / (s @ y)
        q -= a * y
        kept.append(a)
    if pairs:
        s, y = pairs[-1]
        q *= (s @ y) / (y @ y)
    for (s, y), a in zip(pairs, reversed(kept), strict=True):
        q += (a - (y @ q) / (s @ y)) * s
    return -q


def _ratio(a: float, b: float) -> float:
    return a / b if b else 0.0


def _metrics(rows: DataFrame, dim: int, point: np.ndarray, loss: LossFunction) -> dict[str, float]:
    def of(x: np.ndarray, y: np.ndarray, w: np.ndarray, z: np.ndarray) -> np.ndarray:
        hit = z > 0
        return np.array([len(y), loss(z, y)[0].sum(), (hit & (y == 1)).sum(), (hit & (y == 0)).sum(), (~hit & (y == 1)).sum(), (~hit & (y == 0)).sum()], float)

    n, value, tp, fp, fn, tn = np.resize(_summed(rows, dim, point[None, :], of)[0], 6)
    out = {"val_loss": _ratio(value, n), "f2_ng": _ratio(5 * tp, 5 * tp + 4 * fn + fp)}
    for c, hit, wrong, missed in (("ng", tp, fp, fn), ("ok", tn, fn, fp)):
        out |= {f"precision_{c}": _ratio(hit, hit + wrong), f"recall_{c}": _ratio(hit, hit + missed), f"f1_{c}": _ratio(2 * hit, 2 * hit + wrong + missed)}
    return out


def fit_loss(train: DataFrame, loss: str | LossFunction = "default", *, val: DataFrame | None = None, x: str = "x", label: str = "subpart_label",
             weight: str | None = None, pos_weight: float = 5.0, gamma: float = 2.0, alpha: float = 0.5, by_label: bool = False,
             dynamic: bool = False, reg: float = 0.0, intercept: bool = True, epochs: int = 100, patience: int = 5, tol: float = 1e-9) -> Fit:
    """`x`: an array of features per row (flattened sequences, say). `dynamic`: label-dependent alpha that follows the
    recall of the last epochs. Without `val` the fit runs until the gradient is below `tol` or for `epochs` steps."""
    by_label = by_label or dynamic

    def chosen(alpha: float) -> LossFunction:
        if callable(loss):
            return loss
        if loss not in ("default", "weighted", "focal"):
            raise ValueError(f"unknown loss {loss!r}; expected 'default', 'weighted' or 'focal'")
        return focal(gamma, alpha, by_label) if loss == "focal" else cross_entropy(pos_weight if loss == "weighted" else 1.0)

    f = chosen(alpha)
    rows = materialize(_rows(train, x, label, weight))
    held = materialize(_rows(val, x, label, None)) if val is not None else None
    head = rows.agg(F.sum("w"), F.max(F.size("x"))).first()
    total, dim = head[0] or 0.0, max(head[1] or 0, 0)
    at = np.zeros(dim + 1)
    out = Fit(LinearModel(at[:-1], 0.0), LinearModel(at[:-1], 0.0), alpha=alpha)
    if not total:
        return out
    (value,), (g,) = _gradients(rows, dim, at[None, :], f, reg, intercept, total)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    best, lowest, waited, recalls = (-1.0, -np.inf), np.inf, 0, []
    for epoch in range(1, epochs + 1):
        if np.abs(g).max() <= tol:
            break
        d, scale = _direction(g, pairs), 1.0
        if d @ g >= 0:
            d, pairs = -g, []
        if not pairs:
            scale = min(1.0, 1 / np.abs(g).sum())
        taken = None
        while taken is None and scale > 1e-12:
            steps = np.array(STEPS) * scale
            points = at[None, :] + steps[:, None] * d[None, :]
            values, gradients = _gradients(rows, dim, points, f, reg, intercept, total)
            good = np.flatnonzero(values <= value + ARMIJO * steps * (d @ g) + 1e-15 * abs(value))
            if len(good):
                taken = int(good[np.argmin(values[good])])
            scale *= SHRINK
        if taken is None:
            break
        s, y = points[taken] - at, gradients[taken] - g
        if s @ y > 1e-12 * np.sqrt((s @ s) * (y @ y)):
            pairs = [*pairs, (s, y)][-MEMORY:]
        at, value, g = points[taken], values[taken], gradients[taken]
        now = LinearModel(at[:-1].copy(), float(at[-1]))
        log = {"epoch": epoch, "train_loss": value}
        out.epochs.append(log)
        out.last = now
        if held is None:
            out.model = now
            continue
        log |= _metrics(held, dim, at, f)
        waited = 0 if log["val_loss"] < lowest else waited + 1
        lowest = min(lowest, log["val_loss"])
        recalls.append(log["recall_ng"])
        if not (log["precision_ng"] and log["precision_ok"]):
            break
        if (log["f2_ng"], -log["val_loss"]) > best:
            best, out.model = (log["f2_ng"], -log["val_loss"]), now
        if dynamic and loss == "focal" and epoch - 1 >= ALPHA_EPOCHS and (epoch - 1) % 2 == 0:
            high = sum(r > ALPHA_RECALL for r in recalls[-ALPHA_EPOCHS:])
            moved = {0: min(alpha + ALPHA_STEP, ALPHA_LIMITS[0]), ALPHA_EPOCHS: max(ALPHA_LIMITS[1], alpha - ALPHA_STEP)}.get(high, alpha)
            if moved != alpha:  # another objective: its value and gradient, without the old curvature
                alpha, f, pairs = moved, chosen(moved), []
                (value,), (g,) = _gradients(rows, dim, at[None, :], f, reg, intercept, total)
        out.alpha = alpha
        if waited >= patience:
            break
    return out
