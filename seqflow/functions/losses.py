"""Loss expressions on logits, written in numerically stable form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _softplus_neg_abs(z: Column) -> Column:
    return F.log1p(F.exp(-F.abs(z)))


def bce_with_logits(z: Column | str, y: Column | str, pos_weight: float | None = None) -> Column:
    """Binary cross entropy on a logit z and a 0/1 target y.

    Plain:    max(z, 0) - z*y + log(1 + exp(-|z|))
    Weighted: (1 - y)*z + (1 + (w - 1)*y) * (log(1 + exp(-|z|)) + max(-z, 0))
    """
    z, y = _c(z).cast("double"), _c(y).cast("double")
    if pos_weight is None:
        return F.greatest(z, F.lit(0.0)) - z * y + _softplus_neg_abs(z)
    w = F.lit(float(pos_weight))
    return (1 - y) * z + (1 + (w - 1) * y) * (_softplus_neg_abs(z) + F.greatest(-z, F.lit(0.0)))


def focal_loss(
    z: Column | str,
    y: Column | str,
    gamma: float = 2.0,
    alpha: float = 0.5,
    dynamic_adjust: bool = False,
) -> Column:
    """Per-row focal loss alpha_t * (1 - exp(-bce))**gamma * bce.

    Static alpha is one scalar for every row; with dynamic_adjust, alpha for y = 1 and
    1 - alpha for y = 0. Reduce with avg / sum, or keep per row.
    """
    bce = bce_with_logits(z, y)
    pt = F.exp(-bce)
    if dynamic_adjust:
        a = F.when(_c(y).cast("double") == 1.0, F.lit(float(alpha))).otherwise(F.lit(1.0 - float(alpha)))
    else:
        a = F.lit(float(alpha))
    return a * F.pow(1 - pt, F.lit(float(gamma))) * bce
