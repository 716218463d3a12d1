"""Scalar expressions for labels, ids and vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the source system's for right results.
LABEL_OK = "OK"
LABEL_NG = "NG"
LABEL_AMBIGUOUS = "OK_within_NG"
# one digit, or a comma separated list of single digits
VALVE_PATTERN = r"^[0-9](,[0-9])*$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coerce_double(c: Column | str) -> Column:
    """Numeric coercion: text or number to DOUBLE, unparsable -> NULL, NaN -> NULL.

    NaN is normalised to NULL once, here, because Spark aggregates treat NaN as a value.
    """
    x = _c(c).try_cast("double")
    return F.nanvl(x, F.lit(None).cast("double"))


def normalize_subpart(c: Column | str) -> Column:
    """Subpart ids stored as tenths: 0 <= x <= 0.6 -> x * 10; everything else unchanged."""
    x = _c(c).cast("double")
    return F.when(x.between(0.0, 0.6), x * 10).otherwise(x)


def valid_valve(c: Column | str) -> Column:
    """Valve id text: kept if one digit or a comma list of single digits, else NULL."""
    v = _c(c)
    return F.when(v.rlike(VALVE_PATTERN), v)


def subpart_status(files_type: Column | str, valve: Column | str, subpart_no: Column | str) -> Column:
    """Quality label of one measurement row.

    OK source -> OK. NG source: missing valve -> NG; any listed digit occurring as a
    substring of the printed subpart number (e.g. '3.0') -> NG; else OK_within_NG.
    """
    ft, v = _c(files_type), _c(valve)
    printed = _c(subpart_no).cast("double").cast("string")
    hit = F.exists(F.split(v, ","), lambda d: d.rlike("^[0-9]+$") & (F.instr(printed, d) > 0))
    return (
        F.when(ft == LABEL_OK, F.lit(LABEL_OK))
        .when(v.isNull(), F.lit(LABEL_NG))
        .when(hit, F.lit(LABEL_NG))
        .otherwise(F.lit(LABEL_AMBIGUOUS))
    )


def label_to_binary(c: Column | str) -> Column:
    """NG -> 1.0, OK -> 0.0, anything else -> NULL."""
    x = _c(c)
    return F.when(x == LABEL_NG, F.lit(1.0)).when(x == LABEL_OK, F.lit(0.0))


def magnitude(a: Column | str, b: Column | str, c: Column | str) -> Column:
    """Euclidean norm of three components; NULL if any component is NULL."""
    a, b, c = _c(a), _c(b), _c(c)
    return F.sqrt(a * a + b * b + c * c)


def threshold_label(p: Column | str, threshold: float = 0.5) -> Column:
    """1 when p > threshold (strict), else 0."""
    return (_c(p) > F.lit(float(threshold))).cast("int")
