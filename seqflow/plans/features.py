"""Op 54: the feature job.

The 19 engineered columns per (part, subpart) sequence, then projection onto the
configured output schema (existing fields, then missing names typed by override or
DOUBLE). An empty input gives a typed empty output; no count() is needed for that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from seqflow.operators import features as FE
from seqflow.operators.prepare import INDEX


def feature_job(df: DataFrame, schema_names: Sequence[str] = (), keys: Sequence[str] = FE.DEFAULT_KEYS,
                order: Sequence[str] = (INDEX,), window_size: int = 3, skew_safe: bool = False) -> DataFrame:
    if skew_safe:
        out = FE.add_magnitude(FE.add_signal_features_skew_safe(df, FE.SIGNALS, keys, order, window_size))
    else:
        out = FE.add_all_features(df, keys, order, window_size)
    if schema_names:
        out = FE.conform_to_schema(out, FE.feature_schema(out, schema_names))
    return out
