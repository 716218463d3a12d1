"""Op 67: mode-dependent sequence preparation.

train: chunk -> fit the scaler on the chunked rows -> scale -> nest -> class weights;
val / test: chunk -> scale with the given (stored) parameters -> nest;
score: chunk without labels -> scale with the stored parameters -> nest -> label 0.
Returns (sequences, scaler parameters). The parameters are a small table; persist them
with `scaling.save_scaler` and record the fit id in the state table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqflow.operators import scaling as SC
from seqflow.operators import sequences as SQ
from seqflow.operators.prepare import LABEL, PART, PART_INDEX, SUBPART

MODES = ("train", "val", "test", "score")


def prepare_sequences(
    df: DataFrame,
    mode: str,
    features: Sequence[str],
    seq_len: int | Column,
    scaler: DataFrame | None = None,
    scaler_id: str = "train",
    label: str = LABEL,
    by: Sequence[str] = (PART, SUBPART),
    order: Sequence[str | Column] = (PART_INDEX,),
) -> tuple[DataFrame, DataFrame]:
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; expected one of {MODES}")
    if mode != "train" and scaler is None:
        raise ValueError("val / test / score need the stored scaler parameters")
    scoring = mode == "score"
    chunked = SQ.chunk_rows(df, seq_len, by, order, label=None if scoring else label)
    params = SC.fit_scaler(chunked, features, scaler_id) if mode == "train" else scaler
    scaled = SC.apply_scaler(chunked, params, features)
    nested = SQ.nest_sequences(scaled, features, by, label=None if scoring else label)
    if scoring:
        nested = nested.withColumn(label, F.lit(0.0))
    if mode == "train":
        nested = SQ.class_weights(nested, label)
    return nested, params
