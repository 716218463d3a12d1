"""Op 68: the preparation job, as one lazy plan.

union -> normalise subparts -> length filter -> subpart index -> target length T ->
pad to T -> part index -> (train: drop ambiguous labels, labels to 0/1).

T is the maximum subpart index in train mode, read off per-sequence counts (a scalar
subquery, so the plan stays lazy and nothing passes through the driver but one integer); in other modes the caller
passes the stored value (see `seqflow.operators.state`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqflow.operators import prepare as P

MODES = ("train", "val", "test", "score")


def prepare_job(*args, **kwargs) -> DataFrame:
    """The prepared rows only; see `prepare_job_with_length`."""
    return prepare_job_with_length(*args, **kwargs)[0]


def prepare_job_with_length(
    first: DataFrame,
    second: DataFrame | None = None,
    *,
    order_by: Sequence[str | Column],
    mode: str = "train",
    target_len: int | Column | None = None,
    n_subparts: int = 6,
    steps: int | None = None,
    co_located: bool = False,
) -> tuple[DataFrame, Column]:
    """(prepared rows, T). T is the padding length: the scalar subquery computed here in
    train mode (store it for val/test/score), else the value passed in.

    `co_located=True` states that `first` is a table bucketed on the part (`write_bucketed`): its rows
    are then not exchanged at all. A union loses the layout, so it takes no second table."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; expected one of {MODES}")
    if co_located and second is not None:
        raise ValueError("a union is not co-located: write both tables into one bucketed table")
    df = P.union_sources(first, second) if second is not None else first
    df = P.normalize_subparts(df)
    if target_len is None and mode != "train":
        raise ValueError("target_len is required outside train mode (read it from the state table)")
    # max(subpart_index) of a dense index == longest kept sequence: counted before any window,
    # from the same per-sequence counts that decide which parts are kept
    df, longest = P.filter_by_length_with_target(df, n_subparts=n_subparts, steps=steps, co_located=co_located)
    if target_len is None:
        target_len = longest
    # one hash exchange on the part serves every later (part) and (part, subpart) window
    if not co_located:
        df = df.repartition(P.PART)
    df = P.add_subpart_index(df, order_by)
    df = P.pad_to_length(df, target_len)
    df = P.add_part_index(df)
    if mode == "train":
        df = P.labels_to_binary(P.exclude_ambiguous(df))
    t = target_len if isinstance(target_len, Column) else F.lit(int(target_len))
    return df, t
