"""Op 77 with runs closed by event time: state for open runs only, no pending table.

The rows of a run may fall into several micro-batches, and the length filter, the indices and the windows need whole
runs. A run is all rows of a part without a silence of more than `gap`; it is closed when the watermark (the newest event
time less `delay`) has passed its last row by the gap, and its rows then leave the state, all in one micro-batch. The
state, kept by Spark's state store under the query's checkpoint, has one entry per part with open runs; a run of more
than `max_rows` rows, which the length filter drops in any case, keeps its bounds and count but no rows.

Defined cases: rows that come later than the watermark are dropped by Spark; a row that bridges two open runs makes them
one; rows of a part whose run is closed open another run; rows without a part only move the watermark (`clock_row` makes
one that closes all runs before a time), rows without a time are dropped; repeated rows are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import datetime, timedelta

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from seqflow.operators.prepare import PART
from seqflow.streaming.score import score_batch

RUN_START = "run_start"
STATE = "starts array<long>, ends array<long>, counts array<long>, blocks array<array<binary>>"
_MS = "__sf_ms"


def _dump(pdf: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(pdf, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def _load(blocks: Sequence[bytes]) -> pd.DataFrame:
    return pd.concat([pa.ipc.open_stream(b).read_all().to_pandas() for b in blocks], ignore_index=True)


def merge_runs(runs: list[tuple[int, int, int, list[bytes]]], gap: int, max_rows: int | None) -> list[tuple[int, int, int, list[bytes]]]:
    """Runs (start, end, count, blocks of rows) that are at most `gap` apart become one."""
    out: list[tuple[int, int, int, list[bytes]]] = []
    for start, end, n, blocks in sorted(runs, key=lambda r: r[:2]):
        if out and start <= out[-1][1] + gap:
            a, b, m, held = out.pop()
            start, end, n, blocks = a, max(b, end), m + n, [*held, *blocks]
        out.append((start, end, n, blocks if max_rows is None or n <= max_rows else []))
    return out


def closed_runs(stream: DataFrame, time_col: str, delay: str, gap: timedelta, max_rows: int | None = None, key: str = PART) -> DataFrame:
    """The rows of closed runs, with `run_start`, the time of the run's first row."""
    schema, gap_ms = stream.schema, int(gap.total_seconds() * 1000)
    out_schema = T.StructType([*schema.fields, T.StructField(RUN_START, T.LongType())])

    def step(part: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        runs = [(a, b, n, [bytes(x) for x in blocks]) for a, b, n, blocks in zip(*state.get, strict=True)] if state.exists else []
        if not state.hasTimedOut:
            for pdf in frames:
                pdf = pdf.sort_values(_MS, kind="stable")
                ms = pdf[_MS].to_numpy()
                cuts = [0, *(i for i in range(1, len(ms)) if ms[i] - ms[i - 1] > gap_ms), len(ms)]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    if a < b:
                        runs.append((int(ms[a]), int(ms[b - 1]), b - a, [_dump(pdf.iloc[a:b].drop(columns=[_MS]))]))
                runs = merge_runs(runs, gap_ms, max_rows)
        mark = state.getCurrentWatermarkMs()
        for start, _, _, blocks in (r for r in runs if r[1] + gap_ms < mark):
            if blocks:
                rows = _load(blocks)
                rows[RUN_START] = start
                yield rows
        runs = [r for r in runs if r[1] + gap_ms >= mark]
        if runs:
            state.update(tuple(list(c) for c in zip(*runs, strict=True)))
            state.setTimeoutTimestamp(min(r[1] for r in runs) + gap_ms + 1)
        elif state.exists:
            state.remove()

    marked = stream.withColumn(_MS, F.unix_millis(F.col(time_col))).withWatermark(time_col, delay)
    # one condition on the part and the time: without the time in it, the optimizer would move it below the watermark
    usable = F.least(F.col(key).isNotNull().cast("int"), F.col(time_col).isNotNull().cast("int")) == 1
    return (marked.where(usable).groupBy(key)
            .applyInPandasWithState(step, out_schema, STATE, "append", "EventTimeTimeout"))


def clock_row(spark: SparkSession, schema: T.StructType, time_col: str, at: datetime) -> DataFrame:
    """A row without a part: appended to the source, it moves the watermark to `at` less the delay."""
    row = {f.name: at if f.name == time_col else None for f in schema.fields}
    return spark.createDataFrame([tuple(row.values())], T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields]))


def score_closed(batch: DataFrame, order_by: Sequence[str | Column], target_len: int, steps: int,
                 scorer: Callable[[DataFrame], DataFrame] | None = None, n_subparts: int = 6) -> DataFrame:
    """`score_batch` on the rows of closed runs. Runs of the same part that were closed at once are scored one by one."""
    turn = F.dense_rank().over(Window.partitionBy(PART).orderBy(RUN_START))
    runs = batch.select(PART, RUN_START).distinct().withColumn("__sf_turn", turn)
    most = runs.agg(F.max("__sf_turn")).first()[0] or 1
    names = [c for c in batch.columns if c != RUN_START]
    job = (order_by, target_len, steps, scorer, n_subparts)
    if most == 1:
        return score_batch(batch.select(names), *job)
    rows = batch.join(runs, [PART, RUN_START])
    out = [score_batch(rows.where(F.col("__sf_turn") == k).select(names), *job) for k in range(1, most + 1)]
    whole = out[0]
    for df in out[1:]:
        whole = whole.unionByName(df)
    return whole


def start_scoring_runs(stream: DataFrame, sink_dir: str, checkpoint_dir: str, time_col: str, delay: str, gap: timedelta,
                       order_by: Sequence[str | Column], target_len: int, steps: int,
                       scorer: Callable[[DataFrame], DataFrame] | None = None, n_subparts: int = 6, available_now: bool = True) -> StreamingQuery:
    """Prepares, extends and scores runs as they close. Each micro-batch writes its own `batch_id=` partition, so a batch
    that is run again after a failure replaces its output; the state is restored from the checkpoint."""
    sink, longest = sink_dir.rstrip("/"), int(n_subparts * steps * 1.1)  # the length filter's own limit

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                return
            out = score_closed(batch, order_by, target_len, steps, scorer, n_subparts)
            out.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    w = closed_runs(stream, time_col, delay, gap, longest).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
