"""Positional CSV folder source (ops 7-10, 16).

Files are read whole with the `binaryFile` source (one file = one run, so a file is the
unit of work), decoded as Latin-1 and cut into records; the record number is the order
key. Columns are bound by position: the i-th non-temperature feature at position i,
`temp*` columns from position 10. Names carry metadata:
`<kind>_<a>_<b>_<part>_..._<valves>.csv`; an NG folder keeps only kind `A`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqflow.functions.scalar import coerce_double, subpart_status, valid_valve

# The first temperature column position and the NG file-name kind.
TEMP_START = 10
NG_KIND = "A"
#: a cell: quoted text and what follows it, or text up to a comma or line break; possessive, so long cells need no stack
CELL = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,\n]*+|[^,\n]*+)'
RECORD = rf"({CELL}(?:,{CELL})*+)(?:\n|\z)"
DEFAULT_SCHEMA = ("device", "part_number", "subpart_no", "machine_position", "third_param", "second_param",
                  "first_param", "temp_a", "temp_b")


def column_positions(schema: Sequence[str]) -> list[tuple[int, str]]:
    """(position, name) for the feature columns of `schema` (device / part excluded)."""
    feats = [c for c in schema if c not in ("device", "part_number")]
    out, temp = [], TEMP_START
    for i, c in enumerate(feats):
        if "temp" in c:
            out.append((temp, c))
            temp += 1
        else:
            if i >= TEMP_START:
                raise ValueError(f"feature {c!r} at position {i} collides with the temperature positions")
            out.append((i, c))
    return out


def list_csv(spark: SparkSession, folder: str, files_type: str) -> DataFrame:
    """Op 7: files `*.csv` under `folder` (path, name, content); NG keeps names of kind A, and
    files of other kinds are not read. A file is one run and must fit in a cell: Spark refuses
    files over `spark.sql.sources.binaryFile.maxLength` (2 GB) by name."""
    glob = f"{NG_KIND}_*.csv" if files_type == "NG" else "*.csv"
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", "true").load(folder))
    return df.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "content")


def file_metadata(files: DataFrame, files_type: str) -> DataFrame:
    """Op 9: part number = 4th name token (extension stripped), NG valve text = last
    token up to the first '.'; names with fewer than 4 tokens are skipped."""
    tok = F.split("name", "_")
    part = F.substring_index(F.get(tok, 3), ".csv", 1)
    valve = F.substring_index(F.element_at(tok, -1), ".", 1) if files_type == "NG" else F.lit(None).cast("string")
    return files.where(F.size(tok) > 3).withColumns({"part_number": part, "valve_raw": valve})


def read_positional(files: DataFrame, schema: Sequence[str] = DEFAULT_SCHEMA, header_rows: int = 1) -> DataFrame:
    """Op 8: Latin-1 text, skip `header_rows + 1` records and blank lines, bind by position.
    Adds `line_no` (0-based number of the record) as the order key within a file; cells stay text (see op 10). Quoted
    cells may hold commas, doubled quotes and line breaks; a quote inside an unquoted cell, or one that is never closed,
    is text."""
    text = F.decode(F.col("content"), "ISO-8859-1")
    keep = [c for c in files.columns if c != "content"]
    records = F.transform(F.regexp_extract_all(text, F.lit(RECORD), 1), lambda r: F.regexp_replace(r, "\r$", ""))
    lines = files.select(*keep, F.posexplode(records).alias("line_no", "line"))
    lines = lines.where((F.col("line_no") > header_rows) & (F.trim(F.col("line")) != ""))
    places = column_positions(schema)
    width = max(pos for pos, _ in places) + 1
    cells = F.from_csv(F.col("line"), ", ".join(f"c{i} STRING" for i in range(width)), {"escape": '"'})
    lines = lines.select(*keep, "line_no", cells.alias("__sf_cells"))
    return lines.select(*keep, "line_no", *[F.col(f"__sf_cells.c{pos}").alias(name) for pos, name in places])


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Op 10: every feature column to DOUBLE; unparsable -> NULL (never float32)."""
    return df.withColumns({c: coerce_double(c) for c in columns if c in df.columns})


def folder_ingest(
    spark: SparkSession,
    folder: str,
    files_type: str,
    device: str,
    schema: Sequence[str] = DEFAULT_SCHEMA,
    header_rows: int = 1,
    source_rank: int = 0,
) -> DataFrame:
    """Op 16: list -> metadata -> positional read -> valve check -> label -> coerce.

    One distributed read of the folder. Output: source_rank, path, line_no (order key),
    device, part_number, features..., ng_valve_no, subpart_label."""
    return ingest_files(list_csv(spark, folder, files_type), files_type, device, schema, header_rows, source_rank)


def ingest_files(
    listed: DataFrame,
    files_type: str,
    device: str,
    schema: Sequence[str] = DEFAULT_SCHEMA,
    header_rows: int = 1,
    source_rank: int = 0,
) -> DataFrame:
    """Op 16 on files (path, name, content) from any listing, batch or stream."""
    if files_type not in ("OK", "NG"):
        raise ValueError("files_type must be 'OK' or 'NG'")
    feats = [name for _, name in column_positions(schema)]
    rows = read_positional(file_metadata(listed, files_type), schema, header_rows)
    rows = coerce_numeric(rows, feats)
    valve = valid_valve("valve_raw")
    label = subpart_status(F.lit(files_type), valve, "subpart_no")
    return rows.select(F.lit(source_rank).alias("source_rank"), "path", "line_no", F.lit(device).alias("device"),
                       "part_number", *feats, valve.alias("ng_valve_no"), label.alias("subpart_label"))
