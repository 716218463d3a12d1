"""Op 76 for positional CSV folders: new files are ingested as they arrive.

Before a batch, tasks list the drop folders, one folder each, and write the paths that were not listed before to tables in
the checkpoint (`listed`), by a join on the path; the stream reads these tables, a row per file, and tasks open the files. So
the driver holds a name per drop folder and per `LISTED_ROWS` files, none per file, and a file is read once over all
restarts. A file that is sent again under another path (same name, same content) is dropped as long as its modification time
is within `resend` of the newest one seen; that state holds a name and a digest per file and is cleared behind the
watermark. Everything after the listing is the batch ingest, so a stream over any number of drops gives the rows of
one batch read of all files.

Folders in stores that Arrow can't open, and checkpoints that were begun without a listing, are read through Spark's file
source (`new_files`), whose driver keeps an entry for every file.

Defined cases: files of other kinds or with fewer than four name tokens are not ingested; a file that is changed in
place under its old path is not read again; a file with the same name and another content is a file of its own; empty
files give no rows; hidden files and folders (`_x`, `.x`, `x._COPYING_`) are not listed, as in Spark's readers; a file that is
gone when its batch runs gives no rows; a file over `spark.sql.sources.binaryFile.maxLength` fails the query by name.
"""

from __future__ import annotations

import os
import threading
from collections.abc import Iterator, Sequence
from fnmatch import fnmatchcase
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seqflow.sources import csv_folder as CSV

LISTING, DEFAULT_LISTING, LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism", "10000", "64"
FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
MAX_LENGTH, DEFAULT_MAX_LENGTH = "spark.sql.sources.binaryFile.maxLength", str(2**31 - 1)
#: a listed file: `root` (a URI that Arrow opens) and `rel` say where it is, `path` how Spark names it; times in microseconds
LISTED_SCHEMA = "path STRING, micros BIGINT, length BIGINT, root STRING, rel STRING"
LISTED_ROWS = 1000  # files in a table of the listing
BATCH_BYTES = 8 << 20  # of contents that a task hands on at once
EVERY_S = 60  # a query that goes on lists so often


def few_listing_tasks(spark: SparkSession) -> None:
    """Unless the session sets a number of its own, a batch's files are looked up by `LISTING_TASKS` tasks (Spark's default
    is one task a file, each with a result of some KB for the driver). The file source reads the session's setting
    while the query runs, so it stays."""
    if spark.conf.get(LISTING, DEFAULT_LISTING) == DEFAULT_LISTING:
        spark.conf.set(LISTING, LISTING_TASKS)


def name_glob(files_type: str) -> str:
    return f"{CSV.NG_KIND}_*.csv" if files_type == "NG" else "*.csv"


def once(files: DataFrame, resend: str) -> DataFrame:
    """(path, name, content) of a stream of files (path, modificationTime, content), each name and content once."""
    files = files.withWatermark("modificationTime", resend)
    files = files.select("path", "modificationTime", F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    kept = files.withColumn("__sf_digest", F.sha2("content", 256)).dropDuplicatesWithinWatermark(["name", "__sf_digest"])
    return kept.select("path", "name", "content")


def new_files(spark: SparkSession, folder: str, files_type: str, resend: str = "7 days", max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of files (path, name, content), each name and content once, through Spark's file source. `folder` may be a glob
    of drop folders."""
    few_listing_tasks(spark)
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", name_glob(files_type)).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return once(reader.load(folder), resend)


def _matches(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(name, URI) of the files and folders that a path or glob stands for."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    # Java leaves letters beyond ASCII as they are in a URI, Arrow doesn't read them
    return [(x.getPath().toString(), quote(x.getPath().toUri().toString(), safe="%/:?#[]@!$&'()*+,;=")) for x in found or []]


def _opens(uri: str) -> bool:
    try:
        pafs.FileSystem.from_uri(uri)
    except (OSError, ValueError, NotImplementedError):  # ArrowInvalid is a ValueError
        return False
    return True


def _hidden(name: str) -> bool:
    """As Spark's readers see it."""
    return (name.startswith("_") and "=" not in name and not name.startswith(("_metadata", "_common_metadata"))) or name.startswith(".") or name.endswith("._COPYING_")


def _walk(uri: str) -> Iterator[tuple[str, int, int]]:
    """(path below `uri`, time in microseconds, length) of the files in a folder and its folders, or of a file: ''."""
    store, top = pafs.FileSystem.from_uri(uri)
    info = store.get_file_info(top)
    if info.type == pafs.FileType.File:
        yield "", info.mtime_ns // 10**6 * 1000, info.size
        return
    folders = [""] if info.type == pafs.FileType.Directory else []
    while folders:
        at = folders.pop()
        if isinstance(store, pafs.LocalFileSystem):  # read on as it is asked for; Arrow lists a folder as a whole
            try:
                with os.scandir(f"{top}/{at}") as entries:
                    for e in entries:
                        if _hidden(e.name):
                            continue
                        try:
                            if e.is_dir():
                                folders.append(f"{at}{e.name}/")
                            else:
                                s = e.stat()
                                yield at + e.name, s.st_mtime_ns // 10**6 * 1000, s.st_size
                        except FileNotFoundError:
                            continue
            except FileNotFoundError:
                continue
        else:
            for i in store.get_file_info(pafs.FileSelector(f"{top}/{at}".rstrip("/"), allow_not_found=True)):
                if _hidden(i.base_name):
                    continue
                if i.type == pafs.FileType.Directory:
                    folders.append(f"{at}{i.base_name}/")
                else:
                    yield at + i.base_name, i.mtime_ns // 10**6 * 1000, i.size


def found_files(spark: SparkSession, roots: list[tuple[str, str]], glob: str) -> DataFrame:
    """The files (`LISTED_SCHEMA`) under some folders (name, URI), a task each, whose names match."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            path, micros, length, root, rel = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(path, pa.string()), pa.array(micros, pa.int64()), pa.array(length, pa.int64()), pa.array(root, pa.string()),
                                               pa.array(rel, pa.string())], names=["path", "micros", "length", "root", "rel"])

        rows = []
        for b in batches:
            for name, uri in zip(b.column("name").to_pylist(), b.column("uri").to_pylist(), strict=True):
                for rel, micros, length in _walk(uri):
                    path = f"{name.rstrip('/')}/{rel}" if rel else name
                    if fnmatchcase(path.rpartition("/")[2], glob):
                        rows.append((path, micros, length, uri, rel))
                    if len(rows) == 10_000:
                        yield batch(rows)
                        rows = []
        if rows:
            yield batch(rows)

    folders = spark.createDataFrame(spark.sparkContext.parallelize(roots, max(len(roots), 1)), "name STRING, uri STRING")
    return folders.mapInArrow(run, LISTED_SCHEMA)


def list_new(spark: SparkSession, folder: str, files_type: str, listed: str, max_files_per_trigger: int | None = None) -> None:
    """Appends the files under `folder` that `listed` doesn't have; nothing, if there are none. A run that ends early leaves
    whole tables or none, and the next one adds the rest."""
    found = found_files(spark, _matches(spark, folder), name_glob(files_type)).dropDuplicates(["path"])
    if _matches(spark, f"{listed}/kind=*"):
        seen = spark.read.schema(LISTED_SCHEMA).parquet(f"{listed}/kind=*").select("path")
        found = found.join(seen.hint("merge"), "path", "left_anti")  # never broadcast: a row per file
    found = found.withColumn("kind", F.lit(files_type))
    if max_files_per_trigger:  # batches take the tables by age, and files are to come by age
        found = found.repartition(1).sortWithinPartitions("kind", "micros", "path")
    # a partitioned write without rows leaves no file
    rows = min(max_files_per_trigger or LISTED_ROWS, LISTED_ROWS)
    found.write.mode("append").partitionBy("kind").option("maxRecordsPerFile", rows).parquet(listed)


def listed_files(spark: SparkSession, listed: str, resend: str = "7 days", max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of files (path, name, content), each name and content once, from the tables of `list_new`."""
    few_listing_tasks(spark)
    reader = spark.readStream.schema(LISTED_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max(1, max_files_per_trigger // LISTED_ROWS)))
    most = int(spark.conf.get(MAX_LENGTH, DEFAULT_MAX_LENGTH))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stores: dict[str, tuple[pafs.FileSystem, str]] = {}

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            path, micros, content = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(path, pa.string()), pa.array(micros, pa.int64()), pa.array(content, pa.binary())], names=["path", "micros", "content"])

        rows, size = [], 0
        for b in batches:
            for path, micros, root, rel in zip(*(b.column(c).to_pylist() for c in ("path", "micros", "root", "rel")), strict=True):
                if root not in stores:
                    stores[root] = pafs.FileSystem.from_uri(root)
                store, top = stores[root]
                try:
                    with store.open_input_file(f"{top.rstrip('/')}/{rel}" if rel else top) as f:
                        if f.size() > most:
                            raise ValueError(f"{path} has {f.size()} bytes, more than {MAX_LENGTH} ({most})")
                        content = f.read()
                except FileNotFoundError:
                    continue
                if rows and size + len(content) > BATCH_BYTES:
                    yield batch(rows)
                    rows, size = [], 0
                rows.append((path, micros, content))
                size += len(content)
        if rows:
            yield batch(rows)

    files = reader.parquet(f"{listed}/kind=*").mapInArrow(read, "path STRING, micros BIGINT, content BINARY")
    return once(files.select("path", F.timestamp_micros("micros").alias("modificationTime"), "content"), resend)


def lists(spark: SparkSession, folder: str, checkpoint_dir: str, listed: str) -> bool:
    """Whether tasks list the folders: as the checkpoint was begun; a new one's, if Arrow opens all folders. A path that is
    no glob and doesn't exist is left to the file source, which says so."""
    if _matches(spark, listed) or _matches(spark, f"{checkpoint_dir.rstrip('/')}/sources"):
        return bool(_matches(spark, listed))
    roots = _matches(spark, folder)
    return all(_opens(uri) for _, uri in roots) and bool(roots or any(c in folder for c in "*?[{"))


def start_folder_ingest(spark: SparkSession, folder: str, files_type: str, device: str, sink_dir: str, checkpoint_dir: str,
                        schema: Sequence[str] = CSV.DEFAULT_SCHEMA, header_rows: int = 1, source_rank: int = 0, resend: str = "7 days",
                        available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Appends the rows of new files to a Parquet sink; exactly once through the checkpoint. `max_files_per_trigger` bounds
    the files of a batch."""
    listed = f"{checkpoint_dir.rstrip('/')}/listed"
    if lists(spark, folder, checkpoint_dir, listed):
        list_new(spark, folder, files_type, listed, max_files_per_trigger)
        files = listed_files(spark, listed, resend, max_files_per_trigger)
    else:
        listed, files = "", new_files(spark, folder, files_type, resend, max_files_per_trigger)
    rows = CSV.ingest_files(files, files_type, device, schema, header_rows, source_rank)
    w = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint_dir).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    query = w.start(sink_dir)
    if listed and not available_now:
        threading.Thread(target=_keep_listing, args=(query, spark, folder, files_type, listed, max_files_per_trigger), daemon=True).start()
    return query


def _keep_listing(query: StreamingQuery, spark: SparkSession, *what) -> None:
    """Lists while the query goes on; a listing that fails ends it."""
    try:
        while not query.awaitTermination(EVERY_S):
            list_new(spark, *what)
    except Exception:
        if query.isActive:
            query.stop()
        raise
