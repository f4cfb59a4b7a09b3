"""Arriving files: listing, sizes and record counts, for any number and size of files.

Tasks list the watched locations and read the files; the driver sees neither names nor contents. Files without
content, which a scan passes over, are listed like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RANGE = 64 << 20  # bytes of a file that one row of work reads
CHUNK = 4 << 20  # bytes read at a time
ROWS = 10_000  # files of one batch of a listing

FILE = "path string, folder string, file_name string, file_size bigint, modificationTime timestamp"


def store_of(root: str) -> tuple[fs.FileSystem, str]:
    """File system of a root, a path or a URI, and the root's path in it."""
    if "://" not in root and not root.startswith("file:"):
        return fs.LocalFileSystem(), root.rstrip("/")
    if root.startswith("file:"):
        return fs.LocalFileSystem(), "/" + root.removeprefix("file:").strip("/")
    store, base = fs.FileSystem.from_uri(root)
    return store, base.rstrip("/")


def walk(store: fs.FileSystem, folder: str) -> Iterator[fs.FileInfo]:
    """Files in and below a folder, one folder at a time; names that begin with . or _ are passed over, as scans do."""
    folders = [folder]
    while folders:
        for info in store.get_file_info(fs.FileSelector(folders.pop(), allow_not_found=True)):
            hidden = info.base_name.startswith(".") or info.base_name.startswith("_") and "=" not in info.base_name
            if hidden:
                continue
            if info.type == fs.FileType.Directory:
                folders.append(info.path)
            elif info.type == fs.FileType.File:
                yield info


def list_files(locations: DataFrame, root: str) -> DataFrame:
    """Files in and below each distinct ``location`` (a path below ``root``), and no others.

    ``folder`` is the whole path between ``root`` and the file name. A task lists the locations dealt
    to it; absent ones have no files.
    """
    schema = pa.schema([("location", pa.string()), ("path", pa.string()), ("folder", pa.string()), ("file_name", pa.string()),
                        ("file_size", pa.int64()), ("modificationTime", pa.timestamp("us", "UTC"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_of(root)
        rows: list[tuple] = []
        for batch in batches:
            for location in batch.column(0).to_pylist():
                for info in walk(store, f"{base}/{location}".rstrip("/")):
                    folder = info.path[len(base) + 1:len(info.path) - len(info.base_name)].rstrip("/")
                    rows.append((location, info.path, folder, info.base_name, info.size, info.mtime))
                    if len(rows) == ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return _dealt(locations.select("location").distinct(), "location").mapInArrow(run, f"location string, {FILE}")


def _dealt(df: DataFrame, *columns: str) -> DataFrame:
    """Rows dealt to tasks by columns; a few small rows may stand for much work, so they aren't put together."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def discover_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Files below ``root`` whose name fits the pattern; contents are not read."""
    everywhere = spark.range(1).select(F.lit("").alias("location"))
    return list_files(everywhere, root).where(F.rlike("file_name", glob_to_regex(F.lit(pattern)))).drop("location")


def line_ends(files: DataFrame, root: str) -> DataFrame:
    """(path, line_ends) of the files (path, file_size); large files are read in ranges by several tasks."""
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("file_size") - 1, F.lit(RANGE).cast("bigint")))
    ranges = files.where("file_size > 0").select("path", "file_size").distinct().select("path", starts.alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = store_of(root)
        for batch in batches:
            found = []
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                count, left = 0, RANGE
                with store.open_input_file(path) as file:
                    file.seek(start)
                    while left and (data := file.read(min(left, CHUNK))):
                        count += data.count(b"\n")
                        left -= len(data)
                found.append(count)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["path", "line_ends"])

    counted = _dealt(ranges, "path", "start").mapInArrow(run, "path string, line_ends bigint")
    return counted.groupBy("path").agg(F.sum("line_ends").alias("line_ends"))


def with_counts(files: DataFrame, root: str) -> DataFrame:
    """Files with the number of their records: line ends less one for the header, and not below zero.

    Counts are of stored bytes, so compressed files should be unpacked first.
    """
    counts = line_ends(files, root)
    records = F.greatest(F.coalesce("line_ends", F.lit(0)) - 1, F.lit(0)).cast("bigint")
    return files.join(counts, "path", "left").withColumn("record_count", records).drop("line_ends")


def file_stats(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Name, folder, size and record count of each file; empty files are kept."""
    return with_counts(discover_files(spark, root, pattern), root).select(
        "path", "folder", "file_name", "file_size", "record_count", "modificationTime")


def glob_to_regex(pattern: Column) -> Column:
    """Shell pattern in a column to an anchored regular expression."""
    escaped = F.regexp_replace(pattern, r"([\\.^$+{}()|])", r"\\$1")
    stars = F.replace(F.replace(escaped, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit("."))
    return F.concat(F.lit("^(?s:"), F.replace(stars, F.lit("[!"), F.lit("[^")), F.lit(")$"))
