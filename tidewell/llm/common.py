"""Shared by the operators: input columns, staged tables, Arrow batches and split of labelled rows."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.session import shared_folder

# Rows and bytes of one Arrow batch between the JVM and Python. A text may have megabytes: few rows, and a bound of
# bytes, keep a batch of such texts within a worker's memory.
BATCH_ROWS, BATCH_BYTES = 500, 8 << 20


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches of a session; a smaller bound set by the caller stays."""
    for kind, most in (("Records", BATCH_ROWS), ("Bytes", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.max{kind}PerBatch"
        set_to = spark.conf.get(key).rstrip("b")
        if not (set_to.isdigit() and 0 < int(set_to) <= most):
            spark.conf.set(key, str(most))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """``df`` written to a new folder that all machines share, and read from there.

    What follows starts from the files: a lost executor repeats only the reading.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, fn: Callable[[Iterator[dict]], Iterator[dict]], schema: str | T.StructType) -> DataFrame:
    """Apply ``fn`` to the batches of each partition.

    ``fn`` gets an iterator of dicts of Arrow columns and yields dicts of columns.
    """
    prepare(df.sparkSession)
    columns = df.columns
    out = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = (dict(zip(columns, b.columns)) for b in batches if b.num_rows)
        for made in fn(given):
            yield pa.RecordBatch.from_arrays([as_arrow(made[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, out)


def extended(schema: T.StructType, ddl: str) -> T.StructType:
    """``schema`` with further columns."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(ddl).fields])


def as_arrow(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    if isinstance(values, np.ndarray) and values.dtype == np.uint64:
        values = values.view(np.int64)
    return pa.array(values, type=kind)


def lists_of(flat: np.ndarray, sizes) -> pa.Array:
    """Arrow lists from their values end to end and their sizes."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    values = flat.view(np.int64) if flat.dtype == np.uint64 else flat
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def texts_of(column: pa.Array) -> list[str]:
    """Texts of an Arrow column; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


def share(spark: SparkSession, value) -> Callable:
    """Broadcast ``value``; tasks call what is returned to get it. Its class travels with it."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(sent.value)


def worker_state(name: str, make: Callable):
    """What ``make`` returns, made once per Python worker and kept between its tasks."""
    kept = sys.modules.setdefault("worker_state_of_llm", types.ModuleType("worker_state_of_llm"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)


def bucket_of(doc_id: str | Column) -> Column:
    """crc32 of the id as text, modulo 5: rows at 0 are held out of any fit."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 5


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is held out; a row without an id is never used for a fit."""
    return F.coalesce(bucket_of(doc_id) == 0, F.lit(True))


def least_hashes(df: DataFrame, columns: list[str], most: int, rows: int) -> DataFrame:
    """The ``most`` rows of ``rows`` with the least hashes of their columns.

    Rows whose hash is too large to be among them stay where they are, so about twice
    ``most`` rows are sorted, however many there are.
    """
    value = F.xxhash64(*columns)
    if rows > 4 * most:
        df = df.where(value < F.lit(int(-2 ** 63 + 2 ** 64 * (2 * most / rows))))
    return df.orderBy(value, *columns).limit(most)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have, whatever its extra columns are called."""
    used = {c.lower() for c in df.columns}
    made = []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        made.append(name)
    return made


def new_name(stem: str) -> str:
    return f"{stem}_{uuid.uuid4().hex[:12]}"
