"""Reading and writing tables.

A mutation gives the whole new state of a table. A state is written as its own
run folder and readers take the newest one, so a plan never overwrites the files
it reads, a retried task rewrites only its own folder, and a failed run leaves
the earlier state in place. Rows of a cumulative table lie in the partition of the run
that wrote them.

A state may also be kept by partition: a run then writes the partitions it changes and a list of the
folders that make up the table, and the files of all other partitions stay as they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import date, datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.session import shared_folder

STATE_COLUMN = "state_run"
RUN_COLUMN = "history_run"
CODEC = "zstd"  # of states and of what a load stages: they are written whole at every run


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A Parquet folder when ``name`` looks like a path, else a catalog table."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int,
              partitions: int, **options: str) -> DataFrame:
    """A database table, read by many tasks over ranges of a numeric column."""
    return (spark.read.format("jdbc").options(**options)
            .option("url", url).option("dbtable", table)
            .option("partitionColumn", column).option("numPartitions", partitions)
            .option("lowerBound", lower).option("upperBound", upper).load())


def written(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` written to a new folder that all machines share, and read from there; for what several steps read.

    With ``partition_by`` a step that asks for one value of a key reads its files alone.
    """
    path = shared_folder(df.sparkSession)
    df.write.option("compression", CODEC).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a table, or with ``partition_by`` only the partitions present in ``df``."""
    mode = "dynamic" if partition_by else "static"
    df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*partition_by).parquet(path)


def save_state(df: DataFrame, path: str, run_id: int, partition_by: Sequence[str] = ()) -> None:
    """Write the full state of a table as the folder of this run, also when it is empty.

    With ``partition_by`` (say, client and run year) a load reads its own partition only.

    The run is entered in the table of complete runs last, so a state that a dying job
    left half written is never the newest.
    """
    folder = f"{path}/states/{STATE_COLUMN}={run_id}"
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", CODEC).partitionBy(*partition_by).parquet(folder)
    done = df.sparkSession.range(1).select(F.lit(run_id).cast("bigint").alias(STATE_COLUMN))
    overwrite(done, f"{path}/complete/run={run_id}")


def load_state(spark: SparkSession, path: str, run_id: int | None = None, before: int | None = None) -> DataFrame:
    """State of a given run, or of the newest complete one (before a given run), with the columns of that run.

    Only that run's folder is listed and scanned.
    """
    if run_id is None:
        complete = spark.read.parquet(f"{path}/complete")
        if before is not None:
            complete = complete.where(F.col(STATE_COLUMN) < before)
        run_id = complete.agg(F.max(STATE_COLUMN).alias("run")).first()["run"]
        if run_id is None:
            raise ValueError(f"{path} has no complete run before {before}")
    return spark.read.parquet(f"{path}/states/{STATE_COLUMN}={run_id}")


KEY_BUCKETS = 200  # raise it with the table: a bucket is one task's work


def _bucketed(spark: SparkSession, path: str, run_id: int, schema: T.StructType, key: str, buckets: int) -> str:
    """Catalog entry of a state kept by key; a session that lacks it gets it from what the state says of itself."""
    folder = f"{path}/states/{STATE_COLUMN}={run_id}"
    name = f"by_key_{uuid.uuid5(uuid.NAMESPACE_URL, folder).hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {buckets} BUCKETS LOCATION '{folder}'")
    return name


def save_by_key(df: DataFrame, path: str, run_id: int, key: str, buckets: int = KEY_BUCKETS) -> None:
    """Write the full state of a table bucketed and sorted by a key, as the state of this run.

    Joins and groupings on the key read it where it lies: no exchange on its side. One task writes a bucket.
    """
    spark = df.sparkSession
    name = _bucketed(spark, path, run_id, df.schema, key, buckets)
    df.repartition(buckets, key).write.insertInto(name, overwrite=True)
    row = spark.range(1).select(F.lit(run_id).cast("bigint").alias(STATE_COLUMN), F.lit(df.schema.json()).alias("schema"),
                                F.lit(key).alias("key"), F.lit(buckets).alias("buckets"))
    overwrite(row, f"{path}/complete/run={run_id}")


def load_by_key(spark: SparkSession, path: str, run_id: int | None = None) -> DataFrame:
    """State of a given run, or of the newest complete one, that was saved by key."""
    complete = spark.read.parquet(f"{path}/complete")
    if run_id is not None:
        complete = complete.where(F.col(STATE_COLUMN) == run_id)
    state = complete.orderBy(F.desc(STATE_COLUMN)).first()
    schema = T.StructType.fromJson(json.loads(state["schema"]))
    name = _bucketed(spark, path, state[STATE_COLUMN], schema, state["key"], state["buckets"])
    spark.catalog.refreshTable(name)
    return spark.table(name)


def _folders(spark: SparkSession, path: str, before: int | None) -> tuple[DataFrame, T.StructType] | None:
    """Folder list of the newest complete run (before a given one), and the schema of the table."""
    lists = spark.read.parquet(f"{path}/folders")
    if before is not None:
        lists = lists.where(F.col(STATE_COLUMN) < before)
    newest = lists.agg(F.max(STATE_COLUMN).alias("run")).first()["run"]
    if newest is None:
        return None
    rows = spark.read.parquet(f"{path}/folders/list={newest}").drop(STATE_COLUMN)
    schema = rows.where(F.col("folder").isNull()).select("schema").first()["schema"]
    return rows.where(F.col("folder").isNotNull()).drop("schema"), T.StructType.fromJson(json.loads(schema))


def replace_partitions(df: DataFrame, path: str, run_id: int, keys: Sequence[str], replaced: Mapping | None = None) -> None:
    """Write the rows of ``df`` to a table kept by partitions of ``keys``, and no other file.

    The partition that ``replaced`` names holds the rows of ``df`` alone from then on (also when there are
    none); to any other partition they are added. Files lie in the folder of the run that wrote them,
    and the list of the folders in use is written last. So ``df`` may come from the table itself, a job that
    dies leaves the earlier table in place, and a retry of a run starts from the table before that run.

    The list has one row per partition and run still in use, whatever the number of files or rows.
    """
    spark = df.sparkSession
    run = f"{STATE_COLUMN}={run_id}"
    target = df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", CODEC)
    target.partitionBy(*keys).parquet(f"{path}/parts/{run}")
    written = spark.read.schema(df.schema).parquet(f"{path}/parts/{run}")
    folder = F.regexp_extract(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), f"({run}/.*)/[^/]*$", 1)
    folders = written.select(folder.alias("folder"), *keys).distinct()
    schema, before = df.schema, _folders(spark, path, run_id) if run_id else None
    if before is not None:
        old, known = before
        gone = reduce(and_, [F.col(k).eqNullSafe(F.lit(v)) for k, v in replaced.items()]) if replaced else F.lit(False)
        folders = old.where(~gone).unionByName(folders)
        schema = T.StructType([*known.fields, *[f for f in schema.fields if f.name not in known.names]])
    marker = spark.range(1).select(F.lit(None).cast("string").alias("folder"), F.lit(schema.json()).alias("schema"))
    rows = folders.unionByName(marker, allowMissingColumns=True).withColumn(STATE_COLUMN, F.lit(run_id).cast("bigint"))
    overwrite(rows.coalesce(1), f"{path}/folders/list={run_id}")


def load_partitions(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The table kept by partitions, as of its newest complete run, or of the newest one before a given run.

    Filters on the keys leave whole folders out. Only the folder list passes through the driver.
    """
    found = _folders(spark, path, before)
    if found is None:
        raise ValueError(f"{path} has no complete run before {before}")
    folders, schema = found
    names = sorted(r["folder"] for r in folders.select("folder").collect())
    if not names:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    rows = spark.read.schema(schema).option("basePath", f"{path}/parts").parquet(*[f"{path}/parts/{n}" for n in names])
    return rows.select(*[F.col(f"`{c}`") for c in schema.names])


def write_run(df: DataFrame, path: str, run_id: int, partition_by: Sequence[str] = ()) -> None:
    """Write the rows of a run to a cumulative table; a retry replaces them and adds none twice."""
    overwrite(df.withColumn(RUN_COLUMN, F.lit(run_id)), path, [RUN_COLUMN, *partition_by])


def roll_to_history(current: DataFrame, history_path: str, current_path: str, run_id: int) -> None:
    """Add the current rows to the history of this run, then leave the current table empty.

    ``current`` must be the state of an earlier run: a retry then reads the same rows again.
    """
    write_run(current, history_path, run_id)
    save_state(current.limit(0), current_path, run_id)


def archive(df: DataFrame, as_of: date | datetime, current_path: str, history_path: str, run_id: int,
            stamp: str = "evaluation_date", partition_by: Sequence[str] = ()) -> None:
    """Stamp a snapshot, write it as the current table and add it to the history of its run.

    The current table is read back for the second write, so the rows are computed
    once.
    """
    spark = df.sparkSession
    day = as_of.date() if isinstance(as_of, datetime) else as_of
    overwrite(df.withColumn(stamp, F.lit(day)), current_path)
    write_run(spark.read.parquet(current_path), history_path, run_id, partition_by)


def stamp(df: DataFrame, **values) -> DataFrame:
    """Add run columns (run id, run year, client, load time)."""
    return df.withColumns({n: v if isinstance(v, Column) else F.lit(v) for n, v in values.items()})
