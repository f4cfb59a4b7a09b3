"""File arrival as a stream: polls in batches whose results are kept once, however often a batch is repeated.

Spark's file source knows a file by its path alone and would never read one again that was empty when first seen.
So a clock drives the batches, each lists the watched locations on the executors, and a table of file facts remembers
which contents were counted: a file is known by path, size and time. Only files whose content is new are read.

What a batch writes lies in its own folder or state, and batches build on those before them only. A batch that is
repeated after a failure replaces what it wrote, and one in the ledger of finished batches is passed over.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewell.params import RunParams
from tidewell.plans.arrivals import Arrival, arrived_files, file_arrival, ready_entries
from tidewell.sources.files import FILE, discover_files, with_counts
from tidewell.sources.tables import load_state, overwrite, save_state

EMPTY_BATCH = -1  # batch under which files without content are listed
NO_BATCH = -1  # stands in a new ledger
FACTS = f"{FILE}, record_count bigint"
TABLES = ("files", "config", "control", "history", "report")
KNOWN_BY = ("path", "file_size", "modificationTime")


def clock(spark: SparkSession) -> DataFrame:
    """One row a batch; ``trigger`` sets the pace, once for all or every so many seconds."""
    return spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()


def started(spark: SparkSession, poll: Callable[[DataFrame, int], None], checkpoint: str, every: str | None) -> StreamingQuery:
    pace = {"processingTime": every} if every else {"availableNow": True}
    return clock(spark).writeStream.foreachBatch(poll).option("checkpointLocation", checkpoint).trigger(**pace).start()


# ---- facts ----------------------------------------------------------------------

def facts_before(spark: SparkSession, target: str, batch_id: int) -> DataFrame:
    """Facts of files with content, as batches before the given one wrote them."""
    return spark.read.schema(f"{FACTS}, batch_id bigint").parquet(target).where(
        (F.col("batch_id") > EMPTY_BATCH) & (F.col("batch_id") < batch_id))


def stream_facts(spark: SparkSession, target: str) -> DataFrame:
    """Facts of each file as it was last seen."""
    rows = spark.read.schema(f"{FACTS}, batch_id bigint").parquet(target)
    names = [c for c in rows.columns if c != "path"]
    order = ["modificationTime", "batch_id"]
    best = rows.groupBy("path").agg(F.max(F.struct(*order, *[c for c in names if c not in order])).alias("best"))
    return best.select("path", *[F.col("best")[c].alias(c) for c in names])


def write_facts(listed: DataFrame, root: str, target: str, batch_id: int) -> None:
    """Count the files whose content is new, and list the empty ones anew.

    An empty file that gains content leaves the list of empty ones and is counted.
    """
    spark = listed.sparkSession
    names = [f.split()[0] for f in FACTS.split(", ")]
    full = listed.where("file_size > 0")
    if batch_id:
        full = full.join(facts_before(spark, target, batch_id).select(*KNOWN_BY), list(KNOWN_BY), "left_anti")
    overwrite(with_counts(full, root).select(*names), f"{target}/batch_id={batch_id}")
    empty = listed.where("file_size = 0").withColumn("record_count", F.lit(0).cast("bigint"))
    overwrite(empty.select(*names), f"{target}/batch_id={EMPTY_BATCH}")


def stream_file_facts(spark: SparkSession, root: str, target: str, checkpoint: str, pattern: str = "*",
                      every: str | None = None) -> StreamingQuery:
    """Write the facts of all files below a root whose content was not counted before, then stop (or go on ``every`` so often)."""

    def poll(_: DataFrame, batch_id: int) -> None:
        write_facts(discover_files(spark, root, pattern), root, target, batch_id)

    return started(spark, poll, checkpoint, every)


# ---- the whole poll -------------------------------------------------------------

def start_tables(target: str, config: DataFrame, control: DataFrame, history: DataFrame) -> None:
    """Make the tables that polls carry on: configuration, queue and history."""
    spark = config.sparkSession
    for name, df in (("config", config), ("control", control), ("history", history)):
        save_state(df, f"{target}/{name}", 0)
    overwrite(spark.createDataFrame([], FACTS), f"{target}/facts/batch_id={NO_BATCH}")
    overwrite(ledger_row(spark, datetime(1900, 1, 1)), f"{target}/ledger/batch_id={NO_BATCH}")


def ledger_row(spark: SparkSession, when: datetime) -> DataFrame:
    return spark.range(1).select(F.lit(when).cast("timestamp_ntz").alias("polled_at"))


def finished(spark: SparkSession, target: str) -> DataFrame:
    """Ledger of finished batches: batch_id, polled_at."""
    rows = spark.read.schema("polled_at timestamp_ntz, batch_id bigint").parquet(f"{target}/ledger")
    return rows.where(F.col("batch_id") > NO_BATCH)


def poll_once(spark: SparkSession, root: str, target: str, batch_id: int, p: RunParams) -> None:
    """One poll from the tables before the batch to those after it."""
    run = batch_id + 1
    config, control, history = (load_state(spark, f"{target}/{name}", before=run) for name in ("config", "control", "history"))
    counted = facts_before(spark, f"{target}/facts", batch_id).join(finished(spark, target), "batch_id", "left_semi")
    counted = counted.select(*KNOWN_BY, "record_count").distinct()
    found = arrived_files(root, ready_entries(config, control, p.env), counted)
    names = [f.split()[0] for f in FACTS.split(", ")]
    # Written first and read back, so that all tables follow from one listing.
    overwrite(found.select("pmd_client_id", "filetype", "filename", "filelocation", *names), f"{target}/found/batch_id={batch_id}")
    found = spark.read.parquet(f"{target}/found/batch_id={batch_id}")
    overwrite(found.select(*names).distinct(), f"{target}/facts/batch_id={batch_id}")
    after: Arrival = file_arrival(root, config, control, history, p, found)
    for name in TABLES:
        save_state(getattr(after, name), f"{target}/{name}", run)
    overwrite(ledger_row(spark, p.as_of), f"{target}/ledger/batch_id={batch_id}")


def stream_arrivals(spark: SparkSession, root: str, target: str, checkpoint: str, p: RunParams,
                    now: Callable[[int], datetime] | None = None, every: str | None = None) -> StreamingQuery:
    """Poll the watched locations in batches and carry configuration, queue, history and report on.

    ``start_tables`` makes the tables first. ``now`` gives the time of a batch, the clock's if left out.
    """

    def poll(_: DataFrame, batch_id: int) -> None:
        if finished(spark, target).where(F.col("batch_id") == batch_id).count():
            return
        when = now(batch_id) if now else datetime.now()
        poll_once(spark, root, target, batch_id, replace(p, as_of=when))

    return started(spark, poll, checkpoint, every)


def arrivals(spark: SparkSession, target: str, name: str) -> DataFrame:
    """Table ``name`` (of ``TABLES``) after the last finished poll."""
    last = finished(spark, target).agg(F.max("batch_id").alias("batch_id")).first()["batch_id"]
    return load_state(spark, f"{target}/{name}", last + 1)
