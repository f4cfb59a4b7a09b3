"""File arrival: new files to file facts, queue, history and report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions import dates
from tidewell.operators.changes import update_from
from tidewell.operators.matching import only_new
from tidewell.params import RunParams
from tidewell.plans.runs import history_upsert, queue_clients
from tidewell.sources.files import glob_to_regex, list_files, with_counts
from tidewell.sources.tables import written
from tidewell.sources.watch import active_watch_config, html_report, location_column


@dataclass(frozen=True)
class Arrival:
    """Everything a poll of the watched folders produces."""

    files: DataFrame
    config: DataFrame
    control: DataFrame
    history: DataFrame
    report: DataFrame


def ready_entries(config: DataFrame, control: DataFrame, env: str) -> DataFrame:
    """Watched entries of clients that have no run in progress."""
    busy = control.where(F.col("process_ind"))
    return only_new(active_watch_config(config, env), busy, [("pmd_client_id", "pmdclientid")], null_safe=True)


def watched(entries: DataFrame) -> DataFrame:
    """Entries with ``location``, the path below the root that they watch."""
    wanted = entries.select("pmd_client_id", "filetype", "filename", "filelocation")
    return wanted.withColumn("location", F.regexp_replace("filelocation", "^/+|/+$", ""))


def match_files(files: DataFrame, entries: DataFrame) -> DataFrame:
    """Files of each location with the clients that watch it and whose name pattern they fit.

    A location is a path of any depth. It holds the files in it and below it; below it,
    as the watched store lists them, the path too must begin as the pattern does.
    """
    pairs = files.join(watched(entries), "location")
    rest = F.substring(F.concat_ws("/", "folder", "file_name"), F.length("location") + 2, F.lit(1 << 30))
    head = F.regexp_extract("filename", r"^[^*?\[]*", 0)
    fits = F.rlike("file_name", glob_to_regex(F.col("filename"))) & F.startswith(rest, head)
    return pairs.where(fits).drop("location")


ARRIVED = ("pmd_client_id", "filetype", "filename", "filelocation", "file_name", "file_size", "record_count")


def arrived_files(root: str, entries: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """New files of the watched locations with their record counts; no other folder is listed, no other file read.

    ``counted`` has record counts of files that were read before (path, file_size, modificationTime, record_count).
    """
    found = match_files(list_files(watched(entries), root), entries)
    if counted is None:
        return with_counts(found, root)
    same = ["path", "file_size", "modificationTime"]
    known = found.join(counted.select(*same, "record_count"), same)
    return known.unionByName(with_counts(found.join(counted, same, "left_anti"), root))


def count_waiting(config: DataFrame, found: DataFrame, p: RunParams) -> DataFrame:
    """Config entries with the number of their new files and the time of this poll."""
    counts = found.groupBy("pmd_client_id", "filename").agg(F.count(F.lit(1)).cast("int").alias("n_files"))
    counts = counts.withColumn("received", dates.moment(p.as_of))
    return update_from(config, counts, ["pmd_client_id", "filename"],
                       {"unprocessed_filecount": "n_files", "lastdatereceived": "received"})


def file_arrival(root: str, config: DataFrame, control: DataFrame, history: DataFrame, p: RunParams,
                 found: DataFrame | None = None) -> Arrival:
    """One poll: each client is queued by its own files only.

    The files are listed once and written to the shared folder, so that all tables tell of the same files.
    ``found`` are files that were listed before.
    """
    if found is None:
        found = written(arrived_files(root, ready_entries(config, control, p.env)))
    new_config = count_waiting(config, found, p)
    located = new_config.withColumn("filelocation", F.col(location_column(p.env)))
    return Arrival(
        files=found.select(*ARRIVED),
        config=new_config,
        control=queue_clients(control, found.select("pmd_client_id").distinct(), p),
        history=history_upsert(history, located),
        report=html_report(located))
