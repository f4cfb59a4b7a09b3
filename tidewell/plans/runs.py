"""Run ledger, work queue, archives and exports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import dates
from tidewell.operators.changes import assign, flag_matched
from tidewell.operators.matching import only_new
from tidewell.operators.totals import max_or, scalar
from tidewell.params import RunParams
from tidewell.sources.tables import archive, load_state, overwrite, save_state, write_run

# The row that says there is nothing to do.
NOTHING_QUEUED = {"planidentifier_pclm": "0", "pmd_client_id": "0", "clientname": "0",
                  "runyear": 1900, "evaluations": 0, "controlid": -99}

COMPLETE, INCOMPLETE = "Success", "Not Complete"


def queue_pick(control: DataFrame) -> DataFrame:
    """Oldest queued client (by date, then id), or the row that says there is none."""
    queued = control.where(F.col("process") == 1).select(
        F.coalesce("planidentifier_pclm", F.lit("")).alias("planidentifier_pclm"),
        F.col("pmdclientid").cast("string").alias("pmd_client_id"),
        F.col("client").alias("clientname"),
        F.col("runyear").cast("int").alias("runyear"),
        F.lit(1).alias("evaluations"),
        F.col("controlid").cast("bigint").alias("controlid"),
        F.col("filewatcherqueuedate").alias("__queued"), F.lit(0).alias("__rank"))
    spare = control.sparkSession.range(1).select(
        *[F.lit(v).alias(n) for n, v in NOTHING_QUEUED.items()],
        F.lit(None).cast("timestamp_ntz").alias("__queued"), F.lit(1).alias("__rank"))
    order = ["__rank", F.col("__queued").asc_nulls_last(), "controlid"]
    return queued.unionByName(spare).orderBy(*order).limit(1).drop("__queued", "__rank")


def queue_clients(control: DataFrame, ready: DataFrame, p: RunParams) -> DataFrame:
    """Mark idle entries of the ready clients for the current year as queued."""
    scope = (F.col("runyear") == p.as_of.year) & (F.col("process") == 0)
    return flag_matched(control, ready, [("pmdclientid", "pmd_client_id")],
                        {"process": F.lit(1), "filewatcherqueuedate": dates.moment(p.as_of)}, scope)


def start_entry(control: DataFrame, controlid: int) -> DataFrame:
    return assign(control, F.col("controlid") == controlid, {"process_ind": F.lit(True)})


def reset_queue(control: DataFrame) -> DataFrame:
    """Entries in progress go back to idle."""
    return assign(control, F.col("process_ind"), {"process_ind": F.lit(False), "process": F.lit(0)})


def queue_transition(control: DataFrame, state: str, p: RunParams, ready: DataFrame | None = None,
                     controlid: int | None = None) -> DataFrame:
    """Move entries to ``queued``, ``started`` or ``idle``."""
    if state == "queued":
        return queue_clients(control, ready, p)
    if state == "started":
        return start_entry(control, controlid)
    if state == "idle":
        return reset_queue(control)
    raise ValueError(f"unknown queue state {state!r}")


# ---- ledger ---------------------------------------------------------------------

def run_open(ledger: DataFrame, p: RunParams) -> DataFrame:
    """Add the row of this run, unless a retry has added it before."""
    row = ledger.sparkSession.range(1).select(
        F.lit(p.run_id).cast("bigint").alias("run_id"), F.lit(p.client_id).alias("pmd_client_id"),
        dates.moment(p.as_of).alias("run_datetime"),
        F.lit(INCOMPLETE).alias("stars_patients"), F.lit(INCOMPLETE).alias("stars_patients_detail"))
    known = scalar(ledger.where(F.col("run_id") == p.run_id), F.count(F.lit(1)))
    return ledger.unionByName(row.where(known == 0), allowMissingColumns=True)


def run_close(ledger: DataFrame, p: RunParams, status_col: str, counts: dict[str, Column]) -> DataFrame:
    """Mark a step of this run complete, with the time, and store its counts (scalar subqueries)."""
    mine = F.col("run_id") == p.run_id
    return assign(ledger, mine, {status_col: F.lit(COMPLETE), f"{status_col}_complete_datetime": dates.moment(p.as_of), **counts})


def last_complete(ledger: DataFrame, client_id: int, status_col: str) -> DataFrame:
    """One row: time of the client's last complete run, 1900 when there is none."""
    done = ledger.where((F.col("pmd_client_id") == client_id) & (F.col(status_col) == COMPLETE))
    return max_or(done, "run_datetime", dates.moment(date(1900, 1, 1)), "last_run")


def rows_since(feed: DataFrame, ledger: DataFrame, client_id: int, step: str, arrived: str = "update_datetime") -> DataFrame:
    """Rows of a feed that arrived since the client's last run in which ``step`` was completed.

    The time is a scalar that reaches the scan as a filter. Rows of that very moment are read again, since they may
    have come after it was read; rows without a time are read at each run. Runs that failed don't count, so what they
    left undone is read again.
    """
    since = last_complete(ledger, client_id, step).scalar()
    return feed.where((F.col(arrived) >= since) | F.col(arrived).isNull())


def open_run(spark: SparkSession, path: str, p: RunParams) -> DataFrame:
    """Enter the run in the ledger kept at ``path``; a retry enters it once. Returns the ledger."""
    before = load_state(spark, path, before=2 * p.run_id)
    save_state(run_open(before, p), path, 2 * p.run_id)
    return load_state(spark, path, 2 * p.run_id)


def close_run(spark: SparkSession, path: str, p: RunParams, status_col: str, counts: dict[str, Column]) -> None:
    """Enter a step of the run as complete in the ledger kept at ``path``."""
    opened = load_state(spark, path, before=2 * p.run_id + 1)
    save_state(run_close(opened, p, status_col, counts), path, 2 * p.run_id + 1)


def upsert_pending(requests: DataFrame, wanted: DataFrame, keys: tuple, p: RunParams) -> DataFrame:
    """Touch pending requests of the wanted keys; add a request where none is pending."""
    pending = F.col("completed").isNull()
    now = dates.moment(p.as_of)
    touched = flag_matched(requests, wanted, list(keys), {"create_datetime": now}, pending)
    added = only_new(wanted, requests.where(pending), list(keys)).withColumn("create_datetime", now)
    return touched.unionByName(added, allowMissingColumns=True)


# ---- exports --------------------------------------------------------------------

def newest_not_exported(status: DataFrame, exported: DataFrame, client_id: int) -> DataFrame:
    """One row: newest run of the client that is not in the export, 0 when none.

    SQL ``NOT IN``: a NULL run in the client's export hides every run.
    """
    mine = F.col("pmd_client_id") == client_id
    sent = exported.where(mine)
    left = only_new(status.where(mine).select("evalrun_id"), sent, ["evalrun_id"])
    nulls = sent.agg(F.count_if(F.col("evalrun_id").isNull())).scalar()
    return max_or(left.where(nulls == 0), "evalrun_id", 0, "evalrun_id")


def member_measures(status: DataFrame, runs: DataFrame, exported: DataFrame, client_id: int) -> DataFrame:
    """Status rows of the newest run not exported yet, with the run's year."""
    newest = newest_not_exported(status, exported, client_id).scalar()
    rows = status.where(F.col("evalrun_id") == newest)
    return rows.join(runs.select("evalrun_id", F.col("runyear").alias("run_runyear")), "evalrun_id")


def history_upsert(history: DataFrame, config: DataFrame) -> DataFrame:
    """Day-grain history of waiting files.

    An entry with files updates its row of the same day and count, or adds one.
    """
    waiting = config.where(F.col("unprocessed_filecount") != 0)
    today = "__day"
    keys = ["pmd_client_id", "filetype", "unprocessed_filecount", today]
    old = history.withColumn(today, dates.day_key("lastdatereceived"))
    new = waiting.withColumn(today, dates.day_key("lastdatereceived"))
    latest = new.groupBy(*keys).agg(F.max("lastdatereceived").alias("latest"))
    marked = old.join(latest, keys, "left")
    touched = marked.withColumn("lastdatereceived", F.coalesce("latest", "lastdatereceived"))
    added = only_new(new, old, keys)
    names = history.columns
    return touched.select(*names).unionByName(added.select(*[c for c in names if c in added.columns]),
                                              allowMissingColumns=True)


def archive_evaluation(root: str, p: RunParams, staged: DataFrame, eligibility: DataFrame,
                       single: DataFrame, multiple: DataFrame, covered: DataFrame,
                       insulin: DataFrame | None = None) -> None:
    """Write the outputs of an evaluation to their current and cumulative tables; a retry replaces them."""
    day = staged.withColumn("date_of_service", F.to_date("date_of_service"))
    archive(day, p.as_of, f"{root}/adherence_claims_current", f"{root}/adherence_claims", p.run_id,
            partition_by=("pmd_client_id", "runyear"))
    overwrite(eligibility, f"{root}/eligibility_current")
    spark = staged.sparkSession
    write_run(spark.read.parquet(f"{root}/eligibility_current"), f"{root}/eligibility", p.run_id)  # computed once
    write_run(single.distinct(), f"{root}/single_drug_review", p.run_id)
    write_run(multiple, f"{root}/multiple_drug_review", p.run_id)
    write_run(covered.withColumn("archive_date", F.lit(p.today)), f"{root}/days_covered", p.run_id)
    if insulin is not None:
        write_run(insulin, f"{root}/insulin_claims", p.run_id)
