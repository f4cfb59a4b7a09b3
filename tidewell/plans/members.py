"""Member detail with history, program flags and contact restrictions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import codes, dates
from tidewell.operators.changes import flag_matched, refresh_flag, update_from
from tidewell.operators.history import FIRST_START, scd2_merge, scd2_merge_by_hash
from tidewell.operators.picking import latest_with_ties
from tidewell.operators.totals import scalar
from tidewell.params import RunParams
from tidewell.plans.eligibility import latest_plan
from tidewell.plans.runs import close_run, open_run, rows_since
from tidewell.sources.tables import load_state, save_state

# Columns whose change opens a new version of a member.
DETAIL_COMPARED = ("address", "address_2", "city", "state", "zip_code", "phone_number", "pbp_pclm",
                   "patient_agebandsort", "lis_flag", "esrd", "supc_flag")
FLAG_DEFAULTS = {"lis_flag": False, "esrd": False}  # a missing flag equals a false one


def stage_detail(staged: DataFrame, members: DataFrame, phones: DataFrame | None, p: RunParams) -> DataFrame:
    """Staged rows of known members with verified phones and age bands."""
    if phones is not None:
        staged = update_from(staged, phones, [("patient_unique_ident", "pmd_patient_id")],
                             {"phone_number": "phone_number"})
    known = members.select("patient_unique_ident", "dob")
    rows = staged.join(known, "patient_unique_ident")
    return rows.withColumns({
        "patient_ageband": codes.age_band("dob", p.today),
        "patient_agebandsort": codes.age_band_sort("dob", p.today)}).drop("dob")


# Step of a run whose completion moves the time from which detail rows are read.
DETAIL_STEP = "stars_patients_detail"


def refresh_detail(staged: DataFrame, members: DataFrame, detail: DataFrame, p: RunParams,
                   phones: DataFrame | None = None, first_start=FIRST_START, as_written: bool = False,
                   ledger: DataFrame | None = None, arrived: str = "update_datetime", by_hash: bool = False) -> DataFrame:
    """New state of the member detail after merging a staged file; a member's newest staged row counts.

    With the ``ledger`` of runs ``staged`` is the whole feed, of which only rows that arrived since the
    client's last complete detail run are read. ``by_hash`` moves key and hash of unchanged members only.
    """
    if ledger is not None:
        staged = rows_since(staged, ledger, p.client_id, DETAIL_STEP, arrived)
    rows = stage_detail(staged, members, phones, p)
    today = dates.moment(p.today)
    merge = scd2_merge_by_hash if by_hash else scd2_merge
    return merge(detail, rows, "patient_unique_ident", DETAIL_COMPARED, p.as_of, first_start=first_start,
                 repair="phone_number", as_written=as_written, defaults=FLAG_DEFAULTS,
                 order=[c for c in ("update_datetime",) if c in rows.columns],
                 extra={"run_id": F.lit(p.run_id), "create_datetime": today, "update_datetime": today})


def nightly_detail(spark: SparkSession, root: str, feed: DataFrame, members: DataFrame, p: RunParams,
                   phones: DataFrame | None = None, **rules) -> None:
    """A member run over the tables kept below ``root``: ledger opened, new rows merged, detail saved, ledger closed.

    A run that dies leaves its entry incomplete, so that its retry, or the next run, reads the same rows again.
    """
    ledger = open_run(spark, f"{root}/run_ledger", p)
    detail = load_state(spark, f"{root}/detail", before=p.run_id)
    save_state(refresh_detail(feed, members, detail, p, phones, ledger=ledger, by_hash=True, **rules), f"{root}/detail", p.run_id)
    changed = load_state(spark, f"{root}/detail", p.run_id).where(F.col("run_id") == p.run_id)
    close_run(spark, f"{root}/run_ledger", p, DETAIL_STEP, {"details_imported": changed.agg(F.count(F.lit(1))).scalar()})


# ---- flags ----------------------------------------------------------------------

@dataclass(frozen=True)
class SnapshotFlag:
    """Flag set for the members of a feed's latest snapshot and reset for the others."""

    feed: str
    flag: str
    member: str
    dated: str | None = None
    only: tuple[str, str] | None = None
    by_ident: bool = False  # the feed names members by their own number


@dataclass(frozen=True)
class ListFlag:
    """Flag set (or cleared) for listed members; the others keep theirs."""

    feed: str
    member: str
    values: tuple  # pairs of column and value


@dataclass(frozen=True)
class CopyColumns:
    """Columns copied from a feed, mapped or reset where asked."""

    feed: str
    member: str
    columns: tuple  # pairs of target and source
    reset: bool = False
    by_year: bool = False
    codes: tuple = ()  # pairs of code and result, with 0 for every other code
    by_ident: bool = False


# Feeds, their columns and the flags they set, by client.
FLAG_RULES = {
    52: (SnapshotFlag("program", "mtmp_flg", "memberid", "update_datetime"),),
    62: (SnapshotFlag("membership", "mtmp_flg", "patientid", "update_datetime", ("client_def_1", "Y")),),
    73: (SnapshotFlag("program", "mtmp_flg", "hicnumber", "file_date"),),
    78: (SnapshotFlag("membership", "mtmp_flg", "patientid", "update_datetime", ("mtmeligible", "1")),
         ListFlag("supd", "Mem Nbr", (("supd_flag", 1),))),
    15: (CopyColumns("benefits", "pmd_patient_id", (("lis_flag", "lis_flag"), ("lis_discount", "discount_status")),
                     reset=True, by_year=True, by_ident=True),),
    85: (ListFlag("esrd", "hap_id", (("esrd", True),)),
         ListFlag("hospice", "hap_id", (("hospice", True),)),
         SnapshotFlag("program", "mtmp_flg", "pmd_patient_id", by_ident=True)),
    76: (CopyColumns("phones", "patientid", (("phone_number", "updatednumber"),), by_ident=True),),
    95: (ListFlag("statin_reset", "patient_id", (("statin_flag", False),)),
         ListFlag("statin", "patient_id", (("statin_flag", True),)),
         ListFlag("asthma", "patient_id", (("asthma_flag", True),))),
    94: (CopyColumns("membership", "patient_id", (("supd_flag", "client_def_3"),), codes=(("1", 1), ("2", 2))),),
    87: (CopyColumns("membership", "patient_id", (("supd_flag", "client_def_3"),), codes=(("1", 1), ("2", 2))),),
}


def _idents(feed: DataFrame, rule, members: DataFrame) -> DataFrame:
    """Feed rows with the member's own number as ``patient_unique_ident``."""
    source = F.col(f"`{rule.member}`")
    if getattr(rule, "by_ident", False):
        rows = feed.withColumn("__ident", source.try_cast("bigint"))
        return rows.join(members.select("patient_unique_ident"), F.col("__ident") == F.col("patient_unique_ident"))
    rows = feed.withColumn("__member", source.cast("string"))
    known = members.select("patient_unique_ident", F.col("patient_id").alias("__member"))
    return rows.join(known, "__member")


def apply_rule(detail: DataFrame, members: DataFrame, feed: DataFrame, rule, p: RunParams,
               last_import: date | None = None) -> DataFrame:
    """Apply one flag rule to the open detail rows of the client's members."""
    mine = members.where(F.col("pmd_client_id") == p.client_id)
    is_open = F.col("end_date").isNull()
    if isinstance(rule, SnapshotFlag):
        rows, gate = feed, None
        if rule.dated:
            newest = scalar(feed, F.max(F.to_date(rule.dated)))
            # A range on the column itself, which reaches the scan.
            rows = feed.where((F.col(rule.dated) >= newest) & (F.col(rule.dated) < F.date_add(newest, 1)))
            if last_import is not None:
                gate = F.coalesce(newest, F.lit(date(1900, 1, 1))) >= F.lit(last_import)
        if rule.only:
            rows = rows.where(F.col(rule.only[0]) == rule.only[1])
        return refresh_flag(detail, mine, _idents(rows, rule, mine), "patient_unique_ident", rule.flag,
                            gate, is_open)
    rows = feed
    if isinstance(rule, CopyColumns) and rule.by_year:
        rows = rows.where(F.col("runyear") == p.run_year)
    rows = _idents(rows, rule, mine)
    if isinstance(rule, ListFlag):
        return flag_matched(detail, rows, ["patient_unique_ident"], dict(rule.values), is_open)
    if rule.codes:
        for _, source in rule.columns:
            rows = rows.withColumn(source, codes.map_codes(source, dict(rule.codes), 0))
    wanted: Mapping[str, str] = dict(rule.columns)
    if rule.reset:
        sources = list(wanted.values())
        none = mine.select("patient_unique_ident", *[F.lit(None).cast(rows.schema[s].dataType).alias(s) for s in sources])
        rows = rows.select("patient_unique_ident", *sources).unionByName(none)
    return update_from(detail, rows, ["patient_unique_ident"], wanted, scope=is_open)


def apply_flags(detail: DataFrame, members: DataFrame, periods: DataFrame, feeds: Mapping[str, DataFrame],
                p: RunParams, last_import: date | None = None) -> DataFrame:
    """Plan of the latest period, then the client's flag rules in order."""
    detail = latest_plan(detail, periods, p)
    for rule in FLAG_RULES.get(p.client_id, ()):
        if rule.feed in feeds:
            detail = apply_rule(detail, members, feeds[rule.feed], rule, p, last_import)
    return detail


# ---- do not call ----------------------------------------------------------------

DNC_SOURCE = "dncfile"  # fixed value


def dnc_ids(members: DataFrame, feed: DataFrame, client_id: int, p: RunParams) -> DataFrame:
    """Members a client's feed says not to call (clients 69, 73 and 30 differ)."""
    if client_id == 69:
        rows = latest_with_ties(feed, ["patient_id"], "update_datetime")
        ids = rows.where(F.col("carrier_code").cast("string") == "1").select(F.col("patient_id").alias("member"))
        known = members.where(F.col("pmd_client_id") == client_id)
    elif client_id == 73:
        rows = feed.where((F.col("`ok to call`") == "n") & (F.col("runyear") == p.run_year))
        ids, known = rows.select(F.col("hicn").alias("member")), members
    elif client_id == 30:
        newest = scalar(feed, F.max("file_date"))
        rows = feed.where((F.col("file_date") == newest) & (F.col("clientdef1") == "dnc"))
        ids, known = rows.select(F.col("patientid").alias("member")), members
    else:
        raise ValueError(f"client {client_id} has no do-not-call feed")
    return known.join(ids.distinct(), F.col("patient_id") == F.col("member")).select("patient_unique_ident")


def merge_dnc(members: DataFrame, feeds: Mapping[int, DataFrame], p: RunParams) -> DataFrame:
    """Set the do-not-call flag and its source for members listed by any feed."""
    ids = None
    for client_id, feed in feeds.items():
        found = dnc_ids(members, feed, client_id, p)
        ids = found if ids is None else ids.unionByName(found)
    if ids is None:
        return members
    return flag_matched(members, ids, ["patient_unique_ident"],
                        {"dnc_flag": F.lit(True), "dnc_flag_source": F.lit(DNC_SOURCE)})
