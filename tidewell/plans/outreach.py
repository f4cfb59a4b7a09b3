"""Outreach: next-day campaign list, call history and its increment."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import codes, dates, text
from tidewell.operators.matching import having_match, match_side, might_match, only_new, other
from tidewell.operators.picking import top1_per_key
from tidewell.params import RunParams
from tidewell.sources.tables import written

# Call results and the days to wait after them.
RETRY_DAYS = {(11, 12): 1, (7, 8, 9, 14): 3, (18,): 7, (15,): 10}
# Spoken language to the campaign filter; a missing one counts as 14.
LANGUAGES = {14: "standard", 54: "Spanish"}
DEFAULT_LANGUAGE, OTHER_LANGUAGE = 14, "Other"


def retry_due(status: Column | str, days: Column | str, rules: dict = RETRY_DAYS) -> Column:
    """No call result yet, or the waiting time of the result is over."""
    status = F.col(status) if isinstance(status, str) else status
    days = F.col(days) if isinstance(days, str) else days
    due = status.isNull()
    for results, wait in rules.items():
        due = due | (status.isin(list(results)) & (days >= wait))
    return F.coalesce(due, F.lit(False))


def best_phone(phones: DataFrame) -> DataFrame:
    """One primary ten-digit phone per member (the least number of several)."""
    rows = phones.where(text.eq_ci("entity_type", "patient") & text.eq_ci("phone_type", "phone")
                        & F.col("primary") & (F.length("number") == 10))
    return rows.groupBy("entity_id").agg(F.min("number").alias("best_number"))


def last_call(calls: DataFrame, call_dtps: DataFrame, dtps: DataFrame, measures: DataFrame,
              languages: DataFrame, p: RunParams) -> DataFrame:
    """Latest call of this year per member and measure, a missing time first."""
    recent = calls.where(F.col("created_at") >= dates.moment(dates.first_day(p.as_of.year)))  # a plain range reaches the scan
    recent = recent.select(F.col("id").alias("call_id"), "status_detail_id", "created_at", "entity_type", "entity_id")
    linked = recent.join(call_dtps.select("call_id", "dtp_id"), "call_id")
    linked = linked.join(dtps.select(F.col("id").alias("dtp_id"), "pmd_patient_id", "measure_id"), "dtp_id")
    linked = linked.join(
        measures.select(F.col("id").alias("measure_id"), F.lower("key").alias("measure_key")), "measure_id")
    newest = top1_per_key(linked, ["pmd_patient_id", "measure_key"],
                          [F.col("created_at").desc_nulls_first(), F.col("call_id").desc()])
    spoken = languages.where(F.col("primary")).groupBy(
        F.lower("entity_type").alias("spoken_type"), F.col("entity_id").alias("spoken_id")
    ).agg(F.min("language_id").alias("language_id"))
    newest = newest.join(spoken, (F.lower("entity_type") == F.col("spoken_type"))
                         & (F.col("entity_id") == F.col("spoken_id")), "left")
    language = F.coalesce("language_id", F.lit(DEFAULT_LANGUAGE))
    return newest.select(
        F.col("pmd_patient_id").alias("called_patient"), "measure_key", "status_detail_id",
        F.datediff(F.lit(p.tomorrow), F.col("created_at")).alias("time_priority"),
        codes.map_codes(language, LANGUAGES, OTHER_LANGUAGE).alias("call_filter"))


def campaign_rollup(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key from a row per measure, which stands for ``n_open`` opportunities."""
    return rows.groupBy(*keys).agg(
        F.max("measureadh_status").alias("measureadh_status"),
        F.min("stockinhand").alias("stockinhand"),
        F.sum(F.col("adh_calllist_order") * F.col("n_open")).alias("adh_calllist_order"),
        F.countDistinct("measureuse").alias("measure_count"),
        F.min("dtp_touched_count").alias("dtp_touched_count"),
        F.min("time_priority").alias("time_priority"))


CAMPAIGN_KEYS = ("pmd_patient_id", "patient_name", "patient_count", "phone_number", "client_name", "pmd_client_id",
                 "zip_code", "lowbound_ts", "highbound_ts", "state_code", "time_zone", "phone_type", "filter",
                 "planidentifier_pclm")


def campaign_list(detail: DataFrame, measures: DataFrame, dtps: DataFrame, visibilities: DataFrame,
                  patients: DataFrame, phones: DataFrame, calls: DataFrame, call_dtps: DataFrame,
                  languages: DataFrame, p: RunParams) -> DataFrame:
    """Members with active opportunities whose last call allows another tomorrow."""
    year = p.as_of.year
    shown = visibilities.where(text.eq_ci("name", f"{year} Active")).select(F.col("id").alias("dtp_visibility_id"))
    open_dtps = dtps.where(F.col("dtp_year") == year).join(shown, "dtp_visibility_id")
    keyed = measures.select(F.col("id").alias("measure_id"), F.lower("key").alias("measure_key"))
    open_dtps = open_dtps.join(keyed, "measure_id")
    # Several opportunities of a member and measure weigh in the sum; count them, do not pair them.
    open_dtps = open_dtps.groupBy(F.col("pmd_patient_id").alias("open_patient"), F.col("measure_key").alias("open_key")).agg(
        F.count(F.lit(1)).alias("n_open"))

    rows = detail.withColumn("__key", F.lower("measureuse"))
    rows = rows.join(open_dtps, (F.col("pmd_patient_id") == F.col("open_patient")) & (F.col("__key") == F.col("open_key")))
    known = patients.select(F.col("id").alias("patient_row"), F.col("pmd_patient_id").alias("known_patient"))
    rows = rows.join(known, F.col("pmd_patient_id") == F.col("known_patient"))
    rows = rows.join(best_phone(phones), F.col("patient_row") == F.col("entity_id"))
    called = last_call(calls, call_dtps, dtps, measures, languages, p)
    rows = rows.join(called, (F.col("pmd_patient_id") == F.col("called_patient"))
                     & (F.col("__key") == F.col("measure_key")), "left")
    rows = rows.where(retry_due("status_detail_id", "time_priority")).withColumns({
        "phone_number": text.varchar(F.coalesce("best_number", "phone_number"), 10),
        "filter": F.coalesce("call_filter", "filter")})
    return campaign_rollup(rows, CAMPAIGN_KEYS).withColumn("campaign_date", F.lit(p.tomorrow))


# ---- call history ---------------------------------------------------------------

# Fixed values.
OWN_DRUG_MEASURES = ("HRM", "SUPD")  # code, name and prescriber come from the opportunity
PRODUCT_LINE = 1
INBOUND = "Inbound Call"


@dataclass(frozen=True)
class OutreachTables:
    calls: DataFrame
    call_dtps: DataFrame
    call_types: DataFrame
    dtps: DataFrame
    dtp_details: DataFrame
    measures: DataFrame
    visibilities: DataFrame
    users: DataFrame
    patients: DataFrame
    categories: DataFrame
    sub_categories: DataFrame
    statuses: DataFrame
    status_details: DataFrame
    dtp_claims: DataFrame
    pharmacy_claims: DataFrame


def _named(df: DataFrame, key: str, name: str, source: str = "name", mark: str | None = None) -> DataFrame:
    """Name table, ready to join on ``key``; ``mark`` is true in rows that it has."""
    marks = [F.lit(True).alias(mark)] if mark else []
    return df.select(F.col("id").alias(key), F.col(source).alias(name), *marks)


def _call_columns(calls: DataFrame) -> DataFrame:
    return calls.select(
        F.col("id").alias("call_id"), "user_id", "call_type_id", F.col("status_id").alias("call_status_id"),
        codes.recode_missing_detail("status_id", "status_detail_id").alias("call_status_detail_id"),
        F.col("status_detail_id").alias("__detail"), "dtp_cnsld_call_list_id",
        F.col("updated_at").alias("noted_at"), F.col("created_at").alias("started_at"),
        F.col("stopped_at").alias("ended_at"))


CONTACT_COLUMNS = (
    "call_id", "dtpdetail_id", "dtp_id", "dtp_cnsld_call_list_id", "user_id", "noted_at", "started_at", "ended_at",
    "call_status_id", "call_status_detail_id", "category_id", "sub_category_id", "freetextnotes", "call_status",
    "call_status_details", "category", "subcategory", "call_type_id", "call_type_name")


def current_dtps(t: OutreachTables, p: RunParams) -> DataFrame:
    """This year's opportunities of the product line."""
    return t.dtps.where((F.col("dtp_year") == p.as_of.year) & (F.col("product_line_id") == PRODUCT_LINE))


def contacts(t: OutreachTables, p: RunParams) -> DataFrame:
    """Calls with details, calls without any, and details without a call.

    Links and details of other years' opportunities go first, by semi joins. Then all three kinds follow from one
    join of linked calls and details: pairs, calls without a detail of theirs and details without a call of theirs. Of
    the calls those count that have no detail of any year, of the details those that name no call.
    """
    wanted = current_dtps(t, p)
    every = t.dtp_details.where(F.col("deleted_at").isNull())
    links = having_match(t.call_dtps, wanted, [("dtp_id", "id")]).select("call_id", "dtp_id").distinct()
    noted_calls = every.select(F.col("call_id").alias("noted_call")).distinct()
    calls = _call_columns(t.calls).join(links, "call_id").join(noted_calls, F.col("call_id") == F.col("noted_call"), "left")
    live = having_match(every, wanted, [("dtp_id", "id")]).select(
        F.col("id").alias("dtpdetail_id"), F.col("call_id").alias("detail_call"), F.col("dtp_id").alias("detail_dtp"),
        F.col("user_id").alias("detail_user"), "category_id", "sub_category_id", F.col("note").alias("freetextnotes"),
        F.col("created_at").alias("detail_created"), F.col("updated_at").alias("detail_updated"))
    rows = calls.join(live, (F.col("call_id") == F.col("detail_call")) & (F.col("dtp_id") == F.col("detail_dtp")), "full_outer")
    called, detailed = F.col("call_id").isNotNull(), F.col("dtpdetail_id").isNotNull()
    silent = called & ~detailed & F.col("noted_call").isNull()
    inbound = ~called & F.col("detail_call").isNull()
    rows = rows.where((called & detailed) | silent | inbound)

    rows = rows.join(_named(t.call_types, "call_type_id", "call_type_name", mark="__type"), "call_type_id", "left")
    rows = rows.join(_named(t.statuses, "call_status_id", "call_status", mark="__status"), "call_status_id", "left")
    rows = rows.join(_named(t.status_details, "__detail", "call_status_details", "description"), "__detail", "left")
    rows = rows.join(_named(t.categories, "category_id", "category", mark="__category"), "category_id", "left")
    rows = rows.join(_named(t.sub_categories, "sub_category_id", "subcategory", mark="__sub"), "sub_category_id", "left")
    # A call must have a known type and result, a detail a known category.
    rows = rows.where((~called | F.col("__type").isNotNull() & F.col("__status").isNotNull())
                      & (~detailed | F.col("__category").isNotNull() & F.col("__sub").isNotNull()))

    zero, blank, label = F.lit(0), F.lit(""), F.lit(INBOUND)
    of_call = {"call_id": zero, "dtp_id": F.col("detail_dtp"), "dtp_cnsld_call_list_id": zero, "user_id": F.col("detail_user"),
               "noted_at": F.col("detail_updated"), "started_at": F.col("detail_created"), "ended_at": F.col("detail_updated"),
               "call_status_id": zero, "call_status_detail_id": zero, "call_status": label, "call_status_details": label}
    of_detail = {"dtpdetail_id": zero, "category_id": zero, "sub_category_id": zero, "freetextnotes": blank,
                 "category": blank, "subcategory": blank}
    rows = rows.withColumns({**{c: F.when(called, F.col(c)).otherwise(v) for c, v in of_call.items()},
                             **{c: F.when(detailed, F.col(c)).otherwise(v) for c, v in of_detail.items()}})
    return rows.select(*CONTACT_COLUMNS).distinct()


def last_claims(t: OutreachTables, wanted: DataFrame) -> DataFrame:
    """Claim columns of the highest claim id of each wanted opportunity.

    Claims of no opportunity, nearly all of them, go while they are scanned. The ids, one for each opportunity,
    are written first, since the filter, the range and the join read them.
    """
    newest = having_match(t.dtp_claims, wanted, ["dtp_id"]).groupBy("dtp_id").agg(F.max("pharmacy_claim_id").alias("claim_id"))
    newest = written(newest)
    claims = might_match(t.pharmacy_claims, newest, ("id", "claim_id")).select(
        F.col("id").alias("claim_id"), F.col("provider_npi").cast("string").alias("claim_npi"),
        F.col("ndc").alias("claim_ndc"), F.col("drug_name").alias("claim_drug"), "prescription_service_num",
        "date_of_service", "quantity_dispensed", "days_supply")
    return newest.join(claims, "claim_id")


def opportunities(t: OutreachTables, p: RunParams) -> DataFrame:
    """This year's opportunities of the product line with their measure, member and last claim."""
    rows = current_dtps(t, p).select(F.col("id").alias("dtp_id"), "patient_id", "measure_id", "dtp_year", "dtp_visibility_id",
                       F.col("npi").alias("own_npi"), F.col("ndc").alias("own_ndc"), F.col("drug_name").alias("own_drug"))
    rows = rows.join(_named(t.measures, "measure_id", "measureuse"), "measure_id")
    rows = rows.join(_named(t.visibilities, "dtp_visibility_id", "dtp_visibilities_key", "key"), "dtp_visibility_id")
    people = t.patients.select(F.col("id").alias("patient_id"), "pmd_client_id", "pmd_patient_id", "member_id",
                               F.col("plan_group").alias("planidentifier_pclm"))
    rows = rows.join(people, "patient_id").join(last_claims(t, rows), "dtp_id", "left")
    own = F.col("measureuse")
    return rows.select(
        "dtp_id", "pmd_client_id", "pmd_patient_id", "member_id", "planidentifier_pclm",
        codes.pick(own, OWN_DRUG_MEASURES, F.col("own_npi"), text.varchar("claim_npi", 25)).alias("npi"),
        text.varchar("measureuse", 50).alias("measureuse"),
        codes.pick(own, OWN_DRUG_MEASURES, F.col("own_ndc"), F.col("claim_ndc")).alias("ndc"),
        codes.pick(own, OWN_DRUG_MEASURES, F.col("own_drug"), F.col("claim_drug")).alias("drug_name"),
        "prescription_service_num", "date_of_service", "quantity_dispensed", "days_supply",
        "dtp_year", "dtp_visibility_id", "dtp_visibilities_key")


def call_history(t: OutreachTables, p: RunParams) -> DataFrame:
    """One row per contact and opportunity of this year, with local times."""
    callers = t.users.select(
        F.col("id").alias("user_id"),
        F.concat(F.coalesce("last_name", F.lit("")), F.lit(" "), F.coalesce("first_name", F.lit(""))).alias("caller_name"))
    rows = contacts(t, p).join(opportunities(t, p), "dtp_id").join(callers, "user_id")
    local = {"measurenotedate": F.to_date(dates.to_local("noted_at", p.tz)),
             "call_start_at": dates.to_local("started_at", p.tz),
             "call_end_at": dates.to_local("ended_at", p.tz)}
    rows = rows.withColumns(local).withColumnsRenamed({"user_id": "caller_id", "noted_at": "lastupdate_utc"})
    return rows.drop("started_at", "ended_at")


def append_history(history: DataFrame, staged: DataFrame, detail: DataFrame, p: RunParams) -> DataFrame:
    """Staged calls of open members that this year's history does not have."""
    current = detail.where(F.col("end_date").isNull()).select("patient_unique_ident", "pbp_pclm", "accountid_pclm")
    side, condition = match_side(current, [("pmd_patient_id", "patient_unique_ident")],
                                 carry=["pbp_pclm", "accountid_pclm"])
    rows = staged.join(side, condition).select(
        *staged.columns, other("pbp_pclm").alias("pbp_pclm"), other("accountid_pclm").alias("accountid_pclm"))
    loaded = history.where(F.col("dtp_year") == p.as_of.year)
    return only_new(rows, loaded, ["call_id", "dtp_id", "dtpdetail_id"])
