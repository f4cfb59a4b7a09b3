"""Eligibility: periods from member files, activation, gaps, ages, exceptions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions import dates, text
from tidewell.operators.changes import assign, flag_matched, update_from, upsert
from tidewell.operators.matching import having_match, match_side, other
from tidewell.operators.picking import latest_with_ties
from tidewell.params import RunParams
from tidewell.plans.feeds import MembershipFeed, accept, build, sources

UNREADABLE_START = date(1900, 1, 1)  # fixed value


def eligibility_periods(raw: DataFrame, members: DataFrame, feed: MembershipFeed, p: RunParams) -> DataFrame:
    """Plan-benefit periods of a member file, fitted to the run year.

    An unreadable start counts as 1900, an unreadable end as the last day of the
    run year. Periods of one raw start, plan and benefit code merge to the latest
    end; the codes are cut to the width of the target only after that.
    """
    rows = accept(raw.where(F.col("runyear") == p.run_year), feed.tests)
    full = list(dict.fromkeys([*sources(feed.plan), *sources(feed.benefit)]))
    rows = rows.select(
        F.col(feed.member).alias("member"),
        F.col(feed.start).cast("string").alias("raw_start"),
        dates.date_or(feed.start, UNREADABLE_START).alias("starts"),
        dates.date_or(feed.end, date(p.run_year, 12, 31)).alias("ends"),
        *full)
    # Merged once per file member, before the join, and once per member of the master.
    keys = [*full, "raw_start", "starts"]
    rows = rows.groupBy("member", *keys).agg(F.max("ends").alias("ends"))
    mine = members.where(F.col("pmd_client_id") == feed.client_id).select("patient_id", "patient_unique_ident")
    rows = rows.join(mine, F.col("member") == F.col("patient_id"))
    rows = rows.groupBy("patient_unique_ident", *keys).agg(F.max("ends").alias("ends"))
    start, end = dates.clamp_period("starts", "ends", p.run_year)
    return rows.select(
        F.lit(feed.client_id).alias("pmd_client_id"), "patient_unique_ident",
        build(feed.plan).alias("planidentifier_pclm"), build(feed.benefit).alias("pbp_pclm"),
        start.alias("eligibilitystartdate"), end.alias("eligibilityenddate"),
        F.lit(p.run_year).alias("runyear")).distinct()


def guardian_periods(raw: DataFrame, members: DataFrame, p: RunParams, sep: str = "", client_id: int = 67) -> DataFrame:
    """Guardian periods from each member's latest file version."""
    latest = latest_with_ties(raw, ["patient_id"], "update_datetime")
    rows = latest.where((F.col("runyear") == p.run_year)
                        & text.present("cardholder_fname") & text.present("cardholder_lname"))
    mine = members.where(F.col("pmd_client_id") == client_id).select("patient_id", "patient_unique_ident")
    rows = rows.join(mine, "patient_id").select(
        F.col("group_code").alias("planidentifier_pclm"), "patient_unique_ident",
        text.name_hash("cardholder_fname", "cardholder_lname", sep=sep).alias("guardian_id"),
        F.col("cardholder_fname").alias("guardian_firstname"),
        F.col("cardholder_lname").alias("guardian_lastname"),
        F.col("patient_phone_1").alias("guardian_phone"),
        dates.date_or("patient_effective_date", UNREADABLE_START).alias("starts"),
        dates.date_or("patient_term_date", date(p.run_year, 12, 31)).alias("ends"))
    # The greatest end per start decides how the start is fitted, so aggregate first.
    person = ["planidentifier_pclm", "patient_unique_ident", "guardian_id", "guardian_firstname", "guardian_lastname"]
    rows = rows.groupBy(*person, "guardian_phone", "starts").agg(F.max("ends").alias("ends"))
    start, end = dates.clamp_period("starts", "ends", p.run_year)
    rows = rows.withColumns({"eligibilitystartdate": start, "eligibilityenddate": end})
    rows = rows.groupBy(*person, "eligibilitystartdate").agg(
        F.max("guardian_phone").alias("guardian_phone"), F.max("eligibilityenddate").alias("eligibilityenddate"))
    return rows.withColumns({"pmd_client_id": F.lit(client_id), "runyear": F.lit(p.run_year)})


GUARDIAN_KEY = ("patient_unique_ident", "planidentifier_pclm", "guardian_id", "eligibilitystartdate")


def merge_guardians(target: DataFrame, staged: DataFrame) -> DataFrame:
    """Update end and phone of known guardian periods and add the others; the latest end wins."""
    return upsert(target, staged, list(GUARDIAN_KEY), ["eligibilityenddate", "guardian_phone"],
                  order=["eligibilityenddate", "guardian_phone"])


EXCEPTION_KEY = ("excepttype", "patient_unique_ident", "planidentifier_pclm", "exceptionstartdate")


def merge_exceptions(target: DataFrame, staged: DataFrame, p: RunParams) -> DataFrame:
    """Keep the latest end per member, plan and start, then update or add."""
    cols = ["excepttype", "pmd_client_id", "patient_unique_ident", "planidentifier_pclm",
            "exceptionstartdate", "exceptionenddate"]
    latest = latest_with_ties(staged.select(*cols), ["patient_unique_ident", "planidentifier_pclm",
                                                     "exceptionstartdate"], "exceptionenddate").distinct()
    return upsert(target, latest, list(EXCEPTION_KEY), ["exceptionenddate"],
                  {"updatedate": dates.moment(p.as_of)}, order=["exceptionenddate"])


# ---- activation -----------------------------------------------------------------

def recompute_active(members: DataFrame, periods: DataFrame, p: RunParams) -> DataFrame:
    """Active means: a period of the run year covers today and ends this year.

    The eligibility year moves to the run year for members with a period that ends
    in it. Members of other clients, and runs of another year, are left alone.
    Periods are reduced to one row per member before the join.
    """
    if not p.is_current_year:
        return members
    today = F.lit(p.today)
    in_year = dates.in_year("eligibilityenddate", p.run_year)
    covers = (F.col("eligibilitystartdate") <= today) & (F.col("eligibilityenddate") >= today)
    state = periods.where(F.col("runyear") == p.run_year).groupBy("patient_unique_ident").agg(
        F.bool_or(F.coalesce(covers & in_year, F.lit(False))).alias("covered"),
        F.bool_or(F.coalesce(in_year, F.lit(False))).alias("ends_in_year"))
    side, condition = match_side(state, ["patient_unique_ident"], carry=["covered", "ends_in_year"])
    rows = members.join(side, condition, "left")
    mine = F.coalesce(F.col("pmd_client_id") == p.client_id, F.lit(False))
    rows = rows.withColumns({
        "active": F.when(mine, F.coalesce(other("covered"), F.lit(False))).otherwise(F.col("active")),
        "eligibilityyear": F.when(mine & F.coalesce(other("ends_in_year"), F.lit(False)), F.lit(p.run_year))
        .otherwise(F.col("eligibilityyear"))})
    return rows.select(*members.columns)


def soft_delete(members: DataFrame, detail: DataFrame, p: RunParams) -> tuple[DataFrame, DataFrame]:
    """Delete members of the client without eligibility since the year before, and undelete the others.

    The detail rows of deleted members are marked too; undeleting leaves them.
    """
    mine = F.col("pmd_client_id") == p.client_id
    year = F.col("eligibilityyear")
    gone = year.isNull() | (year < p.as_of.year - 1)
    new_members = members.withColumn(
        "is_deleted", F.when(mine, gone).otherwise(F.col("is_deleted")))
    new_detail = flag_matched(detail, members.where(mine & gone), ["patient_unique_ident"],
                              {"is_deleted": F.lit(True)})
    return new_members, new_detail


def eligibility_gaps(periods: DataFrame, key: str = "patient_unique_ident", start: str = "eligibilitystartdate",
                     end: str = "eligibilityenddate", exact: bool = False) -> DataFrame:
    """Span of days, days inside periods and whether days are missing, per key.

    By default overlapping periods count twice, so an overlap can hide a gap;
    ``exact`` counts each day once.
    """
    length = F.datediff(end, start) + 1
    if not exact:
        sums = periods.groupBy(key).agg(
            (F.datediff(F.max(end), F.min(start)) + 1).alias("span_days"),
            F.sum(length.cast("bigint")).alias("period_days"))
        return sums.withColumn("has_gap", F.col("span_days") > F.col("period_days"))
    # One row per start bounds each group by the number of days.
    spans = periods.groupBy(key, F.col(start).alias("starts")).agg(F.max(end).alias("ends"))
    earlier = Window.partitionBy(key).orderBy("starts").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max("ends").over(earlier)
    fresh = F.when(reached.isNull() | (reached < F.col("starts")), F.datediff("ends", "starts") + 1)
    gained = fresh.otherwise(F.greatest(F.datediff(F.col("ends"), reached), F.lit(0)))
    spans = spans.withColumn("gained", gained)
    sums = spans.groupBy(key).agg(
        (F.datediff(F.max("ends"), F.min("starts")) + 1).alias("span_days"),
        F.sum(F.col("gained").cast("bigint")).alias("period_days"))
    return sums.withColumn("has_gap", F.col("span_days") > F.col("period_days"))


def inactivate_gapped(members: DataFrame, periods: DataFrame, p: RunParams, exact: bool = False) -> DataFrame:
    """Set members of the client with a gap in this year's periods inactive."""
    mine = periods.where((F.col("runyear") == p.run_year) & (F.col("pmd_client_id") == p.client_id)
                         & dates.in_year("eligibilityenddate", p.as_of.year))
    gapped = eligibility_gaps(mine, exact=exact).where("has_gap")
    return flag_matched(members, gapped, ["patient_unique_ident"], {"active": F.lit(False)},
                        F.col("pmd_client_id") == p.client_id)


def inactivate_age(members: DataFrame, p: RunParams, low: int, high: int | None = None) -> DataFrame:
    """Set members of the client outside the ages inactive; an unknown age changes nothing."""
    age = dates.completed_age("dob", p.today)
    outside = age < low if high is None else ~age.between(low, high)
    mine = F.col("pmd_client_id") == p.client_id
    return assign(members, F.coalesce(mine & outside, F.lit(False)), {"active": F.lit(False)})


def deactivate(members: DataFrame, client_id: int, ids: DataFrame | None = None) -> DataFrame:
    """Set a whole client, or its members listed by ``patient_id``, inactive."""
    mine = F.col("pmd_client_id") == client_id
    if ids is None:
        return assign(members, F.coalesce(mine, F.lit(False)), {"active": F.lit(False)})
    return flag_matched(members, ids, ["patient_id"], {"active": F.lit(False)}, mine)


# Special rules of clients: (needs gapless eligibility, least age, greatest age).
SPECIAL_RULES = {66: (True, 18, None), 95: (False, 5, 64)}


# Member files whose marked members of the run year are inactive: client to (column, mark).
INACTIVE_MARKS = {67: ("nurtur_member", "y")}


def marked_inactive(membership: DataFrame, p: RunParams) -> DataFrame:
    """Members that the client's file of the run year marks as inactive, as ``patient_id``."""
    column, mark = INACTIVE_MARKS[p.client_id]
    return membership.where((F.col("runyear") == p.run_year) & (F.col(column) == mark)).select("patient_id")


def activate(members: DataFrame, periods: DataFrame, detail: DataFrame, p: RunParams,
             inactive_ids: DataFrame | None = None, membership: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Activation, soft deletion and the special rules of the client, as (members, detail).

    ``inactive_ids`` lists members to set inactive; for a client whose member file marks
    them, ``membership`` is that file.
    """
    state = recompute_active(members, periods, p)
    state, new_detail = soft_delete(state, detail, p)
    if p.is_current_year and p.client_id in SPECIAL_RULES:
        gapless, low, high = SPECIAL_RULES[p.client_id]
        if gapless:
            state = inactivate_gapped(state, periods, p)
        state = inactivate_age(state, p, low, high)
    if p.is_current_year and inactive_ids is not None:
        state = deactivate(state, p.client_id, inactive_ids)
    if p.is_current_year and membership is not None and p.client_id in INACTIVE_MARKS:
        state = deactivate(state, p.client_id, marked_inactive(membership, p))
    return state, new_detail


def latest_plan(detail: DataFrame, periods: DataFrame, p: RunParams) -> DataFrame:
    """Set the plan of open detail rows to that of the member's latest period start."""
    mine = periods.where((F.col("pmd_client_id") == p.client_id) & (F.col("runyear") == p.run_year))
    return update_from(detail, mine, ["patient_unique_ident"], {"planidentifier_pclm": "planidentifier_pclm"},
                       scope=F.col("end_date").isNull(), order=["eligibilitystartdate"])


def active_on(members: DataFrame, periods: DataFrame, day: date) -> DataFrame:
    """Members with a period around the day."""
    around = periods.where((F.col("eligibilitystartdate") <= F.lit(day)) & (F.col("eligibilityenddate") >= F.lit(day)))
    return having_match(members, around, ["patient_unique_ident"])
