"""Adherence staging, drug counts and days covered."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions import dates, text
from tidewell.operators.changes import carry_over, changed_keys, not_reversed
from tidewell.operators.matching import having_match, might_match
from tidewell.operators.totals import collapse, count_of_counts
from tidewell.params import RunParams
from tidewell.sources.tables import written

# Measures whose contracts take part, by staging.
ADHERENCE_MEASURES = ("ras", "statin", "diabetes", "insulin", "asthma", "dts")
INSULIN_MEASURES = ("ras", "statin", "diabetes")
RAS_MEASURES = ("ras", "statin", "diabetes", "insulin", "asthma")
PART_D = ("d", "y")
INSULIN_LABEL = "Diabetes-InsulinExclusion"

# Columns that collapse to their greatest value in adherence staging.
COLLAPSED = ("prescriber_id", "pharmacy_id", "drug description", "drug_strength", "unit_of_measure")

DRUG_COLUMNS = ("ndc", "measureuse", "Drug Name", "Drug Description", "strength", "strength_unit_of_measure",
                "dosage_form", "gpi")


def active_contracts(contracts: DataFrame, measures: Sequence[str], p: RunParams) -> DataFrame:
    rows = contracts.where((F.col("pmd_client_id") == p.client_id) & (F.col("contract_year") == p.run_year))
    return rows.where(F.col("analytics_contract") & text.in_ci("measure_use", measures))


# Widths of the target columns. Rows are grouped by full values and cut after that.
WIDTHS = {"prescriber_id": 50, "pharmacy_id": 50, "measureuse": 14, "drug_name": 60, "drug description": 255,
          "drug_strength": 15, "unit_of_measure": 10, "dosage_form": 4, "gpi": 50, "ndc": 50}
SHORT_DESCRIPTION = {"drug description": 250}  # of the exclusion stagings


def cut_to_width(df: DataFrame, **other_widths: int) -> DataFrame:
    """Texts cut to the widths of the target; rows that become equal are one row."""
    widths = WIDTHS | other_widths
    return df.select(*[text.varchar(F.col(f"`{c}`"), widths[c]).alias(c) if c in widths else F.col(f"`{c}`")
                       for c in df.columns]).distinct()


def _staged_columns(p: RunParams, measure: Column) -> dict[str, Column]:
    end = dates.supply_end("date_of_service", "days_supply")
    return {
        "evalrun_id": F.lit(p.run_id),
        "pmd_client_id": F.col("pmd_client_id"),
        "runyear": F.lit(p.run_year),
        "pmd_patient_id": F.col("patient_unique_ident").cast("bigint"),
        "transaction_id": F.col("transaction_id"),
        "planidentifier_pclm": F.col("accountid2"),
        "medicare_part_d_ind": F.col("medicare_part_d_ind"),
        "patient_id": F.col("patient_id"),
        "date_of_service": F.col("date_of_service"),
        "julianstart": dates.day_of_year("date_of_service"),
        "julianend": dates.day_of_year(end),  # wraps after 31 December; supply_end does not
        "supply_end": end,
        "prescriber_id": F.col("prescriber_id").cast("string"),
        "pharmacy_id": F.col("pharmacy_id").cast("string"),
        "measureuse": measure,
        "drug_name": F.col("`Drug Name`").cast("string"),
        "days_supply": F.col("days_supply"),
        "quantity_dispensed": F.col("quantity_dispensed"),
        "drug description": F.col("`Drug Description`").cast("string"),
        "drug_strength": F.col("strength").cast("string"),
        "unit_of_measure": F.col("strength_unit_of_measure").cast("string"),
        "dosage_form": F.col("dosage_form").cast("string"),
        "gpi": F.col("gpi").cast("string"),
        "ndc": F.col("ndc").cast("string"),
        "prescription_service_reference_num": F.col("prescription_service_reference_num"),
    }


def _measured(claims: DataFrame, drugs: DataFrame, members: DataFrame, contracts: DataFrame,
              measures: Sequence[str], p: RunParams) -> DataFrame:
    """Claims of the client with a listed drug, a member and an active contract.

    The year and client filters reach the claim scan. Contracts only restrict, so
    they are a semi join. Every staging
    removes duplicate rows at the end, so copies in the lists go first.
    """
    mine = claims.where(F.col("pmd_client_id") == p.client_id)
    people = members.where(F.col("pmd_client_id") == p.client_id).select("patient_id", "patient_unique_ident").distinct()
    drugs = drugs.select(*[F.col(f"`{c}`") for c in DRUG_COLUMNS]).distinct()
    signed = active_contracts(contracts, measures, p)
    rows = having_match(mine, signed, [("accountid2", "planidentifier_pclm")])
    rows = rows.join(drugs, F.col("product_service_id") == F.col("ndc"))
    return rows.join(people, "patient_id")


def stage_adherence(claims: DataFrame, drugs: DataFrame, members: DataFrame, contracts: DataFrame,
                    p: RunParams) -> DataFrame:
    """Measure claims of the run, one row per claim, drug and member."""
    valid = not_reversed(claims).where((F.col("runyear") == p.run_year) & text.in_ci("medicare_part_d_ind", PART_D))
    rows = _measured(valid, drugs, members, contracts, ADHERENCE_MEASURES, p)
    staged = _staged_columns(p, F.col("measureuse").cast("string"))
    return cut_to_width(collapse(rows.select(*[c.alias(n) for n, c in staged.items()]), COLLAPSED))


def stage_insulin(claims: DataFrame, drugs: DataFrame, members: DataFrame, contracts: DataFrame,
                  p: RunParams) -> DataFrame:
    """Insulin fills of the service year, reversed ones included, one measure label."""
    valid = claims.where(dates.in_year("date_of_service", p.run_year))
    rows = _measured(valid, drugs, members, contracts, INSULIN_MEASURES, p)
    staged = _staged_columns(p, F.lit(INSULIN_LABEL))
    staged.pop("prescription_service_reference_num")
    label = {"measureuse": len(INSULIN_LABEL)}
    return cut_to_width(rows.select(*[c.alias(n) for n, c in staged.items()]), **SHORT_DESCRIPTION, **label)


def stage_ras_exclusion(claims: DataFrame, drugs: DataFrame, members: DataFrame, contracts: DataFrame,
                        excluding: DataFrame, p: RunParams) -> DataFrame:
    """Measure claims whose drug is on the exclusion list."""
    valid = not_reversed(claims).where((F.col("runyear") == p.run_year) & text.in_ci("medicare_part_d_ind", PART_D))
    listed = having_match(valid, excluding, [("product_service_id", "ndc")])
    rows = _measured(listed, drugs, members, contracts, RAS_MEASURES, p)
    staged = _staged_columns(p, F.col("measureuse").cast("string"))
    return cut_to_width(rows.select(*[c.alias(n) for n, c in staged.items()]), **SHORT_DESCRIPTION)


# ---- changed members only -------------------------------------------------------

@dataclass(frozen=True)
class AdherenceInputs:
    """What a staging reads, as of one run."""

    claims: DataFrame
    drugs: DataFrame
    members: DataFrame
    contracts: DataFrame


CLAIM_INPUTS = ("transaction_id", "patient_id", "date_of_service", "product_service_id", "days_supply", "quantity_dispensed",
                "prescriber_id", "pharmacy_id", "accountid2", "medicare_part_d_ind", "claimexccd", "runyear",
                "prescription_service_reference_num")


def changed_patients(before: AdherenceInputs, after: AdherenceInputs, measures: Sequence[str], p: RunParams) -> DataFrame:
    """Patients of the client for whom a staging may give other rows than it gave before, each once.

    Those whose claims were added, reversed, deleted or changed, whose member row changed, and those with a claim of a
    drug or of a plan whose list entry changed.
    """
    def mine(df: DataFrame) -> DataFrame:
        return df.where(F.col("pmd_client_id") == p.client_id)

    in_year = (F.col("runyear") == p.run_year) | dates.in_year("date_of_service", p.run_year)
    old, new = (mine(x.claims).where(in_year).select(*CLAIM_INPUTS) for x in (before, after))
    patients = [changed_keys(old, new, "patient_id", CLAIM_INPUTS)]
    people = [mine(x.members).select("patient_id", "patient_unique_ident").distinct() for x in (before, after)]
    patients.append(changed_keys(*people, "patient_id", ["patient_unique_ident"]))
    drugs = [x.drugs.select(*[F.col(f"`{c}`") for c in DRUG_COLUMNS]).distinct() for x in (before, after)]
    plans = [active_contracts(x.contracts, measures, p).select("planidentifier_pclm").distinct() for x in (before, after)]
    # Claims that changed are in above already, so the lists are matched with today's claims only.
    listed = having_match(new, changed_keys(*drugs, "ndc", DRUG_COLUMNS), [("product_service_id", "ndc")])
    signed = having_match(new, changed_keys(*plans, "planidentifier_pclm", ["planidentifier_pclm"]), [("accountid2", "planidentifier_pclm")])
    patients += [listed.select("patient_id"), signed.select("patient_id")]
    return reduce(DataFrame.unionByName, patients).where("patient_id is not null").distinct()


STAGINGS = {stage_adherence: ADHERENCE_MEASURES, stage_insulin: INSULIN_MEASURES, stage_ras_exclusion: RAS_MEASURES}


def restage(staged: DataFrame, before: AdherenceInputs, after: AdherenceInputs, p: RunParams,
            stage: Callable[..., DataFrame] = stage_adherence, **more) -> DataFrame:
    """The staging of this run from that of an earlier one: changed patients staged anew, the others carried over.

    ``before`` has the inputs of the earlier staging. Equal to a full staging. Lists given as ``more`` must not have changed.
    """
    changed = written(changed_patients(before, after, STAGINGS[stage], p))
    claims = might_match(after.claims, changed, "patient_id")
    claims = having_match(claims, changed, ["patient_id"])
    fresh = stage(claims, after.drugs, after.members, after.contracts, p=p, **more)
    earlier = staged.withColumn("evalrun_id", F.lit(p.run_id))
    return carry_over(earlier, fresh, changed, "patient_id")


def refresh_measures(previous: DataFrame, before: DataFrame, after: DataFrame, build: Callable[[DataFrame], DataFrame],
                     key: str = "pmd_patient_id") -> DataFrame:
    """Figures per member (days covered, drug counts) from those of an earlier run.

    ``build`` makes the figures from staged rows; it runs over the members whose staged rows differ between ``before``
    and ``after``. Equal to building them over all.
    """
    columns = [c for c in after.columns if c != "evalrun_id"]
    changed = written(changed_keys(before, after, key, columns))
    rows = having_match(might_match(after, changed, key), changed, [key])
    fresh = build(rows)
    kind = previous.schema[key].dataType
    return carry_over(previous, fresh, changed.select(F.col(key).cast(kind).alias(key)), key)


def classify_drugs(staged: DataFrame, drug_col: str = "drug_name") -> DataFrame:
    """Number of different drugs per member, measure and five-character plan."""
    keyed = staged.select(
        "evalrun_id", F.col("pmd_patient_id").cast("string").alias("pmd_patient_id"), "measureuse",
        text.varchar("planidentifier_pclm", 5).alias("planidentifier_pclm"), drug_col)
    return count_of_counts(keyed, ["evalrun_id", "pmd_patient_id", "measureuse", "planidentifier_pclm"],
                           drug_col, "pt_meas_plan_drugcounter")


def single_drug(staged: DataFrame, drug_col: str = "drug_name") -> DataFrame:
    return classify_drugs(staged, drug_col).where("pt_meas_plan_drugcounter = 1")


def multi_drug(staged: DataFrame, drug_col: str = "drug_name") -> DataFrame:
    return classify_drugs(staged, drug_col).where("pt_meas_plan_drugcounter > 1")


# ---- days covered ---------------------------------------------------------------
# Our own definition, after the published one of the proportion of days covered:
# days of the treatment period on which the member has supply, over the days of the
# treatment period (first fill to the end of the year or of eligibility).

KEYS = ("pmd_patient_id", "measureuse")


def daily_fills(staged: DataFrame, p: RunParams, keys: Sequence[str] = KEYS) -> DataFrame:
    """Fills of the run year, one row per member, measure and start day.

    Fills of one day add up when supply is carried forward, and the longest counts
    when it is not. The grain bounds each member and measure to 366 rows, whatever
    the number of claims, so the windows that follow see small groups only. The
    reduction combines on the map side.
    """
    day = F.to_date("date_of_service")
    supplied = staged.where(dates.in_year("date_of_service", p.run_year) & (F.col("days_supply") > 0))
    return supplied.groupBy(*keys, day.alias("fill_day")).agg(
        F.sum(F.col("days_supply").cast("bigint")).alias("days"),
        F.max(F.col("days_supply").cast("bigint")).alias("longest"),
        F.count(F.lit(1)).alias("fills"))


def shifted_fills(staged: DataFrame, p: RunParams, keys: Sequence[str] = KEYS) -> DataFrame:
    """Supply windows with early refills moved behind the supply at hand.

    A window starts on its fill day or the day after the last covered day,
    whichever is later. With running totals ``P`` of the days before a fill, the
    day after the supply ends is ``P_i + days_i + max(start_j - P_j, j <= i)``: two
    running windows instead of a loop over fills.
    """
    per_key = Window.partitionBy(*keys).orderBy("fill_day").rowsBetween(Window.unboundedPreceding, 0)
    number = F.datediff("fill_day", dates.year_start(p.run_year))
    rows = daily_fills(staged, p, keys).withColumn("start_no", number)
    rows = rows.withColumn("before", F.sum("days").over(per_key) - F.col("days"))
    rows = rows.withColumn("slip", F.max(F.col("start_no") - F.col("before")).over(per_key))
    first = F.col("before") + F.col("slip")
    return rows.select(
        *keys, "fill_day", "fills", "days",
        F.dayofyear("fill_day").alias("julianstart"),
        (first + 1).cast("int").alias("modifiedjulianstart"),
        (first + F.col("days")).cast("int").alias("modifiedjulianend"),
        (first - F.col("start_no")).cast("int").alias("slack"))


def _covered(rows: DataFrame, keys: Sequence[str], first: Column, last: Column) -> DataFrame:
    """Days in the union of the day ranges of each key, and its first day."""
    ranges = rows.select(*keys, first.alias("first_no"), last.alias("last_no"))
    earlier = Window.partitionBy(*keys).orderBy("first_no", "last_no").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("last_no").over(earlier), F.lit(0))
    ranges = ranges.withColumn("reached", reached)
    gained = F.greatest(F.col("last_no") - F.greatest("reached", F.col("first_no") - 1), F.lit(0))
    return ranges.groupBy(*keys).agg(
        F.sum(gained).cast("int").alias("days_covered"), F.min("first_no").cast("int").alias("first_day"))


def days_covered(staged: DataFrame, p: RunParams, shift: bool = True, keys: Sequence[str] = KEYS,
                 eligible_until: DataFrame | None = None) -> DataFrame:
    """Covered days, days of the treatment period and their ratio per key.

    ``eligible_until`` (first key, ``eligibilityenddate``) ends the period before
    31 December. The ratio is given in ten-thousandths to stay exact.
    """
    days_in_year = date(p.run_year, 12, 31).timetuple().tm_yday
    if shift:
        rows = shifted_fills(staged, p, keys)
        first, last = F.col("modifiedjulianstart"), F.col("modifiedjulianend")
        begin = F.col("julianstart")
    else:
        rows = daily_fills(staged, p, keys).withColumn("begin", F.dayofyear("fill_day"))
        first = begin = F.col("begin")
        last = F.col("begin") + F.col("longest") - 1
    limit = F.lit(days_in_year)
    if eligible_until is not None:
        ends = eligible_until.groupBy(keys[0]).agg(F.max("eligibilityenddate").alias("until"))
        rows = rows.join(ends, keys[0])
        inside = F.least(F.col("until"), dates.year_end(p.run_year))
        limit = (F.datediff(inside, dates.year_start(p.run_year)) + 1)
    rows = rows.withColumn("limit_no", limit).where(begin <= F.col("limit_no"))
    first_fill = rows.groupBy(*keys).agg(F.min(begin).cast("int").alias("first_fill"), F.max("limit_no").alias("limit_no"))
    inside = rows.where(first <= F.col("limit_no"))
    covered = _covered(inside, keys, first, F.least(last, F.col("limit_no"))).drop("first_day")
    period = F.col("limit_no") - F.col("first_fill") + 1
    return covered.join(first_fill, list(keys)).select(
        *keys, "first_fill", "days_covered", period.cast("int").alias("days_in_period"),
        F.expr("div(days_covered * 10000L, limit_no - first_fill + 1)").alias("pdc_bp"))
