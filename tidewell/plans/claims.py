"""Pharmacy and medical claim loads, driven by the feed entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import dates, text
from tidewell.operators.changes import delete_matched, exclude_keys, fill_blank_from_period, flag_matched, update_from
from tidewell.operators.matching import having_match, lookup, only_new, other
from tidewell.operators.picking import dedup_latest, distinct_by_key, latest_with_ties, split_occurrence
from tidewell.params import RunParams
from tidewell.plans.feeds import REVERSED, MedicalFeed, PharmacyFeed, Reversal, accept, build, dirty_cells, standardize
from tidewell.sources.tables import load_partitions, replace_partitions, stamp

CLAIM_PARTITION = ("pmd_client_id", "runyear")
SEQUENCE = "__sequence"  # of new claims, as a column: rows that meet reversals by it needn't move again to lose copies


def stored_sequence() -> Column:
    return F.col("paired_adjustment_sequence_num").try_cast("int")


def with_drug_name(raw: DataFrame, drugs: DataFrame, feed: PharmacyFeed) -> DataFrame:
    """Add ``medstaken``; a code listed under several names takes the first by name."""
    code = text.pad_code(F.col(feed.drug_code)) if feed.padded_lookup else F.col(feed.drug_code)
    return lookup(raw, drugs, [(code, "ndc11")], ["medstaken"])


def drop_later_sequences(existing: DataFrame, raw: DataFrame, feed: PharmacyFeed, p: RunParams) -> DataFrame:
    """Remove stored claims whose sequence is above the least paid one of the feed."""
    if feed.drop_later_than is None:
        return existing
    paid = accept(raw, feed.drop_later_than)
    paid = paid.where(dates.in_year(F.col(feed.service_date).try_cast("date"), p.run_year))
    least = paid.groupBy(F.col(feed.transaction).alias("txn")).agg(
        F.min(F.col(feed.sequence).try_cast("int")).alias("least"))
    in_scope = (F.col("pmd_client_id") == p.client_id) & (F.col("runyear") == p.run_year)
    return delete_matched(existing, least, [("transaction_id", "txn")],
                          (other("least") < stored_sequence()) & in_scope, carry=["least"])


def unusable(feed: PharmacyFeed | MedicalFeed) -> dict[str, Column]:
    """Reasons for which a row can't be told from one that is loaded, and so would load at every run."""
    if isinstance(feed, MedicalFeed):
        return {"unreadable line number": _cell(feed.line).try_cast("bigint").isNull(),
                "no claim id": _cell(feed.claim).isNull()}
    if feed.nulls_match:  # there missing keys are equal to each other
        return {}
    reasons = {"no transaction id": F.col(feed.transaction).isNull()}
    if feed.known_by_year:
        reasons["unreadable service date"] = F.col(feed.service_date).try_cast("date").isNull()
    return reasons


def usable_rows(rows: DataFrame, feed: PharmacyFeed | MedicalFeed) -> DataFrame:
    for reason in unusable(feed).values():
        rows = rows.where(~reason)
    return rows


def rejected_rows(raw: DataFrame, feed: PharmacyFeed | MedicalFeed) -> DataFrame:
    """Rows of a feed that are not loaded for want of a key, with ``reject_reason``, and rows that load with a
    value set to NULL because it can't be read, with ``dirty_columns``."""
    rows = raw if isinstance(feed, MedicalFeed) else accept(raw, feed.tests)
    reason = F.lit(None).cast("string")
    for text_of, condition in unusable(feed).items():
        reason = F.when(condition, F.lit(text_of)).otherwise(reason)
    dirty = F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in dirty_cells(feed.columns).items()]))
    return rows.withColumns({"reject_reason": reason, "dirty_columns": dirty}).where(
        F.col("reject_reason").isNotNull() | (F.size("dirty_columns") > 0))


def new_claims(raw: DataFrame, drugs: DataFrame, existing: DataFrame, feed: PharmacyFeed, p: RunParams,
               exclude_patients: tuple = ()) -> DataFrame:
    """Canonical rows of a feed that are not loaded yet."""
    return finished(unloaded(raw, drugs, existing, feed, exclude_patients), feed, p)


def unloaded(raw: DataFrame, drugs: DataFrame, existing: DataFrame, feed: PharmacyFeed,
             exclude_patients: tuple = ()) -> DataFrame:
    """Canonical rows of a feed whose key is not loaded yet, as often as the feed has them.

    ``exclude_patients`` are test members whose stored claims do not count as known.
    """
    rows = usable_rows(accept(raw, feed.tests), feed)
    if feed.dedup == "min_sequence":
        rows = rows.withColumn("__sequence", F.col(feed.sequence).try_cast("int"))
        rows = latest_with_ties(rows, [feed.transaction], "__sequence", "min").drop("__sequence")

    known = exclude_keys(existing.where(F.col("pmd_client_id") == feed.client_id), "patient_id", exclude_patients)
    keys = [(text.trim(F.col(feed.transaction).cast("string")), "transaction_id")]
    if feed.known_by_year:
        keys.append((F.year(F.col(feed.service_date).try_cast("date")), "runyear"))
    rows = only_new(rows, known, keys, null_safe=feed.nulls_match)

    if feed.dedup == "latest":
        rows = rows.withColumns({n: build(rule) for n, rule in feed.latest_by.items()})
        rows = rows.withColumn("__tie", F.xxhash64(*[F.col(f"`{c}`") for c in raw.columns]))
        rows = dedup_latest(rows, [feed.transaction], list(feed.latest_by), ["__tie"])

    canonical = standardize(with_drug_name(rows, drugs, feed), feed.columns)
    canonical = canonical.withColumns({"runyear": F.year("date_of_service"), "claimexccd": F.lit(None).cast("int")})
    return canonical.withColumn(SEQUENCE, stored_sequence()) if any(r.min_sequence for r in feed.reversals) else canonical


def finished(added: DataFrame, feed: PharmacyFeed, p: RunParams) -> DataFrame:
    """New claims, each once, with the values that the load gives them."""
    if feed.dedup != "latest":
        added = added.distinct()
    return stamp(
        added.drop(SEQUENCE),
        update_datetime=dates.moment(p.as_of),
        sourcerowid=text.row_id(F.lit(feed.client_id), "transaction_id", "date_of_service",
                                "product_service_id", "quantity_dispensed", "days_supply"),
    )


def reversal_scope(rule: Reversal, p: RunParams) -> Column:
    """Stored claims a reversal rule may touch."""
    scope = (F.col("pmd_client_id") == p.client_id) & (F.col("runyear") == p.run_year)
    if rule.until:
        scope = scope & dates.cutover("date_of_service", rule.until)[0]
    if rule.after:
        scope = scope & dates.cutover("date_of_service", rule.after)[1]
    if rule.only_open:
        scope = scope & F.col("claimexccd").isNull()
    return scope


def apply_reversals(claims: DataFrame, raw: DataFrame, feed: PharmacyFeed, p: RunParams) -> DataFrame:
    """Set the exception code on claims that the feed reverses."""
    columns = claims.columns
    for rule in feed.reversals:
        rows = accept(raw, rule.tests)
        if rule.in_year:
            rows = rows.where(dates.in_year(F.col(rule.in_year).try_cast("date"), p.run_year))
        key = text.trim(F.col(rule.key).cast("string")).alias("reversed")
        keys = [("transaction_id", "reversed")]
        if rule.min_sequence:
            rows = rows.groupBy(key).agg(F.min(F.col(rule.min_sequence).try_cast("int")).alias("sequence"))
            keys.append((SEQUENCE if SEQUENCE in claims.columns else stored_sequence(), "sequence"))
        else:
            rows = rows.select(key)
        claims = flag_matched(claims, rows, keys,
                              {"claimexccd": F.lit(REVERSED),
                               "update_datetime": dates.moment(p.as_of)},
                              scope=reversal_scope(rule, p))
    return claims.select(*columns)


def fill_account(claims: DataFrame, members: DataFrame, periods: DataFrame, p: RunParams) -> DataFrame:
    """Fill an empty account from the eligibility period that covers the service date."""
    mine = members.where(F.col("pmd_client_id") == p.client_id)
    spans = periods.where((F.col("pmd_client_id") == p.client_id) & (F.col("runyear") == p.run_year))
    spans = spans.select("patient_unique_ident", "planidentifier_pclm", "eligibilitystartdate", "eligibilityenddate")
    spans = spans.join(mine.select("patient_unique_ident", "patient_id").distinct(), "patient_unique_ident")
    scope = (F.col("pmd_client_id") == p.client_id) & (F.col("runyear") == p.run_year)
    return fill_blank_from_period(
        claims, spans, "patient_id", "date_of_service", "eligibilitystartdate", "eligibilityenddate",
        "accountid2", "planidentifier_pclm", scope, lambda c: text.left(c, 5),
        also={"update_datetime": dates.moment(p.as_of)})


def changed_claims(raw: DataFrame, drugs: DataFrame, existing: DataFrame, feed: PharmacyFeed, p: RunParams,
                   members: DataFrame | None = None, periods: DataFrame | None = None,
                   exclude_patients: tuple = ()) -> DataFrame:
    """The client's claims of the run year after loading its feed, and new claims of other years.

    Claims of the client and run year, and the new ones, go through the joins; of all
    others just the keys of the client are read.
    """
    mine, others = own_partition(existing, p)
    kept = drop_later_sequences(mine, raw, feed, p)
    # New claims are flagged before copies go: both need them by transaction, so they move once, and without the row id.
    added = unloaded(raw, drugs, kept.unionByName(others), feed, exclude_patients)
    added = finished(apply_reversals(added, raw, feed, p), feed, p)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in added.schema.fields if f.name not in kept.columns}
    state = apply_reversals(kept.withColumns(missing), raw, feed, p).unionByName(added, allowMissingColumns=True)
    if feed.account_from_period and periods is not None:
        state = fill_account(state, members, periods, p)
    return state


def load_claims(raw: DataFrame, drugs: DataFrame, existing: DataFrame, feed: PharmacyFeed, p: RunParams,
                members: DataFrame | None = None, periods: DataFrame | None = None,
                exclude_patients: tuple = ()) -> DataFrame:
    """New state of the pharmacy claims after loading one client's feed; rows of other clients and years pass by."""
    changed = changed_claims(raw, drugs, existing, feed, p, members, periods, exclude_patients)
    return changed.unionByName(own_partition(existing, p)[1], allowMissingColumns=True)


def load_claims_into(spark: SparkSession, path: str, raw: DataFrame, drugs: DataFrame, feed: PharmacyFeed, p: RunParams,
                     members: DataFrame | None = None, periods: DataFrame | None = None,
                     exclude_patients: tuple = ()) -> None:
    """Load one client's feed into the claims kept by client and run year at ``path``.

    The partition of the client and run year is replaced, new claims of other years are added to theirs, and the
    files of all other partitions stay. A repeated run starts from the claims before it.
    """
    changed = changed_claims(raw, drugs, load_partitions(spark, path, p.run_id), feed, p, members, periods, exclude_patients)
    replace_partitions(changed, path, p.run_id, CLAIM_PARTITION, own_keys(p))


def own_keys(p: RunParams) -> dict[str, int]:
    return dict(zip(CLAIM_PARTITION, (p.client_id, p.run_year)))


def own_partition(existing: DataFrame, p: RunParams) -> tuple[DataFrame, DataFrame]:
    """Rows of the client and run year, and all others; both tests reach a partitioned scan."""
    own = (F.col("pmd_client_id") == p.client_id) & (F.col("runyear") == p.run_year)
    return existing.where(own), existing.where(~F.coalesce(own, F.lit(False)))


# ---- medical --------------------------------------------------------------------

MEDICAL_KEY = ("claim_id", "claim_line_num", "plan_code")


def _cell(name: str) -> Column:
    return F.col(f"`{name}`")


def new_medical(raw: DataFrame, existing: DataFrame, feed: MedicalFeed, p: RunParams) -> DataFrame:
    """Canonical claim lines not loaded yet for the run year, those of a key together."""
    known = existing.where((F.col("pmd_client_id") == feed.client_id) & (F.col("runyear") == p.run_year))
    keys = [(_cell(feed.claim), "claim_id"),
            (_cell(feed.line).try_cast("bigint"), "claim_line_num"),
            (text.left(_cell(feed.plan), 5), "plan_code")]
    rows = distinct_by_key(standardize(only_new(usable_rows(raw, feed), known, keys), feed.columns), MEDICAL_KEY)
    return stamp(rows, create_date=dates.moment(p.as_of))


def refresh_status(lines: DataFrame, raw: DataFrame, feed: MedicalFeed, p: RunParams) -> DataFrame:
    """Set each line's status from its latest submission in the run year."""
    rows = raw.where(F.col("runyear") == p.run_year).select(
        _cell(feed.plan).alias("plan"), text.left(_cell(feed.plan), 5).alias("plan5"),
        _cell(feed.claim).alias("claim"), _cell(feed.line).try_cast("bigint").alias("line"),
        _cell(feed.submitted).try_cast("date").alias("submitted"),
        _cell(feed.status).try_cast("smallint").alias("status"))
    latest = latest_with_ties(rows, ["claim", "line", "plan"], "submitted")
    return update_from(lines, latest, [("claim_id", "claim"), ("claim_line_num", "line"), ("plan_code", "plan5")],
                       {"claim_status": "status"}, scope=F.col("runyear") == p.run_year, order=["submitted"],
                       also={"update_datetime": dates.moment(p.as_of)})


def changed_medical(raw: DataFrame, existing: DataFrame, feed: MedicalFeed, p: RunParams) -> DataFrame:
    """The client's lines of the run year after loading its feed, and new lines of other years."""
    mine = own_partition(existing, p)[0]
    # Stored and new lines get their status apart: the new ones lie by key already and move no more.
    added = refresh_status(new_medical(raw, mine, feed, p), raw, feed, p)
    state = refresh_status(mine, raw, feed, p).unionByName(added, allowMissingColumns=True)
    return state.select(*[_cell(c) for c in dict.fromkeys([*mine.columns, *feed.columns, "create_date", "update_datetime"])])


def load_medical(raw: DataFrame, existing: DataFrame, feed: MedicalFeed, p: RunParams) -> DataFrame:
    """New state of the medical claim lines after loading one client's feed.

    Only lines of the client and run year, and the new ones, are joined.
    """
    others = own_partition(existing, p)[1]
    return changed_medical(raw, existing, feed, p).unionByName(others, allowMissingColumns=True)


def load_medical_into(spark: SparkSession, path: str, raw: DataFrame, feed: MedicalFeed, p: RunParams) -> None:
    """Load one client's feed into the lines kept by client and run year at ``path``, as ``load_claims_into`` does."""
    changed = changed_medical(raw, load_partitions(spark, path, p.run_id), feed, p)
    replace_partitions(changed, path, p.run_id, CLAIM_PARTITION, own_keys(p))


ERROR_KEY = ("errorcode", "pmd_client_id", "claim_id", "claim_line_num", "admission_date")


def split_errors(lines: DataFrame, errors: DataFrame, key: tuple) -> tuple[DataFrame, DataFrame]:
    """(good lines, error lines not reported yet): repeats of a key are errors."""
    good, bad = split_occurrence(lines, list(key))
    bad = bad.withColumns({"errorcode": F.lit(999), "errorcolumn": F.lit(999), "errordescription": F.lit("")})
    return good, only_new(bad, errors, list(ERROR_KEY), null_safe=True)


def clear_errors(errors: DataFrame, lines: DataFrame) -> DataFrame:
    """Drop load errors whose line has been loaded since."""
    return delete_matched(errors, lines,
                          ["runyear", "pmd_client_id", "claim_id", "claim_line_num", "admission_date"])


def orphaned_claims(claims: DataFrame, members: DataFrame, drug_codes: DataFrame, client_id: int) -> DataFrame:
    """One row: number of the client's claims with a listed drug and no member."""
    mine = claims.where(F.col("pmd_client_id") == client_id)
    listed = having_match(mine, drug_codes, [("product_service_id", "ndc")])
    lost = only_new(listed, members.where(F.col("pmd_client_id") == client_id), ["patient_id"])
    return lost.agg(F.count(F.lit(1)).alias("orphaned_measureclaims_to_date"))
