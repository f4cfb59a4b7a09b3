"""Plans on hand-made rows of the domain tables."""

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from tidewell.params import RunParams
from tidewell.plans import adherence, claims, eligibility, members, outreach, runs
from tidewell.plans.feeds import CLIENT_IDS, MEDICAL_FEEDS, PHARMACY_FEEDS
from tidewell.sources import tables

P = RunParams(client_id=66, run_year=2020, as_of=datetime(2020, 7, 1, 12), run_id=4)


def test_eligibility_gaps(table, values):
    d = date
    periods = table("patient_unique_ident int, eligibilitystartdate date, eligibilityenddate date",
                    (1, d(2020, 1, 1), d(2020, 1, 31)), (1, d(2020, 2, 1), d(2020, 2, 29)),  # contiguous
                    (2, d(2020, 1, 1), d(2020, 1, 31)), (2, d(2020, 2, 2), d(2020, 2, 29)),  # one day missing
                    (3, d(2020, 1, 1), d(2020, 1, 31)), (3, d(2020, 1, 20), d(2020, 2, 5)), (3, d(2020, 2, 10), d(2020, 2, 20)))
    plain = values(eligibility.eligibility_gaps(periods), "patient_unique_ident", "has_gap")
    exact = values(eligibility.eligibility_gaps(periods, exact=True), "patient_unique_ident", "has_gap", "period_days")
    assert plain == [(1, False), (2, True), (3, False)]  # the overlap hides the gap
    assert exact == [(1, False, 60), (2, True, 59), (3, True, 47)]


def people(table):
    return table("patient_unique_ident int, patient_id string, pmd_client_id int, dob date, active boolean, "
                 "eligibilityyear int, is_deleted boolean",
                 (1, "a", 66, date(1980, 1, 1), False, 2019, False),  # period ends today
                 (2, "b", 66, date(2002, 7, 2), True, 2020, False),  # 18th birthday tomorrow
                 (3, "c", 66, date(2002, 7, 1), False, 2020, False),  # 18th birthday today
                 (4, "d", 66, None, True, None, False),
                 (5, "e", 66, date(1980, 1, 1), True, 2018, False),
                 (6, "f", 66, date(1980, 1, 1), True, 2019, True),
                 (7, "g", 99, date(2015, 1, 1), True, 2010, False))


def test_activation(table, values):
    def span(i, start, end):
        return (i, 66, start, end, 2020)
    periods = table("patient_unique_ident int, pmd_client_id int, eligibilitystartdate date, eligibilityenddate date, runyear int",
                    span(1, date(2020, 1, 1), date(2020, 7, 1)), span(2, date(2020, 1, 1), date(2020, 12, 31)),
                    span(3, date(2020, 1, 1), date(2020, 12, 31)), span(5, date(2020, 1, 1), date(2020, 6, 30)),
                    span(6, date(2020, 1, 1), date(2020, 3, 1)), span(6, date(2020, 5, 1), date(2020, 12, 31)))
    rows = people(table)
    got, detail = eligibility.activate(rows, periods, rows, P)
    assert values(got, "patient_unique_ident", "active", "eligibilityyear", "is_deleted") == [
        (1, True, 2020, False), (2, False, 2020, False), (3, True, 2020, False), (4, False, None, True),
        (5, False, 2020, False), (6, False, 2020, False), (7, True, 2010, False)]
    assert values(detail.where("is_deleted"), "patient_unique_ident") == [(4,), (6,)]
    earlier = RunParams(client_id=66, run_year=2019, as_of=P.as_of)
    assert values(eligibility.recompute_active(rows, periods, earlier)) == values(rows)


def test_age_range_with_unknown_age(table, values):
    rows = table("patient_unique_ident int, pmd_client_id int, dob date, active boolean",
                 (1, 95, date(2015, 7, 1), True), (2, 95, date(2015, 7, 2), True), (3, 95, date(1955, 7, 2), True),
                 (4, 95, date(1955, 7, 1), True), (5, 95, None, True), (6, 1, date(2019, 1, 1), True))
    p = RunParams(client_id=95, run_year=2020, as_of=P.as_of)
    got = values(eligibility.inactivate_age(rows, p, 5, 64), "patient_unique_ident", "active")
    assert got == [(1, True), (2, False), (3, True), (4, False), (5, True), (6, True)]


def test_days_covered_agrees_with_a_loop(spark):
    random.seed(9)
    p = RunParams(client_id=1, run_year=2020, as_of=P.as_of)
    data = []
    for _ in range(600):
        who = random.choice([1, 1, 1, 2, 3])
        day = date(2020, 1, 1) + timedelta(random.randrange(-5, 366))
        data.append((who, random.choice("AB"), datetime(day.year, day.month, day.day), random.choice([0, 5, 10, 30, 90])))
    staged = spark.createDataFrame(data, "pmd_patient_id int, measureuse string, date_of_service timestamp_ntz, days_supply int")
    for shift in (False, True):
        got = {(r.pmd_patient_id, r.measureuse): (r.first_fill, r.days_covered, r.days_in_period)
               for r in adherence.days_covered(staged, p, shift=shift).collect()}
        want = {}
        for key in {(m, u) for m, u, _, _ in data}:
            fills = sorted((d.timetuple().tm_yday, n) for m, u, d, n in data if (m, u) == key and d.year == 2020 and n > 0)
            covered, free = set(), 0
            for day, n in fills:
                start = max(day, free) if shift else day
                free = start + n
                covered |= {x for x in range(start, start + n) if x <= 366}
            want[key] = (fills[0][0], len(covered), 366 - fills[0][0] + 1)
        assert got == want


def test_drug_counts_use_five_characters_of_the_plan(table, values):
    staged = table("evalrun_id int, pmd_patient_id long, measureuse string, planidentifier_pclm string, drug_name string",
                   (1, 7, "RAS", "H0251-01", "x"), (1, 7, "RAS", "H0251-02", "x"), (1, 8, "RAS", "H0251-01", "x"),
                   (1, 8, "RAS", "H0251-02", "y"), (1, 8, "RAS", "H0251-02", "y"))
    assert values(adherence.single_drug(staged), "pmd_patient_id", "pt_meas_plan_drugcounter") == [("7", 1)]
    assert values(adherence.multi_drug(staged), "pmd_patient_id", "pt_meas_plan_drugcounter") == [("8", 2)]


def test_do_not_call(table, values):
    rows = people(table).withColumns({"dnc_flag": F.lit(False), "dnc_flag_source": F.lit(None).cast("string")})
    feed = table("hicn string, `ok to call` string, runyear int", ("a", "n", 2020), ("a", "n", 2020), ("b", "y", 2020), ("c", "n", 2019))
    got = members.merge_dnc(rows, {73: feed}, P)
    assert values(got.where("dnc_flag"), "patient_unique_ident", "dnc_flag_source") == [(1, "dncfile")]


def test_guardians_of_the_latest_file(table, values):
    p = RunParams(client_id=67, run_year=2020, as_of=P.as_of)
    who = table("patient_unique_ident int, patient_id string, pmd_client_id int", (1, "a", 67), (2, "b", 67))
    raw = table("patient_id string, group_code string, cardholder_fname string, cardholder_lname string, patient_phone_1 string, "
                "patient_effective_date string, patient_term_date string, update_datetime int, runyear int",
                ("a", "P", "Ann", "Lee", "111", "2019-05-01", "open", 2, 2020),
                ("a", "P", "Ann", "Lee", "222", "2019-05-01", "2020-06-30", 2, 2020),
                ("a", "P", "Old", "Lee", "333", "2019-05-01", "open", 1, 2020), ("b", "P", "", "Lee", "444", "bad", "bad", 1, 2020))
    staged = eligibility.guardian_periods(raw, who, p)
    assert values(staged, "patient_unique_ident", "guardian_firstname", "guardian_phone", "eligibilitystartdate", "eligibilityenddate") == [
        (1, "Ann", "222", date(2020, 1, 1), date(2020, 12, 31))]
    target = staged.withColumns({"guardian_phone": F.lit("0"), "eligibilityenddate": F.lit(date(2020, 2, 1))})
    merged = eligibility.merge_guardians(target, staged)
    assert values(merged, "guardian_phone", "eligibilityenddate") == [("222", date(2020, 12, 31))]


def test_retry_rule(table, values):
    data = [(s, d) for s in (None, 11, 7, 18, 15, 99) for d in (0, 1, 3, 7, 10)] + [(11, None)]
    rows = table("s int, d int", *data)
    got = {(r.s, r.d) for r in rows.where(outreach.retry_due("s", "d")).collect()}
    wait = {11: 1, 7: 3, 18: 7, 15: 10}
    assert got == {(s, d) for s, d in data if s is None or s in wait and d is not None and d >= wait[s]}


def test_best_phone(table, values):
    phones = table("entity_id int, entity_type string, phone_type string, number string, primary boolean",
                   (1, "PATIENT", "phone", "2125550002", True), (1, "patient", "Phone", "2125550001", True),
                   (2, "patient", "phone", "212555000", True), (3, "patient", "phone", "2125550001", False),
                   (4, "provider", "phone", "2125550001", True))
    assert values(outreach.best_phone(phones)) == [(1, "2125550001")]


def test_pending_requests(table, values):
    requests = table("client int, y int, create_datetime timestamp_ntz, completed timestamp_ntz",
                     (1, 2020, datetime(2020, 1, 1), None), (2, 2020, datetime(2020, 1, 1), datetime(2020, 2, 1)))
    wanted = table("client int, y int", (1, 2020), (2, 2020))
    once = runs.upsert_pending(requests, wanted, ("client", "y"), P)
    assert values(once, "client", "create_datetime") == [(1, P.as_of), (2, datetime(2020, 1, 1)), (2, P.as_of)]
    assert runs.upsert_pending(once, wanted, ("client", "y"), P).count() == 3


def test_ledger_open_survives_a_retry(table, values):
    ledger = table("run_id long, pmd_client_id int, run_datetime timestamp_ntz, stars_patients string, stars_patients_detail string")
    once = runs.run_open(ledger, P)
    assert values(runs.run_open(once, P)) == values(once)
    assert values(runs.last_complete(once, 66, "stars_patients")) == [(datetime(1900, 1, 1),)]
    closed = runs.run_close(once, P, "stars_patients", {})
    assert values(runs.last_complete(closed, 66, "stars_patients")) == [(P.as_of,)]


def test_medical_repeats_and_cleared_errors(table, values):
    lines = table("claim_id string, claim_line_num int, admission_date date, pmd_client_id int, runyear int",
                  ("c1", 1, date(2020, 1, 1), 62, 2020), ("c1", 1, date(2020, 2, 1), 62, 2020), ("c2", 1, None, 62, 2020),
                  ("c2", 1, None, 62, 2020))
    reported = table("errorcode int, pmd_client_id int, claim_id string, claim_line_num int, admission_date date", (999, 62, "c2", 1, None))
    good, bad = claims.split_errors(lines, reported, ("claim_id", "claim_line_num"))
    assert values(good, "claim_id", "admission_date") == [("c1", date(2020, 1, 1)), ("c2", None)]
    assert values(bad, "claim_id", "admission_date") == [("c1", date(2020, 2, 1))]
    errors = bad.unionByName(bad.withColumn("claim_id", F.lit("c9")))
    assert values(claims.clear_errors(errors, lines), "claim_id") == [("c9",)]


def test_feeds_are_complete():
    assert set(PHARMACY_FEEDS) <= set(CLIENT_IDS) and set(MEDICAL_FEEDS) <= set(CLIENT_IDS)
    assert len(MEDICAL_FEEDS[62].columns) == 55
    for feed in PHARMACY_FEEDS.values():
        assert {"transaction_id", "patient_id", "date_of_service", "product_service_id"} <= set(feed.columns)


def test_load_reads_its_own_partition(spark, tmp_path, table, values):
    """Rows of other clients and years are read for the new state alone, not for the joins."""
    path = str(tmp_path / "claims")
    schema = "transaction_id string, pmd_client_id bigint, patient_id string, runyear int, claimexccd int, update_datetime timestamp_ntz"
    tables.save_state(table(schema, ("a", 67, "p", 2020, None, None), ("b", 67, "p", 2019, None, None), ("c", 15, "p", 2020, None, None)),
                      path, 1, ["pmd_client_id", "runyear"])
    state = tables.load_state(spark, path)
    mine, others = claims.own_partition(state, RunParams(client_id=67, run_year=2020, as_of=P.as_of))
    plan = mine._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):]
    assert "pmd_client_id" in filters and "runyear" in filters and "Filter (" not in plan.split("FileScan")[0]
    assert values(mine, "transaction_id") == [("a",)] and values(others, "transaction_id") == [("b",), ("c",)]


def test_this_years_calls_are_filtered_in_the_scan(spark, tmp_path, table):
    calls = table("id int, status_detail_id int, created_at timestamp_ntz, entity_type string, entity_id int",
                  (1, 7, datetime(2020, 3, 1), "patient", 1))
    calls.write.parquet(str(tmp_path / "calls"))
    links = table("call_id int, dtp_id int", (1, 1))
    dtps = table("id int, pmd_patient_id bigint, measure_id int", (1, 1, 1))
    measures = table("id int, key string", (1, "RAS"))
    languages = table("primary boolean, entity_type string, entity_id int, language_id int", (True, "patient", 1, 54))
    last = outreach.last_call(spark.read.parquet(str(tmp_path / "calls")), links, dtps, measures, languages, P)
    assert "GreaterThanOrEqual(created_at,2020-01-01T00:00)" in last._jdf.queryExecution().executedPlan().toString()
    assert last.count() == 1


def test_members_marked_in_the_file_are_inactive(table, values):
    p = RunParams(client_id=67, run_year=2020, as_of=P.as_of)
    rows = people(table).withColumn("pmd_client_id", F.lit(67))
    periods = table("patient_unique_ident int, pmd_client_id int, eligibilitystartdate date, eligibilityenddate date, runyear int",
                    *[(k, 67, date(2020, 1, 1), date(2020, 12, 31), 2020) for k in (1, 2, 3)])
    membership = table("patient_id string, runyear int, nurtur_member string", ("a", 2020, "y"), ("b", 2019, "y"), ("c", 2020, "n"))
    got, _ = eligibility.activate(rows, periods, rows, p, membership=membership)
    assert [k for k, active in values(got, "patient_unique_ident", "active") if active] == [2, 3]


def test_names_are_grouped_before_they_are_cut(table, values):
    from tidewell.operators.totals import collapse
    name = "n" * 60
    rows = table("drug_name string, `drug description` string", (name + "1", "a"), (name + "2", "b"), (name + "2", "c"))
    got = adherence.cut_to_width(collapse(rows, ["drug description"]))
    assert values(got) == [(name, "a"), (name, "c")]


def test_upsert_does_not_depend_on_column_order(table, values):
    from tidewell.operators.changes import upsert
    target = table("k int, a string, b int", (1, "old", 0))
    source = table("k int, a string, b int", (1, "x", 1), (1, "y", 0), (2, "z", 5), (2, "z", 6))
    by_b = [values(upsert(target, source.select(*c), ["k"], ["a", "b"], order=["b"]), "k", "a", "b")
            for c in (("k", "a", "b"), ("b", "a", "k"))]
    assert by_b[0] == by_b[1] == [(1, "x", 1), (2, "z", 6)]
    plain = [values(upsert(target, source.select(*c), ["k"], ["a", "b"]), "k", "a", "b") for c in (("k", "a", "b"), ("b", "a", "k"))]
    assert plain[0] == plain[1]


def detail_feed(table, *rows):
    """Staged detail rows: member, address, time of arrival."""
    from pyspark.sql.types import StringType
    feed = table("patient_unique_ident int, address string, update_datetime timestamp_ntz", *rows)
    return feed.withColumns({**{c: F.lit(None).cast(StringType()) for c in ("address_2", "city", "state", "zip_code", "supc_flag", "pbp_pclm")},
                             "phone_number": F.lit("2125550100"), "lis_flag": F.lit(False), "esrd": F.lit(False)})


def test_failed_detail_run_is_read_again(spark, tmp_path, table, values):
    root = str(tmp_path)
    who = table("patient_unique_ident int, dob date, pmd_client_id int", *[(k, date(1980, 1, 1), 66) for k in (1, 2, 3)])
    empty = members.stage_detail(detail_feed(table).where("false"), who, None, P).withColumns(
        {c: F.lit(None).cast("timestamp_ntz") for c in ("start_date", "end_date", "create_datetime")}).withColumn("run_id", F.lit(0))
    tables.save_state(empty, f"{root}/detail", 0)
    tables.save_state(table("run_id bigint, pmd_client_id int, run_datetime timestamp_ntz, stars_patients string, stars_patients_detail string",
                            (900, 7, datetime(2030, 1, 1), "Success", "Success")), f"{root}/run_ledger", 0)  # another client's
    feed = detail_feed(table, (1, "a", datetime(2020, 1, 5)), (2, "b", datetime(2020, 2, 5)), (3, "c", None), (1, "z", datetime(2020, 2, 6)))

    def at(run_id, month):
        return RunParams(client_id=66, run_year=2020, as_of=datetime(2020, month, 1), run_id=run_id)

    def state():
        rows = tables.load_state(spark, f"{root}/detail").where("end_date is null")
        return {r.patient_unique_ident: (r.address, r.run_id) for r in rows.collect()}

    members.nightly_detail(spark, root, feed.where("update_datetime < '2020-02-01' or update_datetime is null"), who, at(1, 2))
    assert state() == {1: ("a", 1), 3: ("c", 1)}
    died = at(2, 3)
    ledger = runs.open_run(spark, f"{root}/run_ledger", died)
    assert values(runs.rows_since(feed, ledger, 66, members.DETAIL_STEP), "address") == [("b",), ("c",), ("z",)]
    members.nightly_detail(spark, root, feed, who, at(3, 4))
    assert state() == {1: ("z", 3), 2: ("b", 3), 3: ("c", 1)}
    before = values(tables.load_state(spark, f"{root}/detail"))
    members.nightly_detail(spark, root, feed, who, at(3, 4))  # a retry of the same run
    assert values(tables.load_state(spark, f"{root}/detail")) == before
    members.nightly_detail(spark, root, feed.where("false"), who, at(4, 5))
    ledger = tables.load_state(spark, f"{root}/run_ledger")
    assert values(ledger.where("pmd_client_id = 66"), "run_id", "stars_patients_detail", "details_imported") == [
        (1, "Success", 2), (2, "Not Complete", None), (3, "Success", 2), (4, "Success", 0)]


def test_time_of_the_last_run_reaches_the_scan(spark, tmp_path, table):
    detail_feed(table, (1, "a", datetime(2020, 1, 5)), (2, "b", datetime(2020, 3, 5))).write.parquet(str(tmp_path / "feed"))
    ledger = table("run_id bigint, pmd_client_id int, run_datetime timestamp_ntz, stars_patients string, stars_patients_detail string",
                   (1, 66, datetime(2020, 2, 1), "Success", "Success"), (2, 66, datetime(2020, 4, 1), "Success", "Not Complete"))
    rows = runs.rows_since(spark.read.parquet(str(tmp_path / "feed")), ledger, 66, members.DETAIL_STEP)
    assert rows.count() == 1
    plan = rows._jdf.queryExecution().explainString(rows.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    scan = plan[plan.index("Scan parquet"):]
    assert "PushedFilters" in scan and "update_datetime" in scan[scan.index("PushedFilters"):scan.index("ReadSchema")], scan[:900]


def test_medical_load_into_its_partition(spark, tmp_path, table, values):
    """Both loads of a year leave other clients' and years' files alone."""
    feed = MEDICAL_FEEDS[62]
    needed = sorted({n for _, *a in feed.columns.values() for n in (a[0] if isinstance(a[0], tuple) else (a[0],)) if isinstance(n, str) and n != "runyear"})
    schema = ", ".join(f"`{n}` string" for n in needed) + ", runyear int"

    def line(claim, number, year, status="1"):
        return tuple({"claim id": claim, "claim line number": number, "plan code": "H1234", "claim status": status,
                      "claim submit date": f"{year}-02-01"}.get(n) for n in needed) + (year,)

    path = str(tmp_path / "lines")
    tables.replace_partitions(table("pmd_client_id int, plan_code string, claim_id string, claim_line_num bigint, claim_status smallint, runyear int",
                                    (15, "H1234", "other", 1, 9, 2020), (62, "H1234", "old", 1, 9, 2019), (62, "H1234", "c1", 1, 0, 2020)),
                              path, 0, claims.CLAIM_PARTITION)

    def files_of(where):
        return {r[0] for r in tables.load_partitions(spark, path).where(where).select(F.input_file_name()).collect()}

    others = files_of("not (pmd_client_id = 62 and runyear = 2020)")
    raw = table(schema, line("c1", "1", 2020, "5"), line("c2", "1", 2020), line("c2", "x", 2020))
    p = RunParams(client_id=62, run_year=2020, as_of=P.as_of, run_id=1)
    for _ in range(2):
        claims.load_medical_into(spark, path, raw, feed, p)
        got = tables.load_partitions(spark, path)
        assert values(got, "pmd_client_id", "claim_id", "claim_status", "runyear") == [
            (15, "other", 9, 2020), (62, "c1", 5, 2020), (62, "c2", 1, 2020), (62, "old", 9, 2019)]
    assert files_of("not (pmd_client_id = 62 and runyear = 2020)") == others


def test_medical_loads_read_their_year_of_lines_joined_once(spark, tmp_path, table, monkeypatch):
    from checks import claims as checked
    from checks.registry import QUERIES
    table("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string",
          (1, 1, "F", "1-URGENT"), (2, 2, "O", "2-HIGH"), (2, 2, "O", "5-LOW"), (None, 3, "O", "5-LOW")).write.parquet(str(tmp_path / "orders.parquet"))
    days = [datetime(1996, 1, 1), datetime(1997, 5, 1), datetime(1998, 9, 1)]
    line = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_shipdate timestamp_ntz, l_linestatus string"
    table(line, *[(k, n, 7, 3 + n, day, "O") for k in (1, 2, None) for n in (1, 1, 2) for day in days], (1, 3, 7, 1, None, "F"),
          ).write.parquet(str(tmp_path / "lineitem.parquet"))
    plans, load = [], claims.load_medical_into

    def spied(spark_, path, raw, feed, p):
        plans.append((p.run_year, raw._jdf.queryExecution().executedPlan().toString()))
        load(spark_, path, raw, feed, p)

    monkeypatch.setattr(claims, "load_medical_into", spied)
    assert checked.claims is claims
    got = QUERIES["load_medical_62_twice"](spark, str(tmp_path))
    assert [y for y, _ in plans] == [None, 1996, 1997, 1998, 1998, 1997]
    for year, plan in plans[1:]:
        assert "Join" not in plan and "(runyear#" in plan[plan.index("PartitionFilters"):] and f"= {year})" in plan, plan
    # A copy of a line counts once, and so for both plans of order 2; rows without an order or a day load nothing.
    assert got.where("claim_id = '1'").count() == 2 * 3 and got.where("claim_id = '2'").count() == 2 * 2 * 3


def test_new_medical_lines_move_once(spark, table):
    feed = MEDICAL_FEEDS[62]
    needed = sorted({n for _, *a in feed.columns.values() for n in (a[0] if isinstance(a[0], tuple) else (a[0],)) if isinstance(n, str) and n != "runyear"})
    raw = table(", ".join(f"`{n}` string" for n in needed) + ", runyear int", tuple("1" for _ in needed) + (2020,))
    state = table("pmd_client_id int, plan_code string, claim_id string, claim_line_num bigint, claim_status smallint, runyear int",
                  (62, "H1234", "c1", 1, 0, 2020))
    without_broadcast(spark)
    try:
        plan = claims.changed_medical(raw, state, feed, RunParams(client_id=62, run_year=2020, as_of=P.as_of, run_id=1))
        text_ = plan._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate(keys=[pmd_client_id" not in text_
        assert len([r for r in text_.splitlines() if "SortMergeJoin [claim_id" in r]) == 2
        assert len([r for r in text_.splitlines() if "Exchange hashpartitioning(claim_id" in r]) == 2  # stored lines, new lines
    finally:
        with_broadcast(spark)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")


def with_broadcast(spark):
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_states_by_key_join_without_an_exchange(spark, tmp_path, table, values):
    path = str(tmp_path)
    claims_ = spark.range(500).selectExpr("cast(id % 90 as string) as patient_id", "id as n")
    who = spark.range(100).selectExpr("cast(id as string) as patient_id", "id as patient_unique_ident")
    tables.save_by_key(claims_.where("n < 5"), f"{path}/claims", 1, "patient_id", 8)
    for _ in range(2):  # a retry replaces the state of its run
        tables.save_by_key(claims_, f"{path}/claims", 2, "patient_id", 8)
    tables.save_by_key(who, f"{path}/who", 1, "patient_id", 8)
    stored = tables.load_by_key(spark, f"{path}/claims")
    assert stored.count() == 500 and tables.load_by_key(spark, f"{path}/claims", 1).count() == 5
    without_broadcast(spark)
    try:
        joined = stored.join(tables.load_by_key(spark, f"{path}/who"), "patient_id")
        assert "SortMergeJoin" in plan_text(joined) and "Exchange" not in plan_text(joined)
        grouped = stored.groupBy("patient_id").count()
        assert "Exchange" not in plan_text(grouped)
        assert joined.count() == 500 and grouped.count() == 90
    finally:
        with_broadcast(spark)


def test_staging_leaves_stored_claims_and_members_where_they_are(spark, tmp_path, table):
    """Adherence staging moves neither claims nor members that are stored by patient; lists are small here."""
    import checks.adherence as check
    from checks.registry import Tables
    t, path = Tables(spark, "/root/testdata/sf0.001"), str(tmp_path)
    tables.save_by_key(check.claims(t), f"{path}/claims", 1, "patient_id", 8)
    tables.save_by_key(check.members(t), f"{path}/members", 1, "patient_id", 8)
    inputs = [tables.load_by_key(spark, f"{path}/{n}") for n in ("claims", "members")]
    without_broadcast(spark)
    try:
        rows = adherence._measured(inputs[0], F.broadcast(check.drugs(t, "PROMO").distinct()), inputs[1],
                                   F.broadcast(check.contracts(t)), adherence.ADHERENCE_MEASURES, check.P)
        plan = plan_text(rows)
        assert "SortMergeJoin" in plan and plan.count("Bucketed: true") >= 2
        assert "Exchange hashpartitioning(patient_id" not in plan
    finally:
        with_broadcast(spark)


def test_detail_by_key_takes_flags_without_moving(spark, tmp_path):
    from tidewell.operators.changes import flag_matched
    path = str(tmp_path)
    detail = spark.range(300).selectExpr("id as patient_unique_ident", "false as flag")
    tables.save_by_key(detail, f"{path}/detail", 1, "patient_unique_ident", 8)
    ids = spark.range(0, 300, 7).selectExpr("id as patient_unique_ident")
    tables.save_by_key(ids, f"{path}/ids", 1, "patient_unique_ident", 8)
    without_broadcast(spark)
    try:
        out = flag_matched(tables.load_by_key(spark, f"{path}/detail"), tables.load_by_key(spark, f"{path}/ids"), ["patient_unique_ident"], {"flag": True})
        assert "Exchange" not in plan_text(out) and out.where("flag").count() == 43
    finally:
        with_broadcast(spark)


def test_restaging_reads_changed_patients_only(spark, table, values):
    from tidewell.operators.changes import carry_over, changed_keys
    before = table("k string, v int", ("a", 1), ("a", 1), ("b", 2), (None, 3), ("c", 4), ("d", None))
    after = table("k string, v int", ("a", 1), ("b", 2), (None, 5), ("c", 4), ("d", 0), ("e", 9))
    changed = changed_keys(before, after, "k", ["k", "v"])
    assert values(changed) == [(None,), ("a",), ("d",), ("e",)]
    fresh = after.join(changed, after.k.eqNullSafe(changed.k), "left_semi")
    assert values(carry_over(before, fresh, changed, "k")) == values(after)
    assert values(changed_keys(after, after, "k", ["v"])) == []
    # Only rows of changed members are built again.
    seen = []

    def build(rows):
        seen.extend(r.k for r in rows.collect())
        return rows

    first, later = before.where("k is not null"), after.where("k is not null")
    assert values(adherence.refresh_measures(first, first, later, build, "k")) == values(later)
    assert set(seen) == {"a", "d", "e"}


def test_new_claims_move_once_for_reversals_and_copies(spark, table):
    raw = table("transaction_id string, reversed_claim_id string, patient_id string, date_of_service string, ndc_code string, "
                "productnameshort string, quantity_dispensed string, days_supply string, prescriber_npi string, "
                "pharmacy_npi string, plan_code string, prescription_num string, transaction_status string",
                *[(i, "9", "p", "2020-03-0" + i, "1", "d", "1", "1", "n", "n", "PLAN", "1", s)
                  for i, s in (("1", "Paid"), ("1", "Paid"), ("2", "Paid"), ("2", "Reversal"))])
    drugs = table("ndc11 string, medstaken string", ("1", "m"))
    stored = table("transaction_id string, pmd_client_id bigint, patient_id string, runyear int, date_of_service timestamp_ntz",
                   ("3", 67, "p", 2020, datetime(2020, 1, 1)), ("2", 67, "p", 2019, datetime(2019, 1, 1)))
    p = RunParams(client_id=67, run_year=2020, as_of=P.as_of, run_id=1)
    key, old = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")
    try:
        new = claims.changed_claims(raw, drugs, stored, PHARMACY_FEEDS[67], p)
        rows = sorted(map(tuple, new.select("transaction_id", "runyear", "claimexccd").collect()))
        plan = spark._jvm.PythonSQLUtils.explainString(new._jdf.queryExecution(), "simple")
    finally:
        spark.conf.set(key, old)
    assert rows == [("1", 2020, None), ("2", 2020, 333), ("3", 2020, None)]
    # Row ids are made behind the last exchange, and no exchange deals by all columns.
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "prescription_service_reference_num" in x]


def test_states_are_packed(spark, tmp_path, table):
    import glob

    import pyarrow.parquet as pq
    rows = table("k int, v string", (1, "a"))
    tables.save_state(rows, f"{tmp_path}/s", 1)
    tables.replace_partitions(rows, f"{tmp_path}/p", 0, ["k"])
    found = glob.glob(f"{tmp_path}/s/states/**/*.parquet", recursive=True) + glob.glob(f"{tmp_path}/p/parts/**/*.parquet", recursive=True)
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in found if pq.ParquetFile(f).metadata.num_rows} == {"ZSTD"}
