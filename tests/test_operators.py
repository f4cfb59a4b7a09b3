"""Operators: NULL keys, ties, idempotence, and agreement with plain Python."""

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from tidewell.operators import changes, history, matching, picking, totals


def keyed(table):
    left = table("k int, v string", (1, "a"), (2, "b"), (None, "n"), (2, "c"))
    right = table("k int", (2,), (None,), (9,))
    return left, right


def test_anti_and_semi_join_split_the_input(table, values):
    left, right = keyed(table)
    new = values(matching.only_new(left, right, ["k"]))
    known = values(matching.having_match(left, right, ["k"]))
    assert new == [(None, "n"), (1, "a")]
    assert known == [(2, "b"), (2, "c")]
    assert sorted(new + known, key=str) == sorted(values(left), key=str)


def test_null_safe_anti_join_matches_null_keys(table, values):
    left, right = keyed(table)
    assert values(matching.only_new(left, right, ["k"], null_safe=True)) == [(1, "a")]
    no_null = right.where("k is not null")
    assert values(matching.only_new(left, no_null, ["k"], null_safe=True)) == [(None, "n"), (1, "a")]


def test_not_in(table, values):
    left, right = keyed(table)
    assert values(matching.not_in(left, right, "k")) == []
    assert values(matching.not_in(left, right.where("k = 2"), "k")) == [(1, "a")]
    assert len(values(matching.not_in(left, right.where("k = 100"), "k"))) == 4  # NOT IN () keeps NULL


def test_lookup_never_multiplies_rows(table, values):
    left, _ = keyed(table)
    dim = table("k int, name string", (2, "z"), (2, "y"), (1, "x"), (None, "never"))
    assert values(matching.lookup(left, dim, ["k"], ["name"])) == [
        (None, "n", None), (1, "a", "x"), (2, "b", "y"), (2, "c", "y")]


def test_latest_with_ties_and_null_order(table, values):
    rows = table("k int, d int, v string", (1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (2, None, "d"), (3, None, "e"), (3, 1, "f"))
    assert values(picking.latest_with_ties(rows, ["k"], "d")) == [(1, 5, "a"), (1, 5, "b"), (3, 1, "f")]
    assert values(picking.latest_with_ties(rows, ["k"], "d", "min")) == [(1, 4, "c"), (3, 1, "f")]


def test_dedup_latest_puts_missing_dates_first(table, values):
    rows = table("k int, d int, e int", (1, 5, 1), (1, None, 2), (2, 5, 1), (2, 5, 2), (3, 1, 1), (3, 1, 1))
    assert values(picking.dedup_latest(rows, ["k"], ["d"], ["e"])) == [(1, None, 2), (2, 5, 2), (3, 1, 1)]


def test_distinct_by_key_agrees_with_distinct(table, values):
    rng = random.Random(3)
    rows = [(rng.choice([1, 2, None]), rng.choice(["a", None]), rng.choice([0, 1, None]), rng.choice(["x", "y", None])) for _ in range(200)]
    df = table("k int, `a b` string, c int, l string", *rows)
    got = picking.distinct_by_key(df, ["k", "l"])
    assert got.columns == df.columns
    assert values(got) == values(df.distinct())
    assert picking.distinct_by_key(df.where("false"), ["k", "l"]).count() == 0


def test_one_row_of_each_key_is_first(spark):
    random.seed(5)
    data = [(random.choice([1, 1, 1, 2, 3, None]), random.randrange(4)) for _ in range(400)]
    rows = spark.createDataFrame(data, "k int, v int")
    good, bad = picking.split_occurrence(rows, ["k"])
    got_good = sorted((tuple(r) for r in good.collect()), key=str)
    got_bad = sorted((tuple(r) for r in bad.collect()), key=str)
    best = {}
    for k, v in data:
        best[k] = min(v, best.get(k, 99))
    assert got_good == sorted(best.items(), key=str)
    assert sorted(got_good + got_bad, key=str) == sorted(data, key=str)


def test_copies_are_written_out_in_chunks(table, values):
    rows = table("k int, v string", *[(1, "a")] * 25, *[(1, "b")] * 7, (2, "c"), (None, "n"), (None, "n"))
    got = values(picking.mark_first(rows, ["k"], ["v"], chunk=4), "k", "v", "is_first")
    want = [(1, "a", True), *[(1, "a", False)] * 24, *[(1, "b", False)] * 7, (2, "c", True), (None, "n", True), (None, "n", False)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_as_of_period_agrees_with_a_loop(spark):
    random.seed(11)
    base = date(2020, 1, 1)
    periods = []
    for _ in range(120):
        start = base + timedelta(random.randrange(200))
        periods.append((random.randrange(5), start, start + timedelta(random.randrange(40)), random.choice("PQR")))
    facts = [(i, random.choice([0, 0, 0, 1, 2, 3, 4, None]), datetime(2020, 1, 1) + timedelta(random.randrange(240)))
             for i in range(500)]
    got = matching.as_of_period(
        spark.createDataFrame(facts, "i int, k int, at timestamp_ntz"),
        spark.createDataFrame(periods, "k int, s date, e date, plan string"), "k", "at", "s", "e", ["plan"])
    got = {r.i: r.plan for r in got.collect()}
    assert len(got) == len(facts)
    for i, k, at in facts:
        spans = {}
        for pk, s, e, plan in periods:
            if pk == k:
                spans[(s, plan)] = max(e, spans.get((s, plan), e))
        hits = [(s, e, plan) for (s, plan), e in spans.items() if s <= at.date() <= e]
        assert got[i] == (max(hits)[2] if hits else None)


def test_period_ends_are_inclusive(table, values):
    claims = table("k int, at timestamp_ntz, account string", (1, datetime(2020, 1, 1), ""), (1, datetime(2020, 1, 31, 23), None),
                   (1, datetime(2020, 2, 1), ""), (1, datetime(2020, 1, 5), "KEEP"), (2, datetime(2020, 1, 5), ""))
    periods = table("k int, s date, e date, plan string", (1, date(2020, 1, 1), date(2020, 1, 31), "H0251-01"))
    got = changes.fill_blank_from_period(claims, periods, "k", "at", "s", "e", "account", "plan", transform=lambda c: F.left(c, F.lit(5)))
    assert values(got, "k", "account") == [(1, ""), (1, "H0251"), (1, "H0251"), (1, "KEEP"), (2, "")]


def test_update_copies_null_of_a_match_and_keeps_the_rest(table, values):
    rows = table("k int, v string, w string", (1, "a", "x"), (2, "b", "y"), (3, "c", "z"))
    source = table("k int, n string, d int", (1, None, 1), (2, "old", 1), (2, "new", 2))
    assert values(changes.update_from(rows, source, ["k"], {"v": "n"}, order=["d"])) == [
        (1, None, "x"), (2, "new", "y"), (3, "c", "z")]
    reset = changes.update_from(rows, source, ["k"], {"v": "n"}, scope=F.col("k") > 1, reset=True, order=["d"])
    assert values(reset) == [(1, "a", "x"), (2, "new", "y"), (3, None, "z")]


def test_upsert_is_idempotent_and_keeps_null_keys(table, values):
    target = table("k int, v string", (1, "a"), (2, "b"))
    source = table("k int, v string", (2, "B"), (2, "A"), (3, "c"), (None, "n"))
    once = changes.upsert(target, source, ["k"], ["v"])
    assert values(once) == [(None, "n"), (1, "a"), (2, "B"), (3, "c")]
    keyed_only = source.where("k is not null")
    again = changes.upsert(changes.upsert(target, keyed_only, ["k"], ["v"]), keyed_only, ["k"], ["v"])
    assert values(again) == [(1, "a"), (2, "B"), (3, "c")]


def test_refresh_flag_resets_and_sets_in_one_pass(table, values):
    dim = table("k int, end_date date, flag boolean", (1, None, True), (2, None, None), (3, None, True), (1, date(2020, 1, 1), True))
    scope, wanted = table("k int", (1,), (2,)), table("k int", (2,), (3,))
    got = changes.refresh_flag(dim, scope, wanted, "k", "flag", open_rows=F.col("end_date").isNull())
    assert values(got, "k", "flag", "end_date") == [
        (1, False, None), (1, True, date(2020, 1, 1)), (2, True, None), (3, True, None)]
    shut = changes.refresh_flag(dim, scope, wanted, "k", "flag", gate=F.lit(False))
    assert values(shut, "k", "flag") == values(dim, "k", "flag")


def test_delete_matched_with_residual(table, values):
    rows = table("k int, seq int", (1, 1), (1, 2), (2, 5), (None, 9))
    least = table("k int, least int", (1, 1), (2, 5))
    got = changes.delete_matched(rows, least, ["k"], matching.other("least") < F.col("seq"), carry=["least"])
    assert values(got) == [(None, 9), (1, 1), (2, 5)]


def test_changed_rows_treats_null_as_equal(table, values):
    new = table("k int, a string, b string", (1, None, "x"), (2, "p", "q"), (3, "r", "s"))
    cur = table("k int, a string, b string", (1, None, "x"), (2, "p", None))
    assert values(matching.changed_rows(new, cur, "k", ["a", "b"])) == [(2, "p", "q"), (3, "r", "s")]


def test_union_distinct_by_name(table, values):
    a = table("x int, y string", (1, "a"), (1, "a"))
    b = table("y string, x int", ("a", 1), ("b", 2))
    assert values(totals.union_distinct(a, b)) == [(1, "a"), (2, "b")]


def test_collapse(table, values):
    rows = table("k int, `a b` string, v int", (1, "x", 1), (1, "y", 1), (1, None, 2))
    assert values(totals.collapse(rows, ["a b"])) == [(1, None, 2), (1, "y", 1)]


# ---- history --------------------------------------------------------------------------

DIM = "member int, address string, phone string, start_date timestamp_ntz, end_date timestamp_ntz, run_id int, flag boolean"
FIRST, TODAY = datetime(2013, 1, 1), datetime(2020, 5, 1)


def merge(dim, staged, day=TODAY, **options):
    return history.scd2_merge(dim, staged, "member", ["address", "phone"], day, repair="phone",
                              extra={"run_id": F.lit(7)}, **options)


def members(table):
    dim = table(DIM, (1, "same", "2125550001", FIRST, None, 1, True), (2, "old", "2125550002", FIRST, None, 1, True),
                (3, None, "2125550003", FIRST, None, 1, None), (4, "gone", "2125550004", FIRST, datetime(2019, 1, 1), 1, True),
                (5, "quiet", "2125550005", FIRST, None, 1, None))
    staged = table("member int, address string, phone string", (1, "same", "2125550001"), (2, "new", "9990000000"),
                   (3, None, "2125550003"), (4, "back", "2125559999"), (6, "first", "123"), (7, "a", "1"), (7, "b", "2"))
    return dim, staged


def test_scd2_merge(table, values):
    dim, staged = members(table)
    got = values(merge(dim, staged), "member", "address", "phone", "start_date", "end_date", "run_id", "flag")
    assert got == [
        (1, "same", "2125550001", FIRST, None, 1, True),
        (2, "new", "2125550002", TODAY, None, 7, None),  # phone repaired from the closed row
        (2, "old", "2125550002", FIRST, TODAY, 1, True),
        (3, None, "2125550003", FIRST, None, 1, None),  # a missing address is no change
        (4, "back", "2125559999", TODAY, None, 7, None),
        (4, "gone", "2125550004", FIRST, datetime(2019, 1, 1), 1, True),
        (5, "quiet", "2125550005", FIRST, None, 1, None),
        (6, "first", "123", FIRST, None, 7, None),
        (7, "b", "2", FIRST, None, 7, None)]  # two staged rows give one open row


def test_scd2_rerun_changes_nothing(table, values):
    dim, staged = members(table)
    once = merge(dim, staged)
    assert values(merge(once, staged)) == values(once)
    assert values(merge(once, staged, datetime(2021, 1, 1))) == values(once)


def test_scd2_same_day_change_keeps_one_open_row(table, values):
    dim, staged = members(table)
    later = table("member int, address string, phone string", (1, "moved", "2125550001"), (2, "third", "2125550002"))
    twice = merge(merge(dim, staged), later)
    opened = twice.where("end_date is null").groupBy("member").count().where("count > 1").count()
    assert opened == 0
    assert values(twice.where("member = 2"), "address", "start_date", "end_date") == [
        ("new", TODAY, TODAY), ("old", FIRST, TODAY), ("third", TODAY, None)]


def test_scd2_versions_are_contiguous(spark, values):
    random.seed(3)
    dim = spark.createDataFrame([], DIM)
    for step in range(3):
        data = [(m, random.choice(["a", "b", None]), "212555" + str(random.randrange(1000, 9999))) for m in range(30)
                if random.random() < 0.8]
        staged = spark.createDataFrame(data, "member int, address string, phone string")
        state = merge(dim, staged, datetime(2020, 1 + step, 1))
        dim = spark.createDataFrame(state.collect(), DIM)
    rows = {}
    for r in dim.collect():
        rows.setdefault(r.member, []).append((r.start_date, r.end_date))
    for spans in rows.values():
        spans.sort()
        assert sum(e is None for _, e in spans) == 1 and spans[0][0] == FIRST
        assert all(spans[i][1] == spans[i + 1][0] for i in range(len(spans) - 1))


def test_scd2_as_written_gives_new_members_two_rows(table, values):
    dim, staged = members(table)
    got = values(merge(dim, staged, as_written=True).where("member = 6"), "start_date", "end_date")
    assert got == [(FIRST, TODAY), (TODAY, None)]


def test_key_filter_passes_every_partner(spark, table):
    from tidewell.operators.matching import having_match, key_filter, might_match
    rows = spark.range(0, 20_000).selectExpr("id - 10000 as id", "if(id % 7 = 0, null, concat('k', id)) as name")
    for key, wanted in (("id", spark.range(0, 500).selectExpr("id * 17 - 3000 as w")),
                        ("name", spark.range(0, 500).selectExpr("concat('k', id * 23) as w")),
                        ("id", table("w int", (5,), (None,), (5,))), ("id", table("w bigint", (None,)))):
        near, exact = might_match(rows, wanted, (key, "w")), having_match(rows, wanted, [(key, "w")])
        assert near.columns == rows.columns
        assert exact.exceptAll(near).count() == 0 and near.exceptAll(rows).count() == 0
        assert near.count() <= exact.count() + 50, key
        assert key_filter(wanted, "w").count() <= wanted.distinct().count()


def test_key_filter_runs_before_the_shuffle(spark, tmp_path, table):
    from tidewell.operators.matching import might_match
    spark.range(0, 5000).selectExpr("id", "id * 2 as v").write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    wanted = spark.range(100, 110).selectExpr("id as claim_id")
    joined = might_match(facts, wanted, ("id", "claim_id")).hint("merge").join(wanted.hint("merge"), F.col("id") == F.col("claim_id"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    side = plan[:plan.index("FileScan")]
    # From the scan upwards: the filter's join, then the exchange of the join that follows.
    assert side.index("SortMergeJoin") < side.index("Exchange hashpartitioning(id") < side.index("BroadcastHashJoin")
    assert "id >= Subquery" in plan.replace("#", " ").replace("(id", "id") or "Subquery" in plan
    assert sorted(r.v for r in joined.collect()) == [2 * k for k in range(100, 110)]


def test_claims_of_no_opportunity_go_below_the_exchange(spark, tmp_path, table):
    from dataclasses import fields

    from tidewell.plans import outreach
    claims = table("id bigint, provider_npi bigint, ndc string, drug_name string, prescription_service_num string, date_of_service date, "
                   "quantity_dispensed double, days_supply int", *[(k, k, "n", "d", "p", None, 1.0, 30) for k in range(300)])
    claims.write.parquet(str(tmp_path / "claims"))
    none = {f.name: None for f in fields(outreach.OutreachTables)}
    t = outreach.OutreachTables(**{**none, "pharmacy_claims": spark.read.parquet(str(tmp_path / "claims")),
                                   "dtp_claims": table("dtp_id int, pharmacy_claim_id bigint", (1, 5), (1, 7), (2, 8), (9, 200))})
    got = outreach.last_claims(t, table("dtp_id int", (1,), (2,), (3,)))
    assert sorted((r.dtp_id, r.claim_id, r.claim_npi) for r in got.collect()) == [(1, 7, "7"), (2, 8, "8")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    # From the filter's join down to the scan of claims nothing is shuffled.
    below = plan[plan.index("BroadcastHashJoin [CASE WHEN isnotnull(id"):] if "BroadcastHashJoin [CASE WHEN isnotnull(id" in plan else plan[plan.index("xxhash64(id"):]
    assert "bits" in below and "Exchange hashpartitioning" not in below[:below.index("FileScan")]


def test_merge_by_hash_equals_plain_merge(spark, table, values):
    """Over several runs, with NULLs, invalid numbers, several open rows and rows without a key."""
    rng = random.Random(8)
    names = "k int, a string, phone string, flag boolean, start_date timestamp_ntz, end_date timestamp_ntz, note string"

    def row(k):
        return k, rng.choice([None, "", "x", "y"]), rng.choice([None, "2125550100", "9995550100", "7185550100"]), rng.choice([None, False, True])

    start = [(*row(k), datetime(2019, 1 + k % 3, 1), datetime(2019, 6, 1) if k % 4 == 0 else None, "n") for k in range(60)]
    start += [(*row(k), datetime(2019, 5, 1), None, "second") for k in range(0, 20, 3)] + [(None, "x", None, None, datetime(2019, 1, 1), None, "nobody")]
    for rules in ({"as_written": True}, {"repair": "phone", "defaults": {"flag": False}}):
        plain = hashed = kept = table(names, *start)
        kept = kept.withColumn("row_hash", F.lit(None).cast("bigint"))
        for month in (1, 2):
            staged = table("k int, a string, phone string, flag boolean", *[row(rng.randrange(80)) for _ in range(30)], (None, "q", None, None))
            call = dict(key="k", cols=["a", "phone", "flag"], as_of=date(2020, month, 1), **rules)
            plain = history.scd2_merge(plain, staged, **call)
            hashed = history.scd2_merge_by_hash(hashed, staged, **call)
            kept = history.scd2_merge_by_hash(kept, staged, row_hash="row_hash", **call)
            want = values(plain, *[c for c in plain.columns])
            assert values(hashed, *plain.columns) == values(kept.drop("row_hash"), *plain.columns) == want
            plain, hashed, kept = (table(df.schema, *df.collect()) for df in (plain, hashed, kept))
            assert kept.where((F.col("end_date").isNull() & F.col("k").isNotNull()) != F.col("row_hash").isNotNull()).where("k is not null").count() == 0


def test_unchanged_members_move_by_key_and_hash_only(spark, tmp_path, table):
    schema = "k bigint, a string, wide string, start_date timestamp_ntz, end_date timestamp_ntz"
    rows = spark.range(0, 3000).selectExpr("id as k", "concat('a', id) as a", "repeat('w', 50) as wide",
                                           "timestamp_ntz'2020-01-01' as start_date", "cast(null as timestamp_ntz) as end_date")
    rows.write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    staged = dim.select("k", "a", "wide").where("k < 2000").withColumn("a", F.when(F.col("k") == 7, "new").otherwise(F.col("a")))
    state = history.scd2_merge_by_hash(dim, staged, "k", ["a", "wide"], date(2020, 7, 1))
    assert state.count() == 3001 and state.where("end_date is not null").count() == 1
    plan = state._jdf.queryExecution().executedPlan().toString()
    near = matching.might_match(dim, table("k bigint", (7,)), "k")
    assert near.count() < 5 and dim.columns == schema.replace(" bigint", "").replace(" string", "").replace(" timestamp_ntz", "").split(", ")
    assert "bits" in plan


def test_rows_that_pass_by_a_filter(table, values):
    rows = table("k int, v string", (1, "a"), (2, "b"), (None, "c"), (3, "d"))
    wanted = table("w bigint", (2,), (None,))
    assert values(matching.passes_by(rows, wanted, ("k", "w")), "v") == [("a",), ("c",), ("d",)]
    assert values(matching.passes_by(rows, wanted.where("false"), ("k", "w")), "v") == [("a",), ("b",), ("c",), ("d",)]
    assert values(matching.might_match(rows, wanted.where("false"), ("k", "w")), "v") == []


def test_periods_agree_with_a_loop(spark):
    """Nested, touching and endless periods, of keys with few and with many of them."""
    rng = random.Random(3)
    start = date(2019, 12, 1)
    spans = [(1, date(2020, 5, 1), date(2020, 4, 1), "z"), (None, start, start, "n"), (3, None, start, "q"), (4, start, None, "r")]
    for n in range(500):
        first = rng.randrange(0, 500)
        length = rng.choice([0, 1, 5, 30, 90, 400, None])
        spans.append((rng.randrange(4) if n % 5 else rng.randrange(4, 40), start + timedelta(first),
                      date(9999, 12, 31) if length is None else start + timedelta(first + length), rng.choice("abcd")))
    facts = [(rng.randrange(42), start + timedelta(rng.randrange(-20, 800)), i) for i in range(1500)] + [(None, start, -1), (2, None, -2)]
    f, s = spark.createDataFrame(facts, "k int, d date, i int"), spark.createDataFrame(spans, "k int, s date, e date, v string")

    def want(k, d):
        held = [x[1:] for x in spans if k is not None and d is not None and x[0] == k and x[1] and x[2] and x[1] <= d <= x[2]]
        return max(held)[2] if held else None

    got = {r.i: r.v for r in matching.as_of_period(f, s, "k", "d", "s", "e", ["v"]).collect()}
    assert got == {i: want(k, d) for k, d, i in facts} and sum(v is not None for v in got.values()) > 500
    assert matching.as_of_period(f.where("false"), s, "k", "d", "s", "e", ["v"]).count() == 0
    assert matching.as_of_period(f, s.where("false"), "k", "d", "s", "e", ["v"]).where("v is null").count() == len(facts)


def test_member_with_very_many_periods(spark):
    days, spans = 8000, 100_000
    periods = spark.range(spans).selectExpr("1 as k", "date_add(date'2000-01-01', cast(id % 7000 as int)) as s",
                                            "date_add(date'2000-01-01', cast(id % 7000 + id % 1500 as int)) as e", "id as v")
    facts = spark.range(days).selectExpr("1 as k", "date_add(date'2000-01-01', cast(id as int)) as d", "id as i")
    got = {r.i: r.v for r in matching.as_of_period(facts, periods, "k", "d", "s", "e", ["v"]).collect()}
    best = {}  # winner of each start: the longest, then the greatest
    for v in range(spans):
        best[v % 7000] = max(best.get(v % 7000, (-1, -1)), (v % 7000 + v % 1500, v))
    for day in range(0, days, 97):
        held = [(s, *best[s]) for s in range(min(day, 6999), -1, -1) if best[s][0] >= day]
        assert got[day] == (max(held)[2] if held else None)
