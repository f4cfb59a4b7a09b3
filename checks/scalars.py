"""Column expressions and filters over whole tables."""

from datetime import date

from pyspark.sql import functions as F

from checks.registry import query
from tidewell.functions import amounts, codes, dates, text
from tidewell.sources.tables import stamp

AS_OF = date(2001, 8, 1)


@query("pad_code", """
    select l_orderkey, l_linenumber, right('00000000000' || l_partkey, 11) as code,
           right('00000000000' || l_orderkey || '0000000' || l_partkey, 11) as long_code
    from lineitem""")
def _(t):
    long_code = F.concat(F.col("l_orderkey").cast("string"), F.lit("0000000"), F.col("l_partkey").cast("string"))
    return t.lineitem.select("l_orderkey", "l_linenumber", text.pad_code("l_partkey").alias("code"),
                             text.pad_code(long_code).alias("long_code"))


@query("text_forms", """
    select c_custkey, left(c_name, 4) as head, right(c_name, 3) as tail, trim('  ' || c_mktsegment || ' ') as trimmed,
           lower(c_name) as low, upper(c_name) as up, cast(length(c_mktsegment) as int) as n,
           left(c_name, 10) as cut, rpad(left(c_mktsegment, 14), 14, ' ') as padded,
           starts_with(c_mktsegment, 'B') as starts_b
    from customer""")
def _(t):
    spaced = F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))
    return t.customer.select(
        "c_custkey", text.left("c_name", 4).alias("head"), text.right("c_name", 3).alias("tail"),
        text.trim(spaced).alias("trimmed"), text.lower("c_name").alias("low"), text.upper("c_name").alias("up"),
        text.length("c_mktsegment").alias("n"), text.varchar("c_name", 10).alias("cut"),
        text.char("c_mktsegment", 14).alias("padded"), text.starts_with("c_mktsegment", "B").alias("starts_b"))


@query("concat_and_hash", """
    select c_custkey, concat(c_name, nullif(c_mktsegment, 'BUILDING')) as joined,
           c_name || nullif(c_mktsegment, 'BUILDING') as strict_joined,
           md5(concat(c_name, nullif(c_mktsegment, 'BUILDING'))) as hashed
    from customer""")
def _(t):
    segment = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return t.customer.select(
        "c_custkey", text.concat_skip_null("c_name", segment).alias("joined"),
        F.concat("c_name", segment).alias("strict_joined"), text.name_hash("c_name", segment).alias("hashed"))


@query("row_ids", """
    select o_orderkey, sha256(o_orderkey || chr(1) || o_orderstatus) as row_id, 7 as run_id, 1998 as run_year
    from orders""")
def _(t):
    rows = t.orders.select("o_orderkey", text.row_id("o_orderkey", "o_orderstatus").alias("row_id"), "o_custkey")
    return stamp(rows.drop("o_custkey"), run_id=7, run_year=1998)


PHONE = "right('0000000000' || cast(o_orderkey * 10007 as varchar), 10)"


@query("valid_phone", f"""
    select o_orderkey, {PHONE} as phone,
           left({PHONE}, 3) not in ('999','111','222','333','444','555','666','777','888','123','000') as is_valid
    from orders""")
def _(t):
    phone = text.pad_code(F.col("o_orderkey") * 10007, 10)
    return t.orders.select("o_orderkey", phone.alias("phone"), text.valid_phone(phone).alias("is_valid"))


@query("text_filters", """
    select o_orderkey, o_orderpriority from orders
    where lower(o_orderstatus) = 'p' and o_orderpriority in ('1-URGENT', '5-LOW')
      and nullif(o_orderpriority, '5-LOW') is not null and length(o_orderpriority) >= 8
      and o_totalprice between 1000 and 300000""")
def _(t):
    kept = F.nullif("o_orderpriority", F.lit("5-LOW"))
    return t.orders.where(
        text.eq_ci("o_orderstatus", "P", strip=True) & text.in_set("o_orderpriority", ["1-URGENT", "5-LOW"])
        & text.present(kept, 8) & text.between("o_totalprice", 1000, 300000)).select("o_orderkey", "o_orderpriority")


@query("excluded_keys", "select o_orderkey, o_custkey from orders where o_custkey not in (3, 5, 8)")
def _(t):
    from tidewell.operators.changes import exclude_keys
    return exclude_keys(t.orders, "o_custkey", [3, 5, 8]).select("o_orderkey", "o_custkey")


@query("year_filter", """
    select l_orderkey, l_linenumber, cast(year(l_shipdate) as int) as y from lineitem
    where year(l_shipdate) = 1998""")
def _(t):
    return t.lineitem.where(dates.in_year("l_shipdate", 1998)).select(
        "l_orderkey", "l_linenumber", dates.year("l_shipdate").alias("y"))


@query("cutover_rules", """
    select l_orderkey, l_linenumber,
           case when l_shipdate <= timestamp '1998-09-01' then l_returnflag else l_linestatus end as code
    from lineitem""")
def _(t):
    old, new = dates.cutover("l_shipdate", date(1998, 9, 1))
    code = F.when(old, F.col("l_returnflag")).when(new, F.col("l_linestatus"))
    return t.lineitem.select("l_orderkey", "l_linenumber", code.alias("code"))


@query("supply_window", """
    select l_orderkey, l_linenumber, cast(dayofyear(l_shipdate) as int) as first_no,
           cast(l_shipdate as date) + cast(l_quantity as int) - 1 as last_day,
           cast(dayofyear(cast(l_shipdate as date) + cast(l_quantity as int) - 1) as int) as last_no,
           cast(date_diff('day', cast(l_shipdate as date), date '2001-12-31') as int) as days_left,
           make_date(year(l_shipdate), 1, 1) as year_began
    from lineitem""")
def _(t):
    last = dates.supply_end("l_shipdate", "l_quantity")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", dates.day_of_year("l_shipdate").alias("first_no"), last.alias("last_day"),
        dates.day_of_year(last).alias("last_no"),
        dates.days_between(dates.year_end(2001), "l_shipdate").alias("days_left"),
        F.trunc("l_shipdate", "year").alias("year_began"))


@query("try_date_default", """
    select l_orderkey, l_linenumber,
           case l_returnflag when 'R' then date '1900-01-01' else cast(l_shipdate as date) end as filled,
           case l_returnflag when 'R' then null else cast(l_shipdate as date) end as or_null
    from lineitem""")
def _(t):
    day = F.to_date("l_shipdate").cast("string")
    american = F.concat(F.substring(day, 6, 2), F.lit("/"), F.substring(day, 9, 2), F.lit("/"), F.substring(day, 1, 4))
    unreadable = F.when(F.col("l_linestatus") == "O", F.concat(F.substring(day, 1, 4), F.lit("-13-01"))).otherwise(
        F.substring(day, 1, 4))
    raw = codes.map_codes("l_returnflag", {"A": "iso", "N": "american"}, "bad")
    raw = F.when(raw == "iso", day).when(raw == "american", american).otherwise(unreadable)
    return t.lineitem.select("l_orderkey", "l_linenumber", dates.date_or(raw, date(1900, 1, 1)).alias("filled"),
                             dates.date_or(raw).alias("or_null"))


BORN = "(date '1935-01-01' + cast(floor(c_acctbal) as int) * 3)"


def born():
    return F.date_add(F.lit(date(1935, 1, 1)), F.floor("c_acctbal").cast("int") * 3)


@query("completed_age", f"""
    with p as (select c_custkey, {BORN} as dob, cast(2001 - year({BORN}) as int) as y from customer)
    select c_custkey, dob, y - case when dob + to_years(y) > timestamp '2001-08-01' then 1 else 0 end as age from p""")
def _(t):
    rows = t.customer.select("c_custkey", born().alias("dob"))
    return rows.withColumn("age", dates.completed_age("dob", AS_OF))


@query("age_band", f"""
    with p as (select c_custkey, case when c_mktsegment = 'BUILDING' then null else 2001 - year({BORN}) end as y
               from customer)
    select c_custkey,
           case when y <= 10 then '0 - tens' when y between 11 and 19 then 'teens'
                when y between 20 and 29 then 'twenties' when y between 30 and 39 then 'thirties'
                when y between 40 and 49 then 'forties' when y between 50 and 59 then 'fifties'
                when y between 60 and 69 then 'sixties' when y between 70 and 79 then 'seventies'
                when y between 80 and 89 then 'eighties' when y >= 90 then 'ninety_andabove' else 'nodob' end as band,
           cast(case when y <= 10 then 0 when y >= 90 then 9 when y is null then 999 else floor(y / 10) end as int) as sort_key
    from p""")
def _(t):
    dob = F.when(F.col("c_mktsegment") != "BUILDING", born())
    rows = t.customer.select("c_custkey", dob.alias("dob"))
    return rows.select("c_custkey", codes.age_band("dob", AS_OF).alias("band"),
                       codes.age_band_sort("dob", AS_OF).alias("sort_key"))


@query("local_time", """
    select event_id, ts - interval 6 hour as local_ts, cast(ts - interval 6 hour as date) as local_day from events""")
def _(t):
    local = dates.to_local("ts", "America/Chicago")
    return t.events.select("event_id", local.alias("local_ts"), dates.day_key(local).alias("local_day"))


@query("clamp_period", """
    with p as (select o_orderkey, cast(o_orderdate as date) as s,
                      cast(o_orderdate as date) + cast(floor(o_totalprice / 500) as int) as e from orders),
         q as (select *, case when year(e) > 1998 then date '1998-12-31' else e end as e2 from p)
    select o_orderkey, case when year(s) < 1998 and year(e2) = 1998 then date '1998-01-01' else s end as period_start,
           e2 as period_end
    from q""")
def _(t):
    start = F.to_date("o_orderdate")
    end = F.date_add(start, F.floor(F.col("o_totalprice") / 500).cast("int"))
    first, last = dates.clamp_period(start, end, 1998)
    return t.orders.select("o_orderkey", first.alias("period_start"), last.alias("period_end"))


def overpunched(digits, negative):
    """Digits with the last one replaced by the character for digit and sign."""
    last = F.right(digits, F.lit(1))
    sign = F.when(negative, F.translate(last, "0123456789", amounts.NEGATIVE_SIGNS)).otherwise(
        F.translate(last, "0123456789", amounts.POSITIVE_SIGNS))
    return F.concat(F.substring(digits, F.lit(1), F.length(digits) - 1), sign)


def cents(name):
    return F.round(F.col(name) * 100).cast("bigint").cast("string")


@query("implied_decimal", """
    select l_orderkey, l_linenumber, l_extendedprice as amount,
           case when l_returnflag = 'A' then -l_extendedprice else l_extendedprice end as packed,
           case when l_linestatus = 'O' then 0 else l_extendedprice end as blank_is_zero,
           cast(cast(round(l_extendedprice * 100) as bigint) // 1000 as double) as quantity
    from lineitem""")
def _(t):
    digits = cents("l_extendedprice")
    packed = overpunched(digits, F.col("l_returnflag") == "A")
    blank = F.when(F.col("l_linestatus") == "O", F.lit("")).otherwise(overpunched(digits, F.lit(False)))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", amounts.implied_decimal(digits).cast("double").alias("amount"),
        amounts.packed_money(packed).cast("double").alias("packed"),
        amounts.packed_money(blank).cast("double").alias("blank_is_zero"),
        amounts.packed_quantity(overpunched(digits, F.lit(False))).alias("quantity"))


@query("typed_casts", """
    select l_orderkey, l_linenumber,
           case when l_returnflag = 'R' then null else l_linenumber end as typed_value,
           l_returnflag = 'R' as is_dirty, l_extendedprice as amount,
           cast(round(l_quantity + 0.6) as int) as rounded
    from lineitem""")
def _(t):
    raw = F.when(F.col("l_returnflag") == "R", F.lit("12.7x")).otherwise(F.col("l_linenumber").cast("string"))
    money = F.concat(F.lit("$"), F.col("l_extendedprice").cast("string"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", amounts.typed(raw, "int").alias("typed_value"),
        amounts.dirty(raw, "int").alias("is_dirty"), amounts.money(money).cast("double").alias("amount"),
        amounts.rounded(F.col("l_quantity") + 0.6).cast("int").alias("rounded"))


@query("blank_sentinel", """
    select o_orderkey, case when o_orderstatus = 'P' then 'none' else o_orderstatus end as status,
           coalesce(nullif(o_orderpriority, '5-LOW'), 'unknown') as priority
    from orders""")
def _(t):
    blank = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderstatus"))
    return t.orders.select("o_orderkey", text.blank_to(blank, "none").alias("status"),
                           F.coalesce(F.nullif("o_orderpriority", F.lit("5-LOW")), F.lit("unknown")).alias("priority"))


@query("code_map", """
    select o_orderkey,
           case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'first' when o_orderpriority = '3-MEDIUM' then 'second'
                else 'last' end as lane,
           case when o_orderpriority in ('1-URGENT', '5-LOW') then o_orderstatus else o_orderpriority end as picked,
           case when o_orderstatus = 'P' and nullif(o_custkey, 3) is null then 0
                else nullif(o_custkey, 3) end as detail,
           'fixed' as fixed, cast(null as date) as never
    from orders""")
def _(t):
    lane = codes.map_codes("o_orderpriority", {("1-URGENT", "2-HIGH"): "first", "3-MEDIUM": "second"}, "last")
    picked = codes.pick("o_orderpriority", ["1-URGENT", "5-LOW"], F.col("o_orderstatus"), F.col("o_orderpriority"))
    status = F.when(F.col("o_orderstatus") == "P", 2).otherwise(1)
    return t.orders.select(
        "o_orderkey", lane.alias("lane"), picked.alias("picked"),
        codes.recode_missing_detail(status, F.nullif("o_custkey", F.lit(3))).alias("detail"),
        F.lit("fixed").alias("fixed"), F.lit(None).cast("date").alias("never"))


@query("distinct_rows", "select distinct l_suppkey, l_returnflag, l_linestatus from lineitem")
def _(t):
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()
