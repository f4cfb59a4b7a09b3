"""Joins: new rows, matching rows, lookups, periods, top-1."""

from datetime import date

from pyspark.sql import functions as F

from checks.registry import query
from tidewell.functions import text
from tidewell.operators import changes, matching, picking

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"]


@query("star_join", """
    select n_name, p_type, count(*) as n_claims, sum(cast(l_quantity as bigint)) as days
    from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
         join nation on c_nationkey = n_nationkey join part on l_partkey = p_partkey
    group by all""")
def _(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy("n_name", "p_type").agg(
        F.count(F.lit(1)).alias("n_claims"), F.sum(F.col("l_quantity").cast("bigint")).alias("days"))


@query("claims_known_excluded", """
    select l_orderkey, l_linenumber, l_partkey, l_shipdate from lineitem
    where not exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus = 'F')""")
def _(t):
    known = t.orders.where("o_orderstatus = 'F'")
    return matching.only_new(t.lineitem, known, [("l_orderkey", "o_orderkey")]).select(*LINE)


@query("claims_known_excluded_nullsafe", """
    with l as (select *, case when l_linestatus = 'O' then null else l_orderkey end as k from lineitem),
         o as (select case when o_totalprice > 400000 then null else o_orderkey end as k from orders
               where o_orderstatus = 'F')
    select l_orderkey, l_linenumber, l_partkey, l_shipdate from l
    where not exists (select 1 from o where o.k is not distinct from l.k)""")
def _(t):
    lines = t.lineitem.withColumn("k", F.when(F.col("l_linestatus") != "O", F.col("l_orderkey")))
    known = t.orders.where("o_orderstatus = 'F'").select(
        F.when(F.col("o_totalprice") <= 400000, F.col("o_orderkey")).alias("k"))
    return matching.only_new(lines, known, ["k"], null_safe=True).select(*LINE)


@query("claims_with_match", """
    select l_orderkey, l_linenumber, l_partkey, l_shipdate from lineitem
    where exists (select 1 from orders where o_orderkey = l_orderkey and o_orderdate > l_shipdate)""")
def _(t):
    late = matching.other("o_orderdate") > F.col("l_shipdate")
    return matching.having_match(t.lineitem, t.orders, [("l_orderkey", "o_orderkey")], late,
                                 carry=["o_orderdate"]).select(*LINE)


@query("members_in_list", """
    select c_custkey from customer where c_custkey in (select o_custkey from orders where o_totalprice > 490000)""")
def _(t):
    return matching.having_match(t.customer, t.orders.where("o_totalprice > 490000"),
                                 [("c_custkey", "o_custkey")]).select("c_custkey")


@query("not_in_list", """
    select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_totalprice > 300000)""")
def _(t):
    return matching.not_in(t.customer, t.orders.where("o_totalprice > 300000"), "c_custkey", "o_custkey").select("c_custkey")


@query("not_in_list_with_null", """
    select c_custkey from customer where c_custkey not in
        (select case when o_orderstatus = 'P' then null else o_custkey end from orders)""")
def _(t):
    keys = t.orders.select(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"))
    return matching.not_in(t.customer, keys, "c_custkey", "k").select("c_custkey")


@query("drug_lookup", """
    with d as (select right('00000000000' || p_partkey, 11) as code, min(least(p_name, p_brand)) as drug
               from part where p_size <= 40 group by 1)
    select l_orderkey, l_linenumber, l_shipdate, drug from lineitem
    left join d on right('00000000000' || l_partkey, 11) = code""")
def _(t):
    listed = t.part.where("p_size <= 40")
    code = text.pad_code("p_partkey").alias("code")
    drugs = listed.select(code, F.col("p_name").alias("drug")).unionByName(
        listed.select(code, F.col("p_brand").alias("drug")))
    found = matching.lookup(t.lineitem, drugs, [(text.pad_code("l_partkey"), "code")], ["drug"])
    return found.select("l_orderkey", "l_linenumber", "l_shipdate", "drug")


@query("join_without_case", """
    select o_orderkey, c_name from orders join customer on lower('CUST' || o_custkey) = lower('cust' || c_custkey)""")
def _(t):
    left = t.orders.select("o_orderkey", F.concat(F.lit("CUST"), "o_custkey").alias("a"))
    right = t.customer.select("c_name", F.concat(F.lit("cust"), "c_custkey").alias("b"))
    return matching.join_ci(left, right, "a", "b").select("o_orderkey", "c_name")


@query("join_across_types", """
    select o_orderkey, c_name from orders
    join (select *, case when c_mktsegment = 'BUILDING' then null else c_custkey end as k from customer) on o_custkey = k""")
def _(t):
    dirty = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("n/a")).otherwise(F.col("c_custkey").cast("string"))
    members = t.customer.select("c_name", dirty.alias("k"))
    return matching.join_cast(t.orders, members, "o_custkey", "k", "bigint").select("o_orderkey", "c_name")


@query("join_on_padded_code", """
    select l_orderkey, l_linenumber, l_shipdate, p_name from lineitem
    join part on right('00000000000' || l_partkey, 11) = right('00000000000' || p_partkey, 11)""")
def _(t):
    return matching.join_on(t.lineitem, t.part, text.pad_code("l_partkey"), text.pad_code("p_partkey")).select(
        "l_orderkey", "l_linenumber", "l_shipdate", "p_name")


@query("claims_first_sequence", """
    with m as (select l_orderkey as k, min(l_linenumber) as least from lineitem where l_returnflag = 'N' group by 1)
    select l_orderkey, l_linenumber, l_partkey, l_shipdate
    from lineitem join m on l_orderkey = k and l_linenumber = least where l_returnflag = 'N'""")
def _(t):
    paid = t.lineitem.where("l_returnflag = 'N'")
    return picking.latest_with_ties(paid, ["l_orderkey"], "l_linenumber", "min").select(*LINE)


@query("latest_order_with_ties", """
    select o_orderkey, o_custkey, o_orderdate from
        (select *, rank() over (partition by o_custkey order by year(o_orderdate) desc) as r from orders) where r = 1""")
def _(t):
    return picking.latest_with_ties(t.orders, ["o_custkey"], F.year("o_orderdate")).select(
        "o_orderkey", "o_custkey", "o_orderdate")


@query("one_per_key", """
    select o_custkey, o_orderdate, o_orderstatus, o_orderpriority from
        (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as r from orders)
    where r = 1""")
def _(t):
    return matching.one_per_key(t.orders, ["o_custkey"], ["o_orderdate", "o_orderstatus", "o_orderpriority"],
                                order=["o_orderdate", "o_orderkey"])


@query("top1_per_key", """
    with o as (select *, case when o_orderstatus = 'P' then null else o_orderdate end as d from orders)
    select o_custkey, o_orderkey, d from
        (select *, row_number() over (partition by o_custkey order by d desc nulls first, o_orderkey) as r from o)
    where r = 1""")
def _(t):
    rows = t.orders.withColumn("d", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))
    return picking.top1_per_key(rows, ["o_custkey"], [F.col("d").desc_nulls_first(), F.col("o_orderkey")]).select(
        "o_custkey", "o_orderkey", "d")


@query("claims_latest_version", """
    select l_orderkey, l_linenumber, l_partkey, l_shipdate from
        (select *, row_number() over (partition by l_orderkey order by l_shipdate desc, l_linenumber desc,
                l_partkey desc, l_suppkey desc, l_extendedprice desc) as r from lineitem) where r = 1""")
def _(t):
    return picking.dedup_latest(t.lineitem, ["l_orderkey"], ["l_shipdate", "l_linenumber"],
                                ["l_partkey", "l_suppkey", "l_extendedprice"]).select(*LINE)


# Orders of a customer are its plan periods, open for a quarter.
PERIODS = """
    p as (select o_custkey as member, cast(o_orderdate as date) as s,
                 max(cast(o_orderdate as date) + 90) over (partition by o_custkey, o_orderdate, left(o_orderpriority, 5)) as e,
                 left(o_orderpriority, 5) as plan from orders),
    c as (select l_orderkey, l_linenumber, l_partkey, l_shipdate, o_custkey as member,
                 case when l_linestatus = 'O' then '' else 'SET' end as account
          from lineitem join orders on l_orderkey = o_orderkey),
    d as (select distinct member, cast(l_shipdate as date) as day from c),
    h as (select d.member, d.day, plan, row_number() over (partition by d.member, d.day
                 order by s desc, e desc, plan desc) as r
          from d join p on p.member = d.member and d.day between s and e)"""


def periods_and_claims(t):
    day = F.to_date("o_orderdate")
    periods = t.orders.select(F.col("o_custkey").alias("member"), day.alias("s"), F.date_add(day, 90).alias("e"),
                              F.left("o_orderpriority", F.lit(5)).alias("plan"))
    claims = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        *LINE, F.col("o_custkey").alias("member"),
        F.when(F.col("l_linestatus") == "O", "").otherwise("SET").alias("account"))
    return periods, claims


@query("claims_in_period", f"""
    with {PERIODS}
    select l_orderkey, l_linenumber, l_partkey, l_shipdate, c.member, plan
    from c left join h on h.member = c.member and day = cast(l_shipdate as date) and r = 1""")
def _(t):
    periods, claims = periods_and_claims(t)
    return matching.as_of_period(claims.drop("account"), periods, "member", "l_shipdate", "s", "e", ["plan"])


@query("claims_account_from_period", f"""
    with {PERIODS}
    select l_orderkey, l_linenumber, l_partkey, l_shipdate, c.member,
           case when account = '' and plan is not null then left(plan, 3) else account end as account
    from c left join h on h.member = c.member and day = cast(l_shipdate as date) and r = 1""")
def _(t):
    periods, claims = periods_and_claims(t)
    return changes.fill_blank_from_period(claims, periods, "member", "l_shipdate", "s", "e", "account", "plan",
                                          transform=lambda c: text.left(c, 3))


@query("members_covered_on_day", """
    select c_custkey from customer where exists
        (select 1 from orders where o_custkey = c_custkey and date '1998-06-30' between cast(o_orderdate as date)
                and cast(o_orderdate as date) + 90)""")
def _(t):
    periods, _ = periods_and_claims(t)
    members = t.customer.select("c_custkey", F.col("c_custkey").alias("member"))
    return matching.covered_on(members, periods, "member", date(1998, 6, 30), "s", "e").select("c_custkey")


@query("changed_rows", """
    with a as (select c_custkey, nullif(c_mktsegment, 'BUILDING') as seg, c_nationkey from customer),
         b as (select c_custkey, case when c_acctbal < 0 then 'X' else nullif(c_mktsegment, 'BUILDING') end as seg,
                      c_nationkey from customer where c_nationkey < 20)
    select * from a where not exists (select 1 from b where b.c_custkey = a.c_custkey
        and b.seg is not distinct from a.seg and b.c_nationkey is not distinct from a.c_nationkey)""")
def _(t):
    seg = F.nullif("c_mktsegment", F.lit("BUILDING"))
    new = t.customer.select("c_custkey", seg.alias("seg"), "c_nationkey")
    cur = t.customer.where("c_nationkey < 20").select(
        "c_custkey", F.when(F.col("c_acctbal") < 0, "X").otherwise(seg).alias("seg"), "c_nationkey")
    return matching.changed_rows(new, cur, "c_custkey", ["seg", "c_nationkey"])


@query("previous_value", """
    select c_custkey, (select o_orderpriority from orders where o_custkey = c_custkey and o_orderstatus = 'F'
                       order by o_orderdate desc, o_orderpriority desc limit 1) as previous_o_orderpriority
    from customer""")
def _(t):
    closed = t.orders.where("o_orderstatus = 'F'").withColumnRenamed("o_custkey", "c_custkey")
    return matching.prev_value(t.customer.select("c_custkey"), closed, "c_custkey", "o_orderpriority", "o_orderdate")
