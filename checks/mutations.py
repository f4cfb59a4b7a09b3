"""Changes: old table state to new table state."""

from datetime import datetime

from pyspark.sql import functions as F

from checks.registry import query
from tidewell.functions import text
from tidewell.operators import changes, history, matching, picking
from tidewell.params import RunParams
from tidewell.plans import runs

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"]
P = RunParams(client_id=1, run_year=1998, as_of=datetime(1998, 6, 30, 12), run_id=9)


@query("claims_reversed_flag", """
    select l_orderkey, l_linenumber, l_partkey, l_shipdate,
           case when l_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R') then 333 end as claimexccd
    from lineitem""")
def _(t):
    claims = t.lineitem.select(*LINE, F.lit(None).cast("int").alias("claimexccd"))
    return changes.flag_matched(claims, t.lineitem.where("l_returnflag = 'R'"), ["l_orderkey"], {"claimexccd": 333})


@query("claims_not_reversed", """
    select l_orderkey, l_linenumber, l_partkey, l_shipdate from lineitem
    where l_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')""")
def _(t):
    claims = t.lineitem.select(*LINE, F.lit(None).cast("int").alias("claimexccd"))
    flagged = changes.flag_matched(claims, t.lineitem.where("l_returnflag = 'R'"), ["l_orderkey"], {"claimexccd": 333})
    return changes.not_reversed(flagged).drop("claimexccd")


@query("claims_delete_later_sequence", """
    select l_orderkey, l_linenumber, l_partkey, l_shipdate from lineitem l
    where not exists (select 1 from (select l_orderkey as k, min(l_linenumber) as least from lineitem
                                     where l_returnflag = 'N' group by 1) m
                      where k = l.l_orderkey and least < l.l_linenumber)""")
def _(t):
    least = t.lineitem.where("l_returnflag = 'N'").groupBy("l_orderkey").agg(F.min("l_linenumber").alias("least"))
    return changes.delete_matched(t.lineitem, least, ["l_orderkey"], matching.other("least") < F.col("l_linenumber"),
                                  carry=["least"]).select(*LINE)


@query("claims_status_refresh", """
    with s as (select l_orderkey as k, l_linenumber as n, l_returnflag as f, row_number() over
                      (partition by l_orderkey, l_linenumber order by l_shipdate desc, l_returnflag desc) as r
               from lineitem where l_linestatus = 'O')
    select l_orderkey, l_linenumber, l_partkey, l_shipdate, coalesce(f, l_returnflag) as status
    from lineitem left join s on k = l_orderkey and n = l_linenumber and r = 1""")
def _(t):
    lines = t.lineitem.select(*LINE, F.col("l_returnflag").alias("status"))
    source = t.lineitem.where("l_linestatus = 'O'")
    return changes.update_from(lines, source, ["l_orderkey", "l_linenumber"], {"status": "l_returnflag"},
                               order=["l_shipdate"])


@query("columns_reset_and_copied", """
    with b as (select o_custkey as k, max(o_orderpriority) as discount from orders where year(o_orderdate) = 1998 group by 1)
    select c_custkey, c_mktsegment,
           case when c_mktsegment = 'BUILDING' then discount else c_name end as benefit
    from customer left join b on k = c_custkey""")
def _(t):
    rows = t.customer.select("c_custkey", "c_mktsegment", F.col("c_name").alias("benefit"))
    benefits = t.orders.where(F.year("o_orderdate") == 1998)
    return changes.update_from(rows, benefits, [("c_custkey", "o_custkey")], {"benefit": "o_orderpriority"},
                               scope=F.col("c_mktsegment") == "BUILDING", reset=True)


@query("flag_refresh", """
    with newest as (select max(cast(o_orderdate as date)) as d from orders),
         listed as (select distinct o_custkey as k from orders, newest
                    where cast(o_orderdate as date) > d - 90)
    select c_custkey, c_mktsegment,
           case when c_mktsegment in ('BUILDING', 'MACHINERY') and c_acctbal >= 0 then k is not null
                else c_nationkey > 12 end as flag
    from customer left join listed on k = c_custkey""")
def _(t):
    dim = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal", (F.col("c_nationkey") > 12).alias("flag"))
    scope = t.customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    newest = t.orders.agg(F.max(F.to_date("o_orderdate"))).scalar()
    listed = t.orders.where(F.to_date("o_orderdate") > F.date_sub(newest, 90))
    listed = listed.select(F.col("o_custkey").alias("c_custkey"))
    return changes.refresh_flag(dim, scope, listed, "c_custkey", "flag", open_rows=F.col("c_acctbal") >= 0).drop("c_acctbal")


@query("program_flag", """
    select c_custkey, case when c_mktsegment = 'BUILDING' and exists
           (select 1 from orders where o_custkey = c_custkey and o_totalprice > 450000) then true
           else c_acctbal < 0 end as esrd
    from customer""")
def _(t):
    dim = t.customer.select("c_custkey", "c_mktsegment", (F.col("c_acctbal") < 0).alias("esrd"))
    listed = t.orders.where("o_totalprice > 450000")
    return changes.flag_matched(dim, listed, [("c_custkey", "o_custkey")], {"esrd": True},
                                F.col("c_mktsegment") == "BUILDING").drop("c_mktsegment")


@query("tri_state_flag", """
    with m as (select o_custkey as k, max(case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 2 else 0 end) as code
               from orders where o_orderstatus = 'P' group by 1)
    select c_custkey, coalesce(code, 9) as supd from customer left join m on k = c_custkey""")
def _(t):
    from tidewell.functions.codes import map_codes
    feed = t.orders.where("o_orderstatus = 'P'").withColumn(
        "code", map_codes("o_orderpriority", {"1-URGENT": 1, "2-HIGH": 2}, 0))
    dim = t.customer.select("c_custkey", F.lit(9).alias("supd"))
    return changes.update_from(dim, feed, [("c_custkey", "o_custkey")], {"supd": "code"})


# A dimension of customers built from their orders: address = nation, phone = number of an order.
def detail(t, upto):
    """Latest order of each customer before a day, as a member's detail."""
    rows = t.orders.where(F.col("o_orderdate") < F.lit(upto))
    rows = matching.one_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey", "o_orderpriority", "o_orderstatus"],
                                order=["o_orderdate", "o_orderkey"])
    return rows.select(
        F.col("o_custkey").alias("member"), F.nullif("o_orderstatus", F.lit("P")).alias("address"),
        F.col("o_orderpriority").alias("plan"), text.pad_code(F.col("o_orderkey") * 10007, 10).alias("phone"))


DETAIL = """
    (select o_custkey as member, nullif(o_orderstatus, 'P') as address, o_orderpriority as plan,
            right('0000000000' || cast(o_orderkey * 10007 as varchar), 10) as phone,
            row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as r
     from orders where o_orderdate < date '{day}')"""
BAD_PHONE = "(left({0}, 3) in ('999','111','222','333','444','555','666','777','888','123','000') or length(trim({0})) < 10 or {0} is null)"


SCD2_DETAIL = f"""
    with o as (select * from {DETAIL.format(day='1997-01-01')} where r = 1),
         n as (select * from {DETAIL.format(day='1998-01-01')} where r = 1),
         j as (select o.member as om, n.member as nm, o.address as oa, n.address as na, o.plan as op, n.plan as np,
                      o.phone as oph, n.phone as nph,
                      o.address is not distinct from n.address and o.plan = n.plan
                          and (o.phone = n.phone or {BAD_PHONE.format('n.phone')}) as same
               from o full join n on o.member = n.member),
         open_and_closed as (
            select om as member, oa as address, op as plan, oph as phone, timestamp '2013-01-01' as start_date,
                   case when nm is not null and not same then timestamp '2014-06-30' end as end_date from j where om is not null
            union all
            select nm, na, np, case when {BAD_PHONE.format('nph')} then oph else nph end,
                   timestamp '2014-06-30', null from j where om is not null and nm is not null and not same
            union all
            select nm, na, np, nph, timestamp '2013-01-01', null from j where om is null)
    select * from open_and_closed
    union all
    select member, address, plan, phone, timestamp '2012-01-01', timestamp '2013-01-01'
    from {DETAIL.format(day='1996-01-01')} where r = 1 and member in (select om from j)
    union all
    select om, oa, op, oph, timestamp '2012-06-01', timestamp '2014-06-30' from j where om % 7 = 0"""


def history_case(t):
    no_end = F.lit(None).cast("timestamp_ntz")
    first = F.lit("2013-01-01").cast("timestamp_ntz")
    current = detail(t, "1997-01-01").withColumns({"start_date": first, "end_date": no_end})
    closed = detail(t, "1996-01-01").withColumns({"start_date": F.lit("2012-01-01").cast("timestamp_ntz"), "end_date": first})
    older = current.where("member % 7 = 0").withColumn("start_date", F.lit("2012-06-01").cast("timestamp_ntz"))
    newest = detail(t, "1998-01-01").withColumn("seen", F.lit(2))
    staged = newest.unionByName(newest.where("member % 5 = 0").withColumns({"plan": F.lit("9-STALE"), "seen": F.lit(1)}))
    return current.unionByName(closed).unionByName(older), staged


HISTORY_RULES = {"key": "member", "cols": ["address", "plan", "phone"], "as_of": datetime(2014, 6, 30), "repair": "phone", "order": ["seen"]}


@query("scd2_detail", SCD2_DETAIL)
def _(t):
    return history.scd2_merge(*history_case(t), **HISTORY_RULES)


@query("scd2_detail_by_hash", SCD2_DETAIL)
def _(t):
    """Some open versions keep their hash, others have none yet."""
    dim, staged = history_case(t)
    kept = F.when((F.col("member") % 2 == 0) & F.col("end_date").isNull(), history.row_digest(HISTORY_RULES["cols"]))
    state = history.scd2_merge_by_hash(dim.withColumn("row_hash", kept), staged, row_hash="row_hash", **HISTORY_RULES)
    return state.drop("row_hash")


@query("guardian_upsert", """
    with old as (select o_custkey as k, cast(o_orderdate as date) as s, max(o_orderdate) as e, max(o_orderstatus) as phone
                 from orders where o_orderdate < date '1999-01-01' group by 1, 2),
         new as (select o_custkey as k, cast(o_orderdate as date) as s,
                        max(struct_pack(p := o_orderpriority, e := o_orderdate + interval 1 year)) as m
                 from orders where o_orderdate >= date '1998-01-01' group by 1, 2)
    select coalesce(old.k, new.k) as k, coalesce(old.s, new.s) as s, coalesce(m.e, old.e) as e, coalesce(m.p, phone) as phone
    from old full join new on old.k = new.k and old.s = new.s""")
def _(t):
    rows = t.orders.select(F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("s"), "o_orderdate",
                           "o_orderpriority", "o_orderstatus")
    old = rows.where("o_orderdate < '1999-01-01'").groupBy("k", "s").agg(
        F.max("o_orderdate").alias("e"), F.max("o_orderstatus").alias("phone"))
    new = rows.where("o_orderdate >= '1998-01-01'").select(
        "k", "s", F.col("o_orderpriority").alias("phone"), (F.col("o_orderdate") + F.expr("interval 1 year")).alias("e"))
    return changes.upsert(old, new, ["k", "s"], ["e", "phone"])


@query("billing_pending", """
    with r as (select o_orderkey as id, o_custkey as client, year(o_orderdate)::int as y, o_orderdate as create_datetime,
                      case when o_orderstatus = 'F' then o_orderdate end as completed from orders),
         w as (select distinct o_custkey as client, year(o_orderdate)::int as y from orders where o_orderpriority = '5-LOW')
    select id, r.client, r.y, completed,
           case when completed is null and w.client is not null then timestamp '1998-06-30 12:00:00'
                else create_datetime end as create_datetime
    from r left join w on w.client = r.client and w.y = r.y
    union all
    select null, client, y, null, timestamp '1998-06-30 12:00:00' from w
    where not exists (select 1 from r where r.client = w.client and r.y = w.y and completed is null)""")
def _(t):
    year = F.year("o_orderdate").alias("y")
    requests = t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("client"), year,
        F.col("o_orderdate").alias("create_datetime"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("completed"))
    wanted = t.orders.where("o_orderpriority = '5-LOW'").select(F.col("o_custkey").alias("client"), year).distinct()
    return runs.upsert_pending(requests, wanted, ("client", "y"), P)


@query("history_upsert", """
    with h as (select o_custkey as c, o_orderstatus as ft, o_orderdate as d, 1 as n from orders
               where o_orderdate < date '1998-01-01'),
         g as (select o_custkey as c, o_orderstatus as ft, o_orderdate + interval 5 hour as d,
                      case when o_orderpriority = '5-LOW' then 0 else 1 end as n from orders
               where o_orderdate >= date '1997-01-01'),
         q as (select c, ft, n, cast(d as date) as day, max(d) as d from g where n <> 0 group by all)
    select h.c as pmd_client_id, h.ft as filetype, coalesce(q.d, h.d) as lastdatereceived, h.n as unprocessed_filecount
    from h left join q on q.c = h.c and q.ft = h.ft and q.n = h.n and q.day = cast(h.d as date)
    union all
    select c, ft, d, n from g where n <> 0 and not exists
        (select 1 from h where h.c = g.c and h.ft = g.ft and h.n = g.n and cast(h.d as date) = cast(g.d as date))""")
def _(t):
    def entries(rows, count, shift="interval 0 hour"):
        return rows.select(F.col("o_custkey").alias("pmd_client_id"), F.col("o_orderstatus").alias("filetype"),
                           (F.col("o_orderdate") + F.expr(shift)).alias("lastdatereceived"),
                           count.alias("unprocessed_filecount"))
    old = entries(t.orders.where("o_orderdate < '1998-01-01'"), F.lit(1))
    new = entries(t.orders.where("o_orderdate >= '1997-01-01'"),
                  F.when(F.col("o_orderpriority") == "5-LOW", 0).otherwise(1), "interval 5 hour")
    return runs.history_upsert(old, new)


@query("queue_states", """
    with c as (select o_orderkey as id, o_custkey as client, year(o_orderdate)::int as runyear, o_orderstatus = 'P' as ind,
                      case o_orderstatus when 'O' then 0 else 1 end as process, o_orderdate as queued from orders),
         r as (select distinct o_custkey as client from orders where o_totalprice > 450000),
         q as (select id, c.client, runyear, ind,
                      case when r.client is not null and runyear = 1998 and process = 0 then 1 else process end as process,
                      case when r.client is not null and runyear = 1998 and process = 0 then timestamp '1998-06-30 12:00:00'
                           else queued end as queued
               from c left join r on r.client = c.client)
    select id as controlid, client as pmdclientid, runyear, false as process_ind,
           case when ind then 0 else process end as process, queued as filewatcherqueuedate from q""")
def _(t):
    control = t.orders.select(
        F.col("o_orderkey").alias("controlid"), F.col("o_custkey").alias("pmdclientid"), F.year("o_orderdate").alias("runyear"),
        (F.col("o_orderstatus") == "P").alias("process_ind"),
        F.when(F.col("o_orderstatus") == "O", 0).otherwise(1).alias("process"),
        F.col("o_orderdate").alias("filewatcherqueuedate"))
    ready = t.orders.where("o_totalprice > 450000").select(F.col("o_custkey").alias("pmd_client_id"))
    queued = runs.queue_transition(control, "queued", P, ready=ready)
    return runs.queue_transition(queued, "idle", P)


@query("run_ledger", """
    select o_orderkey as run_id, o_custkey::int as pmd_client_id, o_orderdate as run_datetime, 'Success' as stars_patients,
           'Not Complete' as stars_patients_detail, cast(null as bigint) as patients_imported,
           cast(null as timestamp) as stars_patients_complete_datetime
    from orders where o_orderstatus = 'F'
    union all
    select -1, 1, timestamp '1998-06-30 12:00:00', 'Success', 'Not Complete', (select count(*) from customer),
           timestamp '1998-06-30 12:00:00'""")
def _(t):
    p = RunParams(client_id=1, run_year=1998, as_of=datetime(1998, 6, 30, 12), run_id=-1)
    ledger = t.orders.where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("run_id"), F.col("o_custkey").cast("int").alias("pmd_client_id"),
        F.col("o_orderdate").alias("run_datetime"), F.lit("Success").alias("stars_patients"),
        F.lit("Not Complete").alias("stars_patients_detail"), F.lit(None).cast("bigint").alias("patients_imported"))
    opened = runs.run_open(ledger, p)
    return runs.run_close(opened, p, "stars_patients",
                          {"patients_imported": t.customer.agg(F.count(F.lit(1))).scalar()})


@query("last_complete_run", """
    select coalesce(max(o_orderdate), timestamp '1900-01-01') as last_run from orders
    where o_custkey = 7 and o_orderstatus = 'F'""")
def _(t):
    ledger = t.orders.select(
        F.col("o_custkey").alias("pmd_client_id"), F.col("o_orderdate").alias("run_datetime"),
        F.when(F.col("o_orderstatus") == "F", "Success").otherwise("Not Complete").alias("stars_patients"))
    return runs.last_complete(ledger, 7, "stars_patients")


@query("not_in_export", """
    with a as (select o_orderkey as evalrun_id, cast(left(o_orderpriority, 1) as int) as client, o_orderstatus, o_totalprice
               from orders where o_orderstatus <> 'O'),
         x as (select evalrun_id, client from a where o_totalprice > 300000),
         m as (select coalesce(max(evalrun_id), 0) as newest from a where client = 1
               and evalrun_id not in (select evalrun_id from x where client = 1))
    select a.evalrun_id, client as pmd_client_id, a.o_orderstatus, year(o_orderdate)::int as run_runyear
    from a join m on a.evalrun_id = newest join orders on o_orderkey = a.evalrun_id""")
def _(t):
    status = t.orders.where("o_orderstatus <> 'O'").select(
        F.col("o_orderkey").alias("evalrun_id"), F.left("o_orderpriority", F.lit(1)).cast("int").alias("pmd_client_id"),
        "o_orderstatus", "o_totalprice")
    exported = status.where("o_totalprice > 300000").select("evalrun_id", "pmd_client_id")
    run_list = t.orders.select(F.col("o_orderkey").alias("evalrun_id"), F.year("o_orderdate").alias("runyear"))
    return runs.member_measures(status.drop("o_totalprice"), run_list, exported, 1)


@query("not_in_export_with_null", """
    select coalesce(max(o_orderkey), 0) as evalrun_id from orders where left(o_orderpriority, 1) = '1' and o_orderkey not in
        (select case when o_orderstatus = 'P' then null else o_orderkey end from orders where left(o_orderpriority, 1) = '1')""")
def _(t):
    status = t.orders.select(F.col("o_orderkey").alias("evalrun_id"),
                             F.left("o_orderpriority", F.lit(1)).cast("int").alias("pmd_client_id"), "o_orderstatus")
    exported = status.withColumn("evalrun_id", F.when(F.col("o_orderstatus") != "P", F.col("evalrun_id")))
    return runs.newest_not_exported(status, exported, 1)


@query("first_and_repeated", """
    select l_orderkey, l_linenumber, l_partkey, l_shipdate, r = 1 as is_first from
        (select *, row_number() over (partition by l_orderkey, l_linenumber
                order by l_partkey, l_shipdate) as r from lineitem)""")
def _(t):
    rows = t.lineitem.select(*LINE)
    return picking.mark_first(rows, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_shipdate"])


@query("cleared_errors", """
    select o_orderkey, o_custkey, o_orderdate from orders
    where not exists (select 1 from lineitem where l_orderkey = o_orderkey and cast(l_shipdate as date) = cast(o_orderdate as date))""")
def _(t):
    from tidewell.plans.claims import clear_errors

    def keyed(rows, claim, day):
        return rows.withColumns({
            "runyear": F.year(day), "pmd_client_id": F.lit(62), "claim_id": F.col(claim).cast("string"),
            "claim_line_num": F.lit(1), "admission_date": F.to_date(day)})
    cleared = clear_errors(keyed(t.orders, "o_orderkey", "o_orderdate"), keyed(t.lineitem, "l_orderkey", "l_shipdate"))
    return cleared.select("o_orderkey", "o_custkey", "o_orderdate")


@query("open_versions", """
    select o_custkey, count(*) as n from orders where nullif(o_orderstatus, 'O') is null group by 1""")
def _(t):
    rows = t.orders.withColumn("end_date", F.when(F.col("o_orderstatus") != "O", F.to_date("o_orderdate")))
    return changes.open_rows(rows).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


