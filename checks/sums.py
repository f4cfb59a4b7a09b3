"""Aggregations, set operations, scalar lookups and reports."""

from pyspark.sql import functions as F

from checks.registry import query
from tidewell.operators import picking, totals
from tidewell.plans.outreach import campaign_rollup
from tidewell.plans.runs import NOTHING_QUEUED, queue_pick
from tidewell.sources.watch import active_watch_config, html_report


@query("grouped_measures", """
    select l_suppkey, max(l_returnflag) as measureadh_status, min(l_quantity) as stockinhand,
           sum(l_linenumber * (1 + l_orderkey % 3))::bigint as adh_calllist_order, count(distinct l_linestatus) as measure_count,
           min(l_partkey) as dtp_touched_count, min(l_tax) as time_priority
    from lineitem group by 1""")
def _(t):
    rows = t.lineitem.select(
        "l_suppkey", F.col("l_returnflag").alias("measureadh_status"), F.col("l_quantity").alias("stockinhand"),
        F.col("l_linenumber").alias("adh_calllist_order"), (1 + F.col("l_orderkey") % 3).alias("n_open"),
        F.col("l_linestatus").alias("measureuse"), F.col("l_partkey").alias("dtp_touched_count"), F.col("l_tax").alias("time_priority"))
    return campaign_rollup(rows, ["l_suppkey"])


@query("collapse_duplicates", """
    select l_orderkey, l_partkey, max(l_suppkey) as l_suppkey, max(l_returnflag) as l_returnflag
    from lineitem group by 1, 2""")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")
    return totals.collapse(rows, ["l_suppkey", "l_returnflag"])


@query("extreme_per_key", "select l_orderkey, max(l_shipdate) as last_service from lineitem group by 1")
def _(t):
    return picking.extreme_per_key(t.lineitem, ["l_orderkey"], "l_shipdate", "max", "last_service")


@query("count_of_counts", """
    select l_suppkey, l_returnflag, count(distinct l_partkey) as n_drugs from lineitem
    group by 1, 2 having count(distinct l_partkey) > 1""")
def _(t):
    return totals.count_of_counts(t.lineitem, ["l_suppkey", "l_returnflag"], "l_partkey", "n_drugs").where("n_drugs > 1")


@query("regrouped_extreme", """
    with a as (select o_custkey, cast(o_orderdate as date) as s, max(o_totalprice) as price from orders group by 1, 2)
    select o_custkey, year(s)::int as y, max(price) as price from a group by 1, 2""")
def _(t):
    rows = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("s"), F.col("o_totalprice").alias("price"))
    return totals.regroup(rows, ["o_custkey", "s"], {"o_custkey": F.col("o_custkey"), "y": F.year("s")}, "price")


@query("global_counts", "select count(*) as n from lineitem where l_returnflag = 'R'")
def _(t):
    return totals.row_count(t.lineitem.where("l_returnflag = 'R'"))


@query("max_or_default", """
    select max(o_orderkey) as newest, (select coalesce(max(o_orderkey), 0) from orders where o_totalprice < 0) as none_found
    from orders""")
def _(t):
    none = totals.max_or(t.orders.where("o_totalprice < 0"), "o_orderkey", 0, "none_found")
    return t.orders.agg(F.max("o_orderkey").alias("newest")).withColumn("none_found", none.scalar())


@query("scalar_lookup", """
    select l_orderkey, l_linenumber, l_partkey from lineitem
    where cast(l_shipdate as date) = (select max(cast(l_shipdate as date)) from lineitem)""")
def _(t):
    newest = totals.scalar(t.lineitem, F.max(F.to_date("l_shipdate")))
    return t.lineitem.where(F.to_date("l_shipdate") == newest).select("l_orderkey", "l_linenumber", "l_partkey")


@query("union_distinct", """
    select l_orderkey as k, l_suppkey as s from lineitem where l_returnflag = 'R'
    union select l_orderkey, l_suppkey from lineitem where l_linestatus = 'O'
    union select o_orderkey, 0 from orders""")
def _(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_suppkey").alias("s"), "l_returnflag", "l_linestatus")
    return totals.union_distinct(
        lines.where("l_returnflag = 'R'").select("k", "s"), lines.where("l_linestatus = 'O'").select("k", "s"),
        t.orders.select(F.col("o_orderkey").alias("k"), F.lit(0).cast("bigint").alias("s")))


def control(t, process):
    return t.orders.select(
        F.col("o_orderkey").alias("controlid"), F.col("o_custkey").alias("pmdclientid"),
        F.col("o_orderpriority").alias("client"), F.nullif("o_orderstatus", F.lit("P")).alias("planidentifier_pclm"),
        F.year("o_orderdate").alias("runyear"), process.alias("process"),
        F.col("o_orderdate").alias("filewatcherqueuedate"))


@query("queue_pick", """
    select coalesce(nullif(o_orderstatus, 'P'), '') as planidentifier_pclm, cast(o_custkey as varchar) as pmd_client_id,
           o_orderpriority as clientname, year(o_orderdate)::int as runyear, 1 as evaluations, o_orderkey as controlid
    from orders where o_totalprice > 250000 order by o_orderdate, o_orderkey limit 1""")
def _(t):
    return queue_pick(control(t, F.when(F.col("o_totalprice") > 250000, 1).otherwise(0)))


@query("queue_pick_nothing", """
    select '0' as planidentifier_pclm, '0' as pmd_client_id, '0' as clientname, 1900 as runyear, 0 as evaluations,
           -99 as controlid
    where not exists (select 1 from orders where o_totalprice < 0)""")
def _(t):
    assert NOTHING_QUEUED["controlid"] == -99
    return queue_pick(control(t, F.when(F.col("o_totalprice") < 0, 1).otherwise(0)))


# Orders as waiting files: one entry per priority (client) and status (file type).
def watch_config(t):
    rows = t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(
        F.count(F.lit(1)).cast("int").alias("unprocessed_filecount"), F.max("o_orderdate").alias("lastdatereceived"))
    folder = F.concat(F.lit("in/"), F.col("o_orderpriority"))
    return rows.select(
        F.left("o_orderpriority", F.lit(1)).cast("int").alias("pmd_client_id"), F.col("o_orderstatus").alias("filetype"),
        F.concat("o_orderstatus", F.lit("*.txt")).alias("filename"), folder.alias("filelocation"),
        F.concat(F.lit("dev/"), folder).alias("filelocationdev"), F.concat(F.lit("qa/"), folder).alias("filelocationqa"),
        (F.col("o_orderstatus") != "P").alias("active"), (F.col("o_orderpriority") != "5-LOW").alias("trigger_eval_engine"),
        "lastdatereceived", "unprocessed_filecount")


CONFIG = """
    cfg as (select cast(left(o_orderpriority, 1) as int) as pmd_client_id, o_orderstatus as filetype,
                   o_orderstatus || '*.txt' as filename, 'in/' || o_orderpriority as filelocation,
                   o_orderstatus <> 'P' as active, o_orderpriority <> '5-LOW' as trigger_eval_engine,
                   max(o_orderdate) as lastdatereceived, count(*)::int as unprocessed_filecount
            from orders group by o_orderpriority, o_orderstatus)"""


@query("active_watch_config", f"""
    with {CONFIG}
    select pmd_client_id, filetype, filename, 'qa/' || filelocation as filelocation
    from cfg where active and trigger_eval_engine order by pmd_client_id""")
def _(t):
    return active_watch_config(watch_config(t), "qa").orderBy("pmd_client_id")


@query("watch_report", f"""
    with {CONFIG}
    select '<html><body><h3>File Watcher notification</h3><table border=1><tr><th>PMD Client ID</th><th>File Type</th>'
        || '<th>File Pattern</th><th>File Location</th><th>Last Date Received</th><th>Unprocessed Filecount</th></tr>'
        || string_agg('<tr><td>' || pmd_client_id || '</td><td>' || filetype || '</td><td>' || filename || '</td><td>'
            || filelocation || '</td><td>' || lastdatereceived || '</td><td>' || unprocessed_filecount || '</td></tr>',
            '' order by pmd_client_id, filetype, filename)
        || '</table></body></html>' as report
    from cfg where active and unprocessed_filecount > 0""")
def _(t):
    return html_report(watch_config(t))
