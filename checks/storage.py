"""Writes, states, archives and arriving files, in the folder the cluster shares."""

from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from checks.registry import query
from checks.sums import CONFIG, watch_config
from tidewell.params import RunParams
from tidewell.plans.arrivals import file_arrival
from tidewell.plans.runs import archive_evaluation
from tidewell.session import shared_folder
from tidewell.sources import files, tables
from tidewell.streaming import arrivals as stream

C = F.col
P = RunParams(client_id=1, run_year=2001, as_of=datetime(2001, 9, 1, 8), run_id=3, env="QA")


def claims(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.year("l_shipdate").alias("runyear"))


@query("append_and_replace_partition", """
    select l_orderkey, l_linenumber, l_partkey, year(l_shipdate)::int as runyear from lineitem where year(l_shipdate) <> 1998
    union all select l_orderkey, l_linenumber, -1, 1998 from lineitem where year(l_shipdate) = 1998 and l_returnflag = 'R'
    union all select l_orderkey, l_linenumber, l_partkey, year(l_shipdate)::int from lineitem where l_returnflag = 'A'""")
def _(t):
    path = shared_folder(t.spark)
    tables.append(claims(t), path, ["runyear"])
    only = t.lineitem.where((F.year("l_shipdate") == 1998) & (C("l_returnflag") == "R"))
    tables.overwrite(only.select("l_orderkey", "l_linenumber", F.lit(-1).cast("bigint").alias("l_partkey"),
                                 F.lit(1998).alias("runyear")), path, ["runyear"])
    tables.append(claims_of(t, "A"), path, ["runyear"])
    return tables.read_table(t.spark, path).select("l_orderkey", "l_linenumber", "l_partkey", "runyear")


def claims_of(t, flag):
    return t.lineitem.where(C("l_returnflag") == flag).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.year("l_shipdate").alias("runyear"))


@query("replace_table", "select o_orderkey, o_orderstatus from orders where o_orderstatus = 'F'")
def _(t):
    path = shared_folder(t.spark)
    tables.overwrite(t.orders.select("o_orderkey", "o_orderstatus"), path)
    tables.overwrite(t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus"), path)
    return tables.read_table(t.spark, path)


@query("state_by_run", """
    select o_custkey, count(*) filter (o_orderstatus = 'F') as n, bool_or(o_orderstatus = 'F') as any_done from orders group by 1""")
def _(t):
    path = shared_folder(t.spark)
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    tables.save_state(counts, path, 1)
    final = t.orders.where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("done"))
    current = tables.load_state(t.spark, path)
    tables.save_state(current.join(final, "o_custkey", "left").select(
        "o_custkey", F.coalesce("done", F.lit(0)).cast("bigint").alias("n"), C("done").isNotNull().alias("any_done")), path, 2)
    return tables.load_state(t.spark, path)


@query("current_rolled_to_history", """
    select 'history' as place, case when o_orderstatus = 'F' then 1 else 2 end as run, o_orderkey, o_custkey, o_totalprice from orders
    union all select 'current', 3, -1, o_custkey, 1.0 from orders where o_totalprice > 400000""")
def _(t):
    """Rows of two runs rolled to the history, the second roll repeated; then a new current table."""
    root = shared_folder(t.spark)
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    tables.save_state(rows.where("o_orderstatus = 'F'"), f"{root}/current", 0)
    tables.roll_to_history(tables.load_state(t.spark, f"{root}/current", 0), f"{root}/history", f"{root}/current", 1)
    emptied = tables.load_state(t.spark, f"{root}/current")
    later = rows.where("o_orderstatus <> 'F'").unionByName(emptied)  # the roll has left nothing
    tables.save_state(later, f"{root}/next", 0)
    for _ in range(2):
        tables.roll_to_history(tables.load_state(t.spark, f"{root}/next", 0), f"{root}/history", f"{root}/next", 2)
    fresh = t.orders.where("o_totalprice > 400000").select(
        F.lit(-1).cast("bigint").alias("o_orderkey"), "o_custkey", F.lit(1.0).alias("o_totalprice"), F.lit("P").alias("o_orderstatus"))
    tables.save_state(tables.load_state(t.spark, f"{root}/next").unionByName(fresh), f"{root}/next", 3)
    columns = ("o_orderkey", "o_custkey", "o_totalprice")
    history = t.spark.read.parquet(f"{root}/history").select(F.lit("history").alias("place"), C("history_run").alias("run"), *columns)
    return history.unionByName(tables.load_state(t.spark, f"{root}/next").select(F.lit("current").alias("place"), F.lit(3).alias("run"), *columns))


@query("archived_snapshots", """
    with day as (select date '2001-09-01' as d),
    lines as (select l_orderkey as id, cast(l_shipdate as date) as served, year(l_shipdate)::int as y from lineitem)
    select 'claims' as place, d as stamped, 3 as run, id, served, y from lines, day
    union all select 'claims_current', d, null, id, served, y from lines, day
    union all select 'eligibility', null, 3, o_orderkey, cast(o_orderdate as date), null from orders
    union all select 'eligibility_current', null, null, o_orderkey, cast(o_orderdate as date), null from orders
    union all select distinct 'single', null::date, 3, o_custkey, null::date, null::int from orders
    union all select 'multiple', null, 3, c_custkey, null, c_nationkey from customer
    union all select 'insulin', null, 3, s_suppkey, null, s_nationkey from supplier
    union all select 'covered', d, 3, c_custkey, null, c_nationkey from customer, day""")
def _(t):
    root = shared_folder(t.spark)
    staged = t.lineitem.select("l_orderkey", C("l_shipdate").alias("date_of_service"), F.lit(1).alias("pmd_client_id"),
                               F.year("l_shipdate").alias("runyear"))
    for _ in range(2):  # a repeated run replaces its rows
        archive_evaluation(root, P, staged, t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day")), t.orders.select("o_custkey"),
                           t.customer.select("c_custkey", "c_nationkey"), t.customer.select("c_custkey", "c_nationkey"),
                           t.supplier.select("s_suppkey", "s_nationkey"))
    out = None
    for place, name, key, served, year, stamp in (
            ("claims", "adherence_claims", "l_orderkey", "date_of_service", "runyear", "evaluation_date"),
            ("claims_current", "adherence_claims_current", "l_orderkey", "date_of_service", "runyear", "evaluation_date"),
            ("eligibility", "eligibility", "o_orderkey", "day", None, None), ("eligibility_current", "eligibility_current", "o_orderkey", "day", None, None),
            ("single", "single_drug_review", "o_custkey", None, None, None), ("multiple", "multiple_drug_review", "c_custkey", None, "c_nationkey", None),
            ("insulin", "insulin_claims", "s_suppkey", None, "s_nationkey", None), ("covered", "days_covered", "c_custkey", None, "c_nationkey", "archive_date")):
        rows = t.spark.read.parquet(f"{root}/{name}")
        empty = F.lit(None)
        part = rows.select(
            F.lit(place).alias("place"), (C(stamp) if stamp else empty).cast("date").alias("stamped"),
            (C("history_run") if "history_run" in rows.columns else empty).cast("int").alias("run"), C(key).alias("id"),
            (C(served) if served else empty).cast("date").alias("served"), (C(year) if year else empty).cast("int").alias("y"))
        out = part if out is None else out.unionByName(part)
    return out


def write_feed(t, root):
    """Orders as text files with a header, one folder per status."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", C("o_orderstatus").alias("client"))
    rows.write.partitionBy("client").option("header", "true").csv(root)


PER_FOLDER = """
    select 'client=' || o_orderstatus as folder, count(*) as records from orders group by 1"""


@query("file_stats", PER_FOLDER)
def _(t):
    root = shared_folder(t.spark)
    write_feed(t, root)
    return files.file_stats(t.spark, root, "part-*.csv").groupBy("folder").agg(F.sum("record_count").alias("records"))


@query("file_sizes_agree", """
    select 'client=' || o_orderstatus as folder, true as sizes_agree from orders group by 1""")
def _(t):
    root = shared_folder(t.spark)
    write_feed(t, root)
    found = files.discover_files(t.spark, root, "part-*.csv").groupBy("folder").agg(F.sum("file_size").alias("bytes"))
    lines = t.spark.read.option("lineSep", "\n").text(root).groupBy(F.concat(F.lit("client="), "client").alias("folder")).agg(
        F.sum(F.octet_length("value") + 1).alias("line_bytes"))
    return found.join(lines, "folder").select("folder", (C("bytes") == C("line_bytes")).alias("sizes_agree"))


@query("streamed_file_stats", PER_FOLDER)
def _(t):
    root = shared_folder(t.spark)
    write_feed(t, f"{root}/in")
    for _ in range(2):  # the second run finds nothing new
        stream.stream_file_facts(t.spark, f"{root}/in", f"{root}/facts", f"{root}/seen", "part-*.csv").awaitTermination()
    return t.spark.read.parquet(f"{root}/facts").groupBy("folder").agg(F.sum("record_count").alias("records"))


def arrival(t):
    """Watched folders of two levels, and folders of the same last names below another parent."""
    root = shared_folder(t.spark)
    write_feed(t, f"{root}/in")
    write_feed(t, f"{root}/unwatched")
    statuses = t.orders.select("o_orderstatus").distinct()
    config = statuses.select(
        F.ascii("o_orderstatus").alias("pmd_client_id"), F.lit("claims").alias("filetype"), F.lit("part-*.c?v").alias("filename"),
        F.lit("none").alias("filelocation"), F.lit("none").alias("filelocationdev"),
        F.concat(F.lit("in/client="), "o_orderstatus").alias("filelocationqa"), F.lit(True).alias("active"),
        F.lit(True).alias("trigger_eval_engine"), F.lit(None).cast("timestamp_ntz").alias("lastdatereceived"),
        F.lit(0).alias("unprocessed_filecount"))
    control = t.orders.select(
        C("o_orderkey").alias("controlid"), F.ascii("o_orderstatus").alias("pmdclientid"), F.year("o_orderdate").alias("runyear"),
        F.lit(0).alias("process"), ((C("o_orderstatus") == "P") & (C("o_totalprice") > 400000)).alias("process_ind"),
        F.lit(None).cast("timestamp_ntz").alias("filewatcherqueuedate"))
    history = config.where("false").select("pmd_client_id", "filetype", "filename", "filelocation", "active",
                                           "lastdatereceived", "unprocessed_filecount")
    return root, config, control, history


def polled(t):
    return file_arrival(*arrival(t), P)


@query("arrival_files", """
    select ascii(o_orderstatus)::int as pmd_client_id, count(*) as records from orders where o_orderstatus <> 'P' group by 1""")
def _(t):
    return polled(t).files.groupBy("pmd_client_id").agg(F.sum("record_count").alias("records"))


@query("arrival_queue", """
    select o_orderkey as controlid, case when o_orderstatus <> 'P' and year(o_orderdate) = 2001 then 1 else 0 end as process,
           case when o_orderstatus <> 'P' and year(o_orderdate) = 2001 then timestamp '2001-09-01 08:00:00' end as filewatcherqueuedate
    from orders""")
def _(t):
    return polled(t).control.select("controlid", "process", "filewatcherqueuedate")


@query("arrival_history", """
    select distinct ascii(o_orderstatus)::int as pmd_client_id, 'in/client=' || o_orderstatus as filelocation,
           timestamp '2001-09-01 08:00:00' as lastdatereceived from orders where o_orderstatus <> 'P'""")
def _(t):
    return polled(t).history.select("pmd_client_id", "filelocation", "lastdatereceived")


def streamed(t, times):
    """The tables after polls of the stream: a second one finds the files again, a repeated one changes nothing."""
    root, config, control, history = arrival(t)
    target = shared_folder(t.spark)
    stream.start_tables(target, config, control, history)
    for when in times:
        stream.stream_arrivals(t.spark, root, target, f"{target}/seen", P, lambda _, when=when: when).awaitTermination()
    stream.poll_once(t.spark, root, target, len(times) - 1, replace(P, as_of=times[-1]))
    return target


@query("streamed_queue", """
    select o_orderkey as controlid, case when o_orderstatus <> 'P' and year(o_orderdate) = 2001 then 1 else 0 end as process,
           case when o_orderstatus <> 'P' and year(o_orderdate) = 2001 then timestamp '2001-09-01 08:00:00' end as filewatcherqueuedate
    from orders""")
def _(t):
    target = streamed(t, [P.as_of, datetime(2001, 9, 1, 20)])
    return stream.arrivals(t.spark, target, "control").select("controlid", "process", "filewatcherqueuedate")


@query("streamed_history", """
    select distinct ascii(o_orderstatus)::int as pmd_client_id, 'in/client=' || o_orderstatus as filelocation,
           unnest([timestamp '2001-09-01 20:00:00', timestamp '2001-09-02 06:00:00']) as lastdatereceived
    from orders where o_orderstatus <> 'P'""")
def _(t):
    # Two polls of a day share a row, which has the later time; the next day has a row of its own.
    target = streamed(t, [P.as_of, datetime(2001, 9, 1, 20), datetime(2001, 9, 2, 6)])
    return stream.arrivals(t.spark, target, "history").select("pmd_client_id", "filelocation", "lastdatereceived")


@query("watched_locations", f"""
    with {CONFIG} select pmd_client_id, filetype, case when active and trigger_eval_engine then 'dev/' || filelocation end as location
    from cfg""")
def _(t):
    from tidewell.sources.watch import location_column
    rows = watch_config(t)
    ready = C("active") & C("trigger_eval_engine")
    return rows.select("pmd_client_id", "filetype", F.when(ready, C(location_column("dev"))).alias("location"))

