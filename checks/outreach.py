"""Campaign list and call history, with events as calls."""

from datetime import datetime

from pyspark.sql import functions as F

from checks.registry import query
from tidewell.operators.totals import union_distinct
from tidewell.params import RunParams
from tidewell.plans import outreach
from tidewell.session import shared_folder
from tidewell.sources import tables

C = F.col
P = RunParams(client_id=0, run_year=2024, as_of=datetime(2024, 1, 31, 9), tz="America/Chicago")

# Roles: customer = patient, order = opportunity of the customer (measure = priority), event = call.
# An event belongs to the newest opportunities of its user: one per measure.
RESULTS = {"view": 11, "purchase": 8, "click": 18, "error": 15, "signup": 99}


def dtps(t):
    """The newest order of each customer and priority, as an opportunity of this year."""
    rows = t.orders.groupBy("o_custkey", "o_orderpriority").agg(
        F.max("o_orderkey").alias("id"), F.max_by("o_orderstatus", "o_orderkey").alias("status"))
    measure = F.left("o_orderpriority", F.lit(1)).cast("int")
    return rows.select(
        "id", C("o_custkey").alias("patient_id"), C("o_custkey").alias("pmd_patient_id"), measure.alias("measure_id"),
        F.lit(2024).alias("dtp_year"), F.when(C("status") == "P", 2).otherwise(1).alias("dtp_visibility_id"),
        F.when(C("status") == "O", 2).otherwise(1).alias("product_line_id"),
        F.concat(F.lit("npi"), "id").alias("npi"), F.concat(F.lit("ndc"), "id").alias("ndc"), C("status").alias("drug_name"))


DTPS = """
    dtp as (select max(o_orderkey) as id, o_custkey as pat, cast(left(o_orderpriority, 1) as int) as m,
                   o_orderpriority as mname, max_by(o_orderstatus, o_orderkey) as st from orders group by o_custkey, o_orderpriority)"""


def measures(t):
    """Priorities as measures."""
    rows = t.orders.select("o_orderpriority").distinct()
    return rows.select(F.left("o_orderpriority", F.lit(1)).cast("int").alias("id"), C("o_orderpriority").alias("key"),
                       F.when(C("o_orderpriority") == "2-HIGH", "HRM").otherwise(C("o_orderpriority")).alias("name"))


def visibilities(t):
    rows = t.orders.select(F.when(C("o_orderstatus") == "P", 2).otherwise(1).alias("id")).distinct()
    return rows.select("id", F.when(C("id") == 1, "2024 ACTIVE").otherwise("2024 Closed").alias("name"),
                       F.concat(F.lit("v"), "id").alias("key"))


def calls(t):
    result = F.create_map(*[F.lit(x) for pair in RESULTS.items() for x in pair])
    return t.events.select(
        C("event_id").alias("id"), (C("event_id") % 7).cast("int").alias("user_id"),
        F.when(C("event_type") == "signup", 2).otherwise(1).alias("call_type_id"),
        F.when(C("event_type") == "error", 2).otherwise(1).alias("status_id"),
        F.when(C("value") > 5, F.try_element_at(result, C("event_type"))).alias("status_detail_id"),
        F.lit(5).alias("dtp_cnsld_call_list_id"), F.lit("Patient").alias("entity_type"), C("user_id").alias("entity_id"),
        C("ts").alias("created_at"), (C("ts") + F.expr("interval 2 minutes")).alias("updated_at"),
        (C("ts") + F.expr("interval 3 minutes")).alias("stopped_at"))


CALLS = """
    call as (select event_id as id, user_id as pat, cast(event_id % 7 as int) as usr, case when event_type = 'signup' then 2 else 1 end as ty,
                    case when event_type = 'error' then 2 else 1 end as status, ts,
                    case when value > 5 then case event_type when 'view' then 11 when 'purchase' then 8 when 'click' then 18
                         when 'error' then 15 when 'signup' then 99 end end as detail, value, event_type from events)"""


def call_dtps(t):
    """A call is about the opportunity of its user whose measure is one more than the call's hour of day, cut to five."""
    about = F.least(F.hour(C("ts")) + 1, F.lit(5))
    rows = t.events.select(C("event_id").alias("call_id"), C("user_id").alias("pat"), about.alias("m"))
    own = dtps(t).select(C("id").alias("dtp_id"), C("pmd_patient_id").alias("pat"), C("measure_id").alias("m"))
    return rows.join(own, ["pat", "m"]).select("call_id", "dtp_id")


LINKS = """
    link as (select event_id as call_id, dtp.id as dtp_id from events join dtp on pat = user_id and m = least(hour(ts) + 1, 5))"""


@query("campaign_list", f"""
    with {DTPS}, {CALLS}, {LINKS},
    last as (select pat, m, detail, lang, tp from
               (select dtp.pat, m, detail, date_diff('day', cast(ts as date), date '2024-02-01')::int as tp, lang,
                       row_number() over (partition by dtp.pat, m order by ts desc, call.id desc) as r
                from call join link on call_id = call.id join dtp on dtp.id = dtp_id
                     left join (select c_custkey, case c_mktsegment when 'BUILDING' then 'Spanish' when 'MACHINERY' then 'standard'
                                       else 'Other' end as lang from customer) on c_custkey = call.pat) where r = 1),
    pcd as (select o_orderkey, o_custkey as pat, cast(left(o_orderpriority, 1) as int) as m, o_orderpriority, o_totalprice from orders),
    j as (select pcd.*, c_name, c_nationkey, c_mktsegment, tp, coalesce(lang, 'none') as flt,
                 right('0000000000' || c_custkey, 10) as phone
          from pcd join dtp on dtp.pat = pcd.pat and dtp.m = pcd.m and dtp.st <> 'P' join customer on c_custkey = pcd.pat
               left join last on last.pat = pcd.pat and last.m = pcd.m
          where c_acctbal >= 0 and (detail is null or detail = 11 and tp >= 1 or detail = 8 and tp >= 3 or detail = 18 and tp >= 7
                or detail = 15 and tp >= 10))
    select pat as pmd_patient_id, c_name as patient_name, phone as phone_number, c_nationkey as pmd_client_id, flt as filter,
           max(o_orderpriority) as measureadh_status, min(m) as stockinhand, sum(m * case when pat % 3 = 0 then 2 else 1 end)::bigint as adh_calllist_order,
           count(distinct o_orderpriority) as measure_count, min(o_orderkey) as dtp_touched_count, min(tp) as time_priority,
           date '2024-02-01' as campaign_date
    from j group by 1, 2, 3, 4, 5""")
def _(t):
    number = F.left("o_orderpriority", F.lit(1)).cast("int")
    fixed = {c: F.lit("x") for c in ("client_name", "zip_code", "lowbound_ts", "highbound_ts", "state_code", "time_zone",
                                     "phone_type", "planidentifier_pclm")}
    detail = t.orders.join(t.customer, C("c_custkey") == C("o_custkey")).select(
        C("o_custkey").alias("pmd_patient_id"), C("c_name").alias("patient_name"), F.lit(1).alias("patient_count"),
        F.lit("0").alias("phone_number"), C("c_nationkey").alias("pmd_client_id"),
        *[v.alias(n) for n, v in fixed.items()], F.lit("none").alias("filter"),
        F.lower("o_orderpriority").alias("measureuse"), C("o_orderpriority").alias("measureadh_status"),
        number.alias("stockinhand"), number.alias("adh_calllist_order"), C("o_orderkey").alias("dtp_touched_count"))
    patients = t.customer.select(C("c_custkey").alias("id"), C("c_custkey").alias("pmd_patient_id"))
    best = F.lpad(C("c_custkey").cast("string"), 10, "0")
    phones = t.customer.select(
        C("c_custkey").alias("entity_id"), F.lit("patient").alias("entity_type"), F.lit("PHONE").alias("phone_type"),
        F.explode(F.array(best, F.concat(F.lit("9"), best))).alias("number"), (C("c_acctbal") >= 0).alias("primary"))
    languages = t.customer.select(
        F.lit("PATIENT").alias("entity_type"), C("c_custkey").alias("entity_id"), F.lit(True).alias("primary"),
        F.when(C("c_mktsegment") == "BUILDING", 54).when(C("c_mktsegment") != "MACHINERY", 3).alias("language_id"))
    # Some members have a second opportunity of each measure, never called about.
    second = dtps(t).where("pmd_patient_id % 3 = 0").withColumn("id", -C("id"))
    rows = outreach.campaign_list(detail, measures(t), dtps(t).unionByName(second), visibilities(t), patients, phones, calls(t), call_dtps(t),
                                  languages, P)
    return rows.select("pmd_patient_id", "patient_name", "phone_number", "pmd_client_id", "filter", "measureadh_status",
                       "stockinhand", "adh_calllist_order", "measure_count", "dtp_touched_count", "time_priority", "campaign_date")


def names(rows, key, **columns):
    """Distinct keys of a table as a small name table."""
    ids = rows.select(C(key).alias("id")).where("id is not null").distinct()
    return ids.select("id", *[F.concat(F.lit(prefix), C("id").cast("string")).alias(n) for n, prefix in columns.items()])


def history_tables(t):
    all_calls = calls(t)
    linked = call_dtps(t)
    # Two details for cheap purchases, a deleted one for views, none for the others; signups are inbound.
    noted = t.events.join(linked, C("event_id") == C("call_id"))
    copies = F.when(C("event_type") == "purchase", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    noted = noted.where(C("event_type").isin("purchase", "view", "signup")).withColumn("copy", F.explode(copies))
    details = noted.select(
        (C("event_id") * 10 + C("copy")).alias("id"), "dtp_id",
        F.when(C("event_type") != "signup", C("call_id")).alias("call_id"), (C("event_id") % 7).cast("int").alias("user_id"),
        C("copy").alias("category_id"), (C("copy") + 2).alias("sub_category_id"), C("event_type").alias("note"),
        C("ts").alias("created_at"), (C("ts") + F.expr("interval 1 minute")).alias("updated_at"),
        F.when(C("event_type") == "view", C("ts")).alias("deleted_at"))
    claims = t.lineitem.join(t.orders, C("l_orderkey") == C("o_orderkey"))
    claim_id = C("l_orderkey") * 10 + C("l_linenumber")
    newest = dtps(t).select(C("id").alias("dtp_id"))
    dtp_claims = t.lineitem.select(C("l_orderkey").alias("dtp_id"), claim_id.alias("pharmacy_claim_id")).distinct().join(
        newest, "dtp_id", "left_semi")
    pharmacy = claims.groupBy(claim_id.alias("id")).agg(
        F.max("l_suppkey").alias("provider_npi"), F.max("l_partkey").cast("string").alias("ndc"),
        F.max("l_returnflag").alias("drug_name"), F.max("l_linestatus").alias("prescription_service_num"),
        F.max("l_shipdate").alias("date_of_service"), F.max("l_quantity").alias("quantity_dispensed"),
        F.max("l_linenumber").alias("days_supply"))
    people = t.customer.select(C("c_custkey").alias("id"), C("c_nationkey").alias("pmd_client_id"),
                               C("c_custkey").alias("pmd_patient_id"), C("c_name").alias("member_id"),
                               C("c_mktsegment").alias("plan_group"))
    users = names(all_calls, "user_id", last_name="L").withColumn(
        "first_name", F.when(C("id") != 3, F.concat(F.lit("F"), C("id").cast("string"))))
    return outreach.OutreachTables(
        calls=all_calls, call_dtps=linked, call_types=names(all_calls, "call_type_id", name="type"), dtps=dtps(t),
        dtp_details=details, measures=measures(t), visibilities=visibilities(t), users=users, patients=people,
        categories=names(details, "category_id", name="cat"), sub_categories=names(details, "sub_category_id", name="sub"),
        statuses=names(all_calls, "status_id", name="status"),
        status_details=names(all_calls, "status_detail_id", description="detail"),
        dtp_claims=dtp_claims, pharmacy_claims=pharmacy)


HISTORY = f"""
    {DTPS}, {CALLS}, {LINKS},
    det as (select event_id * 10 + copy as id, dtp_id, case when event_type <> 'signup' then event_id end as call_id,
                   cast(event_id % 7 as int) as usr, copy, event_type, ts, case when event_type = 'view' then ts end as deleted
            from events join link on call_id = event_id
                 cross join (select unnest([1, 2]) as copy) where event_type in ('purchase', 'view', 'signup')
                 and (copy = 1 or event_type = 'purchase')),
    live as (select * from det where deleted is null),
    ev as (select call.id as call_id, live.id as detail_id, link.dtp_id, 5 as list, call.usr, ts + interval 2 minute as noted, ts as s,
                  ts + interval 3 minute as e, status, case when status = 2 and detail is null then 0 else detail end as sd,
                  copy as cat, copy + 2 as sub, live.event_type as note, 'status' || status as sname, 'detail' || detail as sdname,
                  'cat' || copy as cname, 'sub' || (copy + 2) as subname, ty, 'type' || ty as tyname
           from call join link on link.call_id = call.id join (select id, call_id as cid, dtp_id as did, copy, event_type from live) live
                on cid = call.id and did = link.dtp_id
           union
           select call.id, 0, link.dtp_id, 5, call.usr, ts + interval 2 minute, ts, ts + interval 3 minute, status,
                  case when status = 2 and detail is null then 0 else detail end, 0, 0, '', 'status' || status, 'detail' || detail,
                  '', '', ty, 'type' || ty
           from call join link on link.call_id = call.id
           where not exists (select 1 from live where live.call_id = call.id)
           union
           select 0, id, dtp_id, 0, usr, ts + interval 1 minute, ts, ts + interval 1 minute, 0, 0, copy, copy + 2, event_type,
                  'Inbound Call', 'Inbound Call', 'cat' || copy, 'sub' || (copy + 2), null, null
           from live where call_id is null),
    lc as (select l_orderkey as k, max(l_orderkey * 10 + l_linenumber) as cid from lineitem group by 1),
    pc as (select l_orderkey * 10 + l_linenumber as cid, max(l_suppkey) as npi, cast(max(l_partkey) as varchar) as ndc,
                  max(l_returnflag) as drug, max(l_linestatus) as psn, max(l_shipdate) as dos, max(l_quantity) as qty,
                  max(l_linenumber) as days from lineitem group by 1),
    hist as (select call_id, detail_id as dtpdetail_id, dtp.id as dtp_id, list as dtp_cnsld_call_list_id, c_nationkey as pmd_client_id,
           dtp.pat as pmd_patient_id, c_name as member_id, c_mktsegment as planidentifier_pclm,
           case when m = 2 then 'npi' || dtp.id else cast(pc.npi as varchar) end as npi, case when m = 2 then 'HRM' else mname end as measureuse,
           cast(noted - interval 6 hour as date) as measurenotedate, s - interval 6 hour as call_start_at, e - interval 6 hour as call_end_at,
           status as call_status_id, sd as call_status_detail_id, cat as category_id, sub as sub_category_id,
           case when m = 2 then 'ndc' || dtp.id else pc.ndc end as ndc, case when m = 2 then st else drug end as drug_name,
           note as freetextnotes, usr as caller_id, sname as call_status, sdname as call_status_details, cname as category,
           subname as subcategory, 'L' || usr || ' ' || case when usr = 3 then '' else 'F' || usr end as caller_name,
           noted as lastupdate_utc, psn as prescription_service_num, dos as date_of_service, qty as quantity_dispensed,
           days as days_supply, 2024 as dtp_year, case when st = 'P' then 2 else 1 end as dtp_visibility_id,
           'v' || case when st = 'P' then 2 else 1 end as dtp_visibilities_key, ty as call_type_id, tyname as call_type_name
    from ev join dtp on dtp.id = ev.dtp_id join customer on c_custkey = dtp.pat
         left join lc on lc.k = dtp.id left join pc on pc.cid = lc.cid where st <> 'O')"""


@query("call_history_union", f"with {HISTORY} select * from hist")
def _(t):
    return outreach.call_history(history_tables(t), P)


@query("call_history_increment", f"""
    with {HISTORY}
    select call_id, dtp_id, dtpdetail_id, pmd_patient_id, call_status, member_id as pbp_pclm, caller_name from hist
    where pmd_client_id < 20 and not (call_start_at < timestamp '2024-01-15')""")
def _(t):
    path = shared_folder(t.spark)
    tables.overwrite(outreach.call_history(history_tables(t), P), path)  # the staging table of the day
    staged = tables.read_table(t.spark, path)
    loaded = staged.where("call_start_at < timestamp_ntz '2024-01-15'")
    detail = t.customer.select(
        C("c_custkey").alias("patient_unique_ident"), C("c_name").alias("pbp_pclm"), C("c_mktsegment").alias("accountid_pclm"),
        F.when(C("c_nationkey") >= 20, F.lit("2020-01-01").cast("timestamp_ntz")).alias("end_date"))
    rows = outreach.append_history(loaded, staged, detail, P)
    return rows.select("call_id", "dtp_id", "dtpdetail_id", "pmd_patient_id", "call_status", "pbp_pclm", "caller_name")


@query("retry_due", """
    select event_id, event_type, date_diff('day', cast(ts as date), date '2024-02-01')::int as days,
           case event_type when 'view' then date_diff('day', cast(ts as date), date '2024-02-01') >= 1
                when 'purchase' then date_diff('day', cast(ts as date), date '2024-02-01') >= 3
                when 'click' then date_diff('day', cast(ts as date), date '2024-02-01') >= 7
                when 'error' then date_diff('day', cast(ts as date), date '2024-02-01') >= 10 else true end as due
    from events""")
def _(t):
    result = F.create_map(*[F.lit(x) for pair in RESULTS.items() for x in pair])
    status = F.when(C("event_type") != "signup", F.try_element_at(result, C("event_type")))
    days = F.datediff(F.lit(P.tomorrow), C("ts"))
    return t.events.select("event_id", "event_type", days.alias("days"), outreach.retry_due(status, days).alias("due"))


@query("events_in_three_branches", """
    select event_id, 'call' as kind from events where event_type = 'click'
    union select event_id, 'call' from events where event_type in ('click', 'view') and value > 5
    union select event_id, 'inbound' from events where event_type = 'signup'""")
def _(t):
    kind = F.lit("call").alias("kind")
    return union_distinct(
        t.events.where("event_type = 'click'").select("event_id", kind),
        t.events.where("event_type in ('click', 'view') and value > 5").select("event_id", kind),
        t.events.where("event_type = 'signup'").select("event_id", F.lit("inbound").alias("kind")))
