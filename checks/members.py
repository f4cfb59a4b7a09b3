"""Members: periods, activation, flags, detail history, exceptions, do-not-call."""

from datetime import date, datetime

from pyspark.sql import functions as F

from checks.mutations import BAD_PHONE, DETAIL, detail
from checks.registry import query
from tidewell.functions import text
from tidewell.params import RunParams
from tidewell.plans import eligibility, members as plans, runs
from tidewell.plans.feeds import MEMBERSHIP_FEEDS
from tidewell.session import shared_folder
from tidewell.sources.tables import load_by_key, load_state, save_by_key, save_state

C = F.col


def run(client, year=1998):
    return RunParams(client_id=client, run_year=year, as_of=datetime(year, 7, 1), run_id=31)


def customers(t, client):
    """Customers as members; those of one market segment belong to another client."""
    return t.customer.select(
        C("c_custkey").alias("patient_unique_ident"), C("c_custkey").cast("string").alias("patient_id"),
        F.when(C("c_mktsegment") == "BUILDING", 99).otherwise(client).alias("pmd_client_id"),
        F.date_add(F.lit(date(1935, 1, 1)), F.floor("c_acctbal").cast("int") * 3).alias("dob"),
        (C("c_nationkey") < 10).alias("active"),
        F.when(C("c_nationkey") < 20, 1992 + F.floor(C("c_nationkey") / 3)).cast("int").alias("eligibilityyear"),
        F.lit(False).alias("is_deleted"))


CUSTOMERS = """
    mem as (select c_custkey as ident, case when c_mktsegment = 'BUILDING' then 99 else {client} end as client,
                   date '1935-01-01' + cast(floor(c_acctbal) as int) * 3 as dob, c_nationkey < 10 as active,
                   case when c_nationkey < 20 then cast(1992 + floor(c_nationkey / 3.0) as int) end as elig from customer)"""


def periods(t, client, length=90):
    """Orders as periods of a fixed length."""
    day = F.to_date("o_orderdate")
    return t.orders.select(C("o_custkey").alias("patient_unique_ident"), F.lit(client).alias("pmd_client_id"),
                           C("o_orderpriority").alias("planidentifier_pclm"), day.alias("eligibilitystartdate"),
                           F.date_add(day, length).alias("eligibilityenddate"), F.year("o_orderdate").alias("runyear"))


PERIODS = """
    per as (select o_custkey as ident, o_orderpriority as plan, cast(o_orderdate as date) as s,
                   cast(o_orderdate as date) + {length} as e, year(o_orderdate)::int as y from orders)"""


# ---- periods from member files ------------------------------------------------------

CLAMPED = """
    select distinct {client} as pmd_client_id, ident as patient_unique_ident, plan as planidentifier_pclm, pbp as pbp_pclm,
           case when year(s) < 1998 and year(least(e, date '1998-12-31')) = 1998 then date '1998-01-01' else s end as eligibilitystartdate,
           least(e, date '1998-12-31') as eligibilityenddate, 1998 as runyear from g"""


# Codes that differ in the middle only: they share what is left of them in the target.
FULL_CODE = "o_orderstatus || '-' || left(o_orderpriority, 3) || (o_orderkey % 3) || o_orderpriority"


def member_file(t, stamps=False, **names):
    """Orders as lines of a member file, with unreadable dates among them, or (``stamps``) with timestamps."""
    start, end = F.to_date("o_orderdate"), F.date_add(F.to_date("o_orderdate"), F.floor(C("o_totalprice") / 500).cast("int"))
    columns = {
        "member": C("o_custkey").cast("string"),
        "start": F.when(C("o_orderpriority") == "5-LOW", None if stamps else "unknown").otherwise(
            start.cast("timestamp_ntz" if stamps else "string")),
        "end": F.when(C("o_orderpriority") == "1-URGENT", None if stamps else "open").otherwise(
            end.cast("timestamp_ntz" if stamps else "string")),
        "account": F.when(C("o_orderstatus") == "P", "").otherwise(C("o_orderpriority")),
        "plan": F.expr(FULL_CODE)}
    return t.orders.select(*[columns[kind].alias(name) for kind, name in names.items()], F.lit(1998).alias("runyear"))


FILE = f"""
    raw as (select o_custkey as ident, o_orderstatus, o_orderpriority, o_orderstatus || '-' || o_orderpriority as plancode,
                   {FULL_CODE} as fullcode,
                   case when o_orderpriority = '5-LOW' then date '1900-01-01' else cast(o_orderdate as date) end as s,
                   case when o_orderpriority = '1-URGENT' then date '1998-12-31'
                        else cast(o_orderdate as date) + cast(floor(o_totalprice / 500) as int) end as e
            from orders join customer on c_custkey = o_custkey where c_mktsegment <> 'BUILDING')"""


@query("eligibility_periods_52", f"""
    with {FILE},
    g as (select ident, 'H0251' as plan, o_orderpriority as pbp, s, max(e) as e from raw where o_orderstatus <> 'P' group by all)
    {CLAMPED.format(client=52)}""")
def _(t):
    raw = member_file(t, stamps=True, member="unique_patient_id", start="mbr_plan_eff_dt", end="dsenrl_dt", account="account_code")
    return eligibility.eligibility_periods(raw, customers(t, 52), MEMBERSHIP_FEEDS[52], run(52))


@query("eligibility_periods_62", f"""
    with {FILE},
    g as (select ident, left(fullcode, 5) as plan, right(fullcode, 3) as pbp, s, max(e) as e from raw group by ident, fullcode, s)
    {CLAMPED.format(client=62)}""")
def _(t):
    raw = member_file(t, member="patientid", start="patient_effdate", end="prgm_term_date", plan="plan_code")
    return eligibility.eligibility_periods(raw, customers(t, 62), MEMBERSHIP_FEEDS[62], run(62))


@query("eligibility_periods_69", f"""
    with {FILE},
    g as (select ident, left(fullcode, 5) as plan, o_orderpriority as pbp, s, max(e) as e from raw
          where o_orderstatus <> 'P' group by ident, fullcode, o_orderpriority, s)
    {CLAMPED.format(client=69)}""")
def _(t):
    raw = member_file(t, member="patient_id", start="patient_effective_date", end="patient_term_date",
                      account="account_code", plan="group_code")
    return eligibility.eligibility_periods(raw, customers(t, 69), MEMBERSHIP_FEEDS[69], run(69))


@query("guardian_periods", f"""
    with {FILE.replace("select o_custkey as ident", "select o_custkey as ident, year(o_orderdate) as v, o_totalprice")},
    newest as (select ident as i, max(v) as mv from raw group by 1),
    g as (select plancode, ident, o_orderstatus as f, o_orderpriority as l, left(plancode, 3) as phone, s, max(e) as e
          from raw join newest on i = ident and v = mv where o_orderstatus <> 'O' group by all),
    h as (select plancode as planidentifier_pclm, ident as patient_unique_ident, md5(concat(f, l)) as guardian_id,
                 f as guardian_firstname, l as guardian_lastname, phone,
                 case when year(s) < 1998 and year(least(e, date '1998-12-31')) = 1998 then date '1998-01-01' else s end as eligibilitystartdate,
                 least(e, date '1998-12-31') as e from g)
    select planidentifier_pclm, patient_unique_ident, guardian_id, guardian_firstname, guardian_lastname, eligibilitystartdate,
           max(phone) as guardian_phone, max(e) as eligibilityenddate, 67 as pmd_client_id, 1998 as runyear
    from h group by 1, 2, 3, 4, 5, 6""")
def _(t):
    code = F.concat(C("o_orderstatus"), F.lit("-"), C("o_orderpriority"))
    end = F.date_add(F.to_date("o_orderdate"), F.floor(C("o_totalprice") / 500).cast("int"))
    raw = t.orders.select(
        C("o_custkey").cast("string").alias("patient_id"), code.alias("group_code"),
        F.when(C("o_orderstatus") != "O", C("o_orderstatus")).otherwise("").alias("cardholder_fname"),
        C("o_orderpriority").alias("cardholder_lname"), F.left(code, F.lit(3)).alias("patient_phone_1"),
        F.when(C("o_orderpriority") == "5-LOW", "unknown").otherwise(F.to_date("o_orderdate").cast("string")).alias("patient_effective_date"),
        F.when(C("o_orderpriority") == "1-URGENT", "open").otherwise(end.cast("string")).alias("patient_term_date"),
        F.year("o_orderdate").alias("update_datetime"), F.lit(1998).alias("runyear"))
    return eligibility.guardian_periods(raw, customers(t, 67), run(67))


@query("guardian_merge", """
    with old as (select o_custkey as k, o_orderpriority as plan, o_orderstatus as g, cast(o_orderdate as date) as s,
                        max(cast(o_orderdate as date) + 30) as e from orders where year(o_orderdate) <= 1998 group by all),
         new as (select o_custkey as k, o_orderpriority as plan, o_orderstatus as g, cast(o_orderdate as date) as s,
                        max(cast(o_orderdate as date) + 60) as e from orders where year(o_orderdate) >= 1998 group by all)
    select coalesce(old.k, new.k) as patient_unique_ident, coalesce(old.plan, new.plan) as planidentifier_pclm,
           coalesce(old.g, new.g) as guardian_id, coalesce(old.s, new.s) as eligibilitystartdate,
           coalesce(new.e, old.e) as eligibilityenddate, case when new.k is not null then 'new' else 'old' end as guardian_phone
    from old full join new on old.k = new.k and old.plan = new.plan and old.g = new.g and old.s = new.s""")
def _(t):
    def rows(source, days, phone):
        day = F.to_date("o_orderdate")
        return source.select(C("o_custkey").alias("patient_unique_ident"), C("o_orderpriority").alias("planidentifier_pclm"),
                             C("o_orderstatus").alias("guardian_id"), day.alias("eligibilitystartdate"),
                             F.date_add(day, days).alias("eligibilityenddate"), F.lit(phone).alias("guardian_phone")).distinct()
    return eligibility.merge_guardians(rows(t.orders.where(F.year("o_orderdate") <= 1998), 30, "old"),
                                       rows(t.orders.where(F.year("o_orderdate") >= 1998), 60, "new"))


@query("exception_upsert", """
    with n as (select o_orderstatus as ty, o_custkey as k, o_orderpriority as p, date_trunc('year', o_orderdate)::date as s,
                      cast(o_orderdate as date) as e from orders where year(o_orderdate) >= 1997),
         m as (select k, p, s, max(e) as e from n group by all),
         src as (select distinct n.* from n join m on n.k = m.k and n.p = m.p and n.s = m.s and n.e = m.e),
         old as (select o_orderstatus as ty, o_custkey as k, o_orderpriority as p, date_trunc('year', o_orderdate)::date as s,
                        min(cast(o_orderdate as date)) as e from orders where year(o_orderdate) <= 1998 group by all)
    select coalesce(old.ty, src.ty) as excepttype, 1 as pmd_client_id, coalesce(old.k, src.k) as patient_unique_ident,
           coalesce(old.p, src.p) as planidentifier_pclm, coalesce(old.s, src.s) as exceptionstartdate,
           coalesce(src.e, old.e) as exceptionenddate,
           case when old.k is null then timestamp '1998-07-01' else timestamp '1990-01-01' end as updatedate
    from old full join src on old.ty = src.ty and old.k = src.k and old.p = src.p and old.s = src.s""")
def _(t):
    def rows(source):
        return source.select(
            C("o_orderstatus").alias("excepttype"), F.lit(1).alias("pmd_client_id"), C("o_custkey").alias("patient_unique_ident"),
            C("o_orderpriority").alias("planidentifier_pclm"), F.trunc("o_orderdate", "year").alias("exceptionstartdate"),
            F.to_date("o_orderdate").alias("exceptionenddate"))
    old = rows(t.orders.where(F.year("o_orderdate") <= 1998))
    old = old.groupBy(*[c for c in old.columns if c != "exceptionenddate"]).agg(F.min("exceptionenddate").alias("exceptionenddate"))
    old = old.withColumn("updatedate", F.lit("1990-01-01").cast("timestamp_ntz"))
    return eligibility.merge_exceptions(old, rows(t.orders.where(F.year("o_orderdate") >= 1997)), run(1))


# ---- activation ---------------------------------------------------------------------

@query("active_members", f"""
    with {CUSTOMERS.format(client=52)}, {PERIODS.format(length=120)},
    st as (select ident, bool_or(s <= date '1998-07-01' and e >= date '1998-07-01' and year(e) = 1998) as covered,
                  bool_or(year(e) = 1998) as ends from per where y = 1998 group by 1)
    select mem.ident as patient_unique_ident, client as pmd_client_id,
           case when client = 52 then coalesce(covered, false) else active end as active,
           case when client = 52 and coalesce(ends, false) then 1998 else elig end as eligibilityyear
    from mem left join st on st.ident = mem.ident""")
def _(t):
    return eligibility.recompute_active(customers(t, 52), periods(t, 52, 120), run(52)).select(
        "patient_unique_ident", "pmd_client_id", "active", "eligibilityyear")


@query("members_active_on", f"""
    with {PERIODS.format(length=90)}
    select c_custkey as patient_unique_ident from customer
    where c_custkey in (select ident from per where date '1998-07-01' between s and e)""")
def _(t):
    return eligibility.active_on(customers(t, 52), periods(t, 52), date(1998, 7, 1)).select("patient_unique_ident")


@query("soft_deleted_members", f"""
    with {CUSTOMERS.format(client=52)}
    select ident as patient_unique_ident, client as pmd_client_id,
           case when client = 52 then elig is null or elig < 1997 else false end as is_deleted from mem""")
def _(t):
    members = customers(t, 52)
    state, _ = eligibility.soft_delete(members, members, run(52))
    return state.select("patient_unique_ident", "pmd_client_id", "is_deleted")


@query("soft_deleted_detail", f"""
    with {CUSTOMERS.format(client=52)}
    select o_orderkey, o_custkey as patient_unique_ident, client = 52 and (elig is null or elig < 1997) as is_deleted
    from orders join mem on ident = o_custkey""")
def _(t):
    rows = t.orders.select("o_orderkey", C("o_custkey").alias("patient_unique_ident"), F.lit(False).alias("is_deleted"))
    return eligibility.soft_delete(customers(t, 52), rows, run(52))[1]


@query("eligibility_gaps", f"""
    with {PERIODS.format(length=90)}
    select ident as patient_unique_ident, date_diff('day', min(s), max(e))::int + 1 as span_days,
           sum(date_diff('day', s, e) + 1)::bigint as period_days,
           date_diff('day', min(s), max(e)) + 1 > sum(date_diff('day', s, e) + 1) as has_gap from per group by 1""")
def _(t):
    return eligibility.eligibility_gaps(periods(t, 66))


@query("eligibility_gaps_exact", f"""
    with {PERIODS.format(length=90)},
         d as (select distinct ident, unnest(generate_series(s, e, interval 1 day)) as day from per),
         c as (select ident, count(*) as n from d group by 1)
    select per.ident as patient_unique_ident, date_diff('day', min(s), max(e))::int + 1 as span_days, max(n)::bigint as period_days,
           date_diff('day', min(s), max(e)) + 1 > max(n) as has_gap
    from per join c on c.ident = per.ident group by 1""")
def _(t):
    return eligibility.eligibility_gaps(periods(t, 66), exact=True)


@query("inactivated_members", f"""
    with {CUSTOMERS.format(client=66)}, {PERIODS.format(length=90)},
         gap as (select ident from per where y = 1998 and year(e) = 1998 group by 1
                 having date_diff('day', min(s), max(e)) + 1 > sum(date_diff('day', s, e) + 1))
    select ident as patient_unique_ident,
           case when client = 66 and ident in (select ident from gap) then false
                when client = 66 and dob + interval 18 year > timestamp '1998-07-01' then false else active end as active from mem""")
def _(t):
    state = eligibility.inactivate_gapped(customers(t, 66), periods(t, 66), run(66))
    return eligibility.inactivate_age(state, run(66), 18).select("patient_unique_ident", "active")


@query("inactivated_by_age_range", f"""
    with {CUSTOMERS.format(client=95)}
    select ident as patient_unique_ident,
           case when client = 95 and (dob + interval 5 year > timestamp '1998-07-01' or dob + interval 65 year <= timestamp '1998-07-01')
                then false else active end as active from mem""")
def _(t):
    return eligibility.inactivate_age(customers(t, 95), run(95), 5, 64).select("patient_unique_ident", "active")


@query("deactivated_members", f"""
    with {CUSTOMERS.format(client=67)}
    select ident as patient_unique_ident, case when client = 99 then false
           when client = 67 and ident in (select o_custkey from orders where o_totalprice > 450000) then false else active end as active
    from mem""")
def _(t):
    state = eligibility.deactivate(customers(t, 67), 99)
    listed = t.orders.where("o_totalprice > 450000").select(C("o_custkey").cast("string").alias("patient_id"))
    return eligibility.deactivate(state, 67, listed).select("patient_unique_ident", "active")


@query("activated_members", f"""
    with {CUSTOMERS.format(client=66)}, {PERIODS.format(length=120)},
         st as (select ident, bool_or(s <= date '1998-07-01' and e >= date '1998-07-01' and year(e) = 1998) as covered,
                       bool_or(year(e) = 1998) as ends from per where y = 1998 group by 1),
         gap as (select ident from per where y = 1998 and year(e) = 1998 group by 1
                 having date_diff('day', min(s), max(e)) + 1 > sum(date_diff('day', s, e) + 1)),
         a as (select mem.*, case when client = 66 then coalesce(covered, false) else active end as act,
                      case when client = 66 and coalesce(ends, false) then 1998 else elig end as el
               from mem left join st on st.ident = mem.ident)
    select ident as patient_unique_ident, case when client = 66 and (ident in (select ident from gap)
                or dob + interval 18 year > timestamp '1998-07-01') then false else act end as active,
           el as eligibilityyear, case when client = 66 then el is null or el < 1997 else false end as is_deleted
    from a""")
def _(t):
    members = customers(t, 66)
    return eligibility.activate(members, periods(t, 66, 120), members, run(66))[0].select(
        "patient_unique_ident", "active", "eligibilityyear", "is_deleted")


# ---- detail and flags -----------------------------------------------------------------

def open_detail(t):
    """One open detail row per customer, and a closed one for those with an old order."""
    none = F.lit(None)
    rows = t.customer.select(C("c_custkey").alias("patient_unique_ident"), none.cast("timestamp_ntz").alias("end_date"))
    closed = t.orders.where(F.year("o_orderdate") == 1995).select(
        C("o_custkey").alias("patient_unique_ident"), F.lit("2013-01-01").cast("timestamp_ntz").alias("end_date")).distinct()
    rows = rows.unionByName(closed)
    return rows.withColumns({"mtmp_flg": none.cast("boolean"), "supd_flag": F.lit(7), "lis_flag": F.lit(True),
                             "lis_discount": F.lit("old"), "statin_flag": none.cast("boolean"), "asthma_flag": F.lit(False),
                             "esrd": F.lit(False), "hospice": F.lit(False), "phone_number": F.lit("0"),
                             "planidentifier_pclm": none.cast("string")})


OPEN = """
    det as (select c_custkey as ident, cast(null as timestamp) as end_date, c_mktsegment <> 'BUILDING' as mine from customer
            union all select distinct o_custkey, timestamp '2013-01-01', c_mktsegment <> 'BUILDING'
            from orders join customer on c_custkey = o_custkey where year(o_orderdate) = 1995)"""


@query("latest_plan", f"""
    with {OPEN}, lp as (select o_custkey as k, o_orderpriority as plan, row_number() over
                (partition by o_custkey order by o_orderdate desc, o_orderpriority desc) as r from orders where year(o_orderdate) = 1998)
    select ident as patient_unique_ident, end_date, case when end_date is null then plan end as planidentifier_pclm
    from det left join lp on k = ident and r = 1""")
def _(t):
    return eligibility.latest_plan(open_detail(t), periods(t, 62), run(62)).select(
        "patient_unique_ident", "end_date", "planidentifier_pclm")


@query("snapshot_flags", f"""
    with {OPEN}, feed as (select o_custkey as k, cast(o_orderdate as date) as d, o_orderstatus as s from orders),
         listed as (select distinct k from feed where d = (select max(d) from feed) and s <> 'O')
    select ident as patient_unique_ident, end_date, case when end_date is null and mine then k is not null end as mtmp_flg
    from det left join listed on k = ident""")
def _(t):
    feed = t.orders.select(C("o_custkey").cast("string").alias("patientid"), C("o_orderdate").alias("update_datetime"),
                           F.when(C("o_orderstatus") != "O", "Y").alias("client_def_1"))
    out = plans.apply_flags(open_detail(t), customers(t, 62), periods(t, 62), {"membership": feed}, run(62), date(1999, 1, 1))
    return out.select("patient_unique_ident", "end_date", "mtmp_flg")


@query("snapshot_flags_gated", f"""
    with {OPEN} select ident as patient_unique_ident, end_date, cast(null as boolean) as mtmp_flg from det""")
def _(t):
    feed = t.orders.select(C("o_custkey").cast("string").alias("memberid"), C("o_orderdate").alias("update_datetime"))
    out = plans.apply_flags(open_detail(t), customers(t, 52), periods(t, 52), {"program": feed}, run(52), date(2050, 1, 1))
    return out.select("patient_unique_ident", "end_date", "mtmp_flg")


@query("benefit_flags", f"""
    with {OPEN}, b as (select o_custkey as k, max(struct_pack(a := o_orderstatus = 'F', b := o_orderpriority)) as v
                       from orders where year(o_orderdate) = 1998 group by 1)
    select ident as patient_unique_ident, end_date, case when end_date is null and mine then v.a else true end as lis_flag,
           case when end_date is null and mine then v.b else 'old' end as lis_discount
    from det left join b on k = ident""")
def _(t):
    feed = t.orders.select(C("o_custkey").alias("pmd_patient_id"), (C("o_orderstatus") == "F").alias("lis_flag"),
                           C("o_orderpriority").alias("discount_status"), F.year("o_orderdate").alias("runyear"))
    out = plans.apply_flags(open_detail(t), customers(t, 15), periods(t, 15), {"benefits": feed}, run(15))
    return out.select("patient_unique_ident", "end_date", "lis_flag", "lis_discount")


CONDITIONS = f"""
    with {OPEN}
    select ident as patient_unique_ident, end_date,
           end_date is null and mine and ident in (select o_custkey from orders where o_totalprice > 450000) as esrd,
           end_date is null and mine and ident in (select o_custkey from orders where o_totalprice < 5000) as hospice,
           case when end_date is null and mine then ident in (select o_custkey from orders where o_orderpriority = '5-LOW'
                and year(o_orderdate) = 1998) end as mtmp_flg
    from det"""


def condition_feeds(t):
    return {"esrd": t.orders.where("o_totalprice > 450000").select(C("o_custkey").alias("hap_id")),
             "hospice": t.orders.where("o_totalprice < 5000").select(C("o_custkey").alias("hap_id")),
             "program": t.orders.where((C("o_orderpriority") == "5-LOW") & (F.year("o_orderdate") == 1998)).select(
                 C("o_custkey").cast("string").alias("pmd_patient_id"))}


@query("condition_flags", CONDITIONS)
def _(t):
    out = plans.apply_flags(open_detail(t), customers(t, 85), periods(t, 85), condition_feeds(t), run(85))
    return out.select("patient_unique_ident", "end_date", "esrd", "hospice", "mtmp_flg")


@query("condition_flags_by_key", CONDITIONS)
def _(t):
    """Members and their detail stored by member."""
    path, key = shared_folder(t.spark), "patient_unique_ident"
    save_by_key(open_detail(t), f"{path}/detail", 1, key, 8)
    save_by_key(customers(t, 85), f"{path}/members", 1, key, 8)
    detail, who = (load_by_key(t.spark, f"{path}/{name}") for name in ("detail", "members"))
    out = plans.apply_flags(detail, who, periods(t, 85), condition_feeds(t), run(85))
    return out.select(key, "end_date", "esrd", "hospice", "mtmp_flg")


@query("statin_flags", f"""
    with {OPEN}
    select ident as patient_unique_ident, end_date,
           case when end_date is null and mine and ident in (select o_custkey from orders where o_totalprice > 400000) then true
                when end_date is null and mine and ident in (select o_custkey from orders where o_totalprice > 300000) then false end as statin_flag,
           end_date is null and mine and ident in (select o_custkey from orders where o_totalprice < 5000) as asthma_flag
    from det""")
def _(t):
    def ids(condition):
        return t.orders.where(condition).select(C("o_custkey").alias("patient_id"))
    feeds = {"statin_reset": ids("o_totalprice > 300000"), "statin": ids("o_totalprice > 400000"), "asthma": ids("o_totalprice < 5000")}
    out = plans.apply_flags(open_detail(t), customers(t, 95), periods(t, 95), feeds, run(95))
    return out.select("patient_unique_ident", "end_date", "statin_flag", "asthma_flag")


@query("supd_codes", f"""
    with {OPEN}, b as (select o_custkey as k, max(case left(o_orderpriority, 1) when '1' then 1 when '2' then 2 else 0 end) as code
                       from orders where year(o_orderdate) = 1998 group by 1)
    select ident as patient_unique_ident, end_date, case when end_date is null and mine and k is not null then code else 7 end as supd_flag
    from det left join b on k = ident""")
def _(t):
    feed = t.orders.where(F.year("o_orderdate") == 1998).select(
        C("o_custkey").alias("patient_id"), F.left("o_orderpriority", F.lit(1)).alias("client_def_3"))
    out = plans.apply_flags(open_detail(t), customers(t, 94), periods(t, 94), {"membership": feed}, run(94))
    return out.select("patient_unique_ident", "end_date", "supd_flag")


@query("phone_override", f"""
    with {OPEN}, b as (select o_custkey as k, max(right('0000000000' || cast(o_orderkey * 10007 as varchar), 10)) as number
                       from orders where o_orderpriority = '5-LOW' group by 1)
    select ident as patient_unique_ident, end_date, case when end_date is null and mine then coalesce(number, '0') else '0' end as phone_number
    from det left join b on k = ident""")
def _(t):
    feed = t.orders.where("o_orderpriority = '5-LOW'").select(
        C("o_custkey").alias("patientid"), text.pad_code(C("o_orderkey") * 10007, 10).alias("updatednumber"))
    out = plans.apply_flags(open_detail(t), customers(t, 76), periods(t, 76), {"phones": feed}, run(76))
    return out.select("patient_unique_ident", "end_date", "phone_number")


@query("refreshed_detail", f"""
    with born as (select c_custkey as k, cast(1998 - year(date '1935-01-01' + cast(floor(c_acctbal) as int) * 3) as int) as y from customer),
         band as (select k, cast(case when y <= 10 then 0 when y >= 90 then 9 else floor(y / 10) end as int) as b from born),
         ver as (select o_custkey as k, max(c_name) as verified from orders join customer on c_custkey = o_custkey
                 where o_totalprice > 450000 group by 1),
         o as (select x.*, b from {DETAIL.format(day='1997-01-01')} x join band on k = member where r = 1),
         n as (select x.member, address, plan, coalesce(left(verified, 10), phone) as phone, b
               from {DETAIL.format(day='1998-01-01')} x join band on band.k = member left join ver on ver.k = member where r = 1),
         j as (select o.member as om, n.member as nm, o.address as oa, n.address as na, o.plan as op, n.plan as np,
                      o.phone as oph, n.phone as nph, coalesce(o.b, n.b) as b,
                      o.address is not distinct from n.address and o.plan = n.plan
                          and (o.phone = n.phone or {BAD_PHONE.format('n.phone')}) as same
               from o full join n on o.member = n.member),
         v as (select om as m, oa as a, op as p, oph as ph, timestamp '2013-01-01' as s,
                      case when nm is not null and not same then timestamp '1998-07-01' end as e, b, 1 as run from j where om is not null
               union all
               select nm, na, np, case when {BAD_PHONE.format('nph')} then oph else nph end,
                      timestamp '1998-07-01', null, b, 31 from j where om is not null and nm is not null and not same
               union all
               select nm, na, np, nph, timestamp '2013-01-01', null, b, 31 from j where om is null)
    select m as patient_unique_ident, a as address, p as pbp_pclm, ph as phone_number, s as start_date, e as end_date,
           b as patient_agebandsort, run as run_id from v""")
def _(t):
    def named(day):
        return detail(t, day).select(
            C("member").alias("patient_unique_ident"), "address", C("plan").alias("pbp_pclm"), C("phone").alias("phone_number"),
            *[F.lit(None).cast("string").alias(c) for c in ("address_2", "city", "state", "zip_code", "supc_flag")],
            F.lit(None).cast("boolean").alias("lis_flag"), F.lit(False).alias("esrd"))
    members = customers(t, 62)
    current = plans.stage_detail(named("1997-01-01"), members, None, run(62)).withColumns({
        "start_date": F.lit("2013-01-01").cast("timestamp_ntz"), "end_date": F.lit(None).cast("timestamp_ntz"),
        "run_id": F.lit(1), "create_datetime": F.lit("2013-01-01").cast("timestamp_ntz"),
        "update_datetime": F.lit("2013-01-01").cast("timestamp_ntz")}).withColumn("lis_flag", F.lit(False))
    verified = t.orders.where("o_totalprice > 450000").join(t.customer, C("o_custkey") == C("c_custkey")).select(
        C("o_custkey").alias("pmd_patient_id"), F.left("c_name", F.lit(10)).alias("phone_number"))
    state = plans.refresh_detail(named("1998-01-01"), members, current, run(62), phones=verified)
    return state.select("patient_unique_ident", "address", "pbp_pclm", "phone_number", "start_date", "end_date",
                        "patient_agebandsort", "run_id")


NIGHTS = (datetime(1996, 1, 1), datetime(1997, 6, 1), datetime(1999, 1, 1), datetime(2001, 1, 1))


def nights(t):
    """Four nightly runs, of which the second dies before it is complete; orders are the feed, cut at the time of the run."""
    root = shared_folder(t.spark)
    feed = t.orders.where(C("o_orderdate") < NIGHTS[-1]).select(
        C("o_custkey").alias("patient_unique_ident"), C("o_orderpriority").alias("address"), C("o_orderstatus").alias("pbp_pclm"),
        F.lit("2125550100").alias("phone_number"), C("o_orderdate").alias("update_datetime"),
        *[F.lit(None).cast("string").alias(c) for c in ("address_2", "city", "state", "zip_code", "supc_flag")],
        F.lit(None).cast("boolean").alias("lis_flag"), F.lit(False).alias("esrd"))
    members = customers(t, 62).withColumn("dob", F.lit(date(1955, 6, 1)))  # one age band in all runs
    empty = plans.stage_detail(feed.where("false"), members, None, run(62)).withColumns(
        {"start_date": F.lit(None).cast("timestamp_ntz"), "end_date": F.lit(None).cast("timestamp_ntz"), "run_id": F.lit(1),
         "create_datetime": F.lit(None).cast("timestamp_ntz")})
    save_state(empty, f"{root}/detail", 0)
    save_state(t.spark.createDataFrame([], "run_id bigint, pmd_client_id int, run_datetime timestamp_ntz, stars_patients string, "
                                           "stars_patients_detail string"), f"{root}/run_ledger", 0)
    for run_id, when in enumerate(NIGHTS, 1):
        p = RunParams(client_id=62, run_year=when.year, as_of=when, run_id=run_id)
        seen = feed.where(C("update_datetime") < when)
        if run_id == 2:
            runs.open_run(t.spark, f"{root}/run_ledger", p)
        else:
            plans.nightly_detail(t.spark, root, seen, members, p)
    return root


WINDOWS = """
    day(run, since, til) as (values (1, timestamp '1900-01-01', timestamp '1996-01-01'), (3, timestamp '1996-01-01', timestamp '1999-01-01'),
                                    (4, timestamp '1999-01-01', timestamp '2001-01-01')),
    pick as (select run, til, o_custkey as k, o_orderpriority as a, o_orderstatus as p, row_number() over (
                 partition by run, o_custkey order by o_orderdate desc, o_orderpriority desc, o_orderstatus desc) as r
             from orders join customer on c_custkey = o_custkey join day on o_orderdate >= since and o_orderdate < til),
    step as (select *, lag(a) over (partition by k order by run) as la, lag(p) over (partition by k order by run) as lp,
                    row_number() over (partition by k order by run) as nth from pick where r = 1),
    opened as (select * from step where nth = 1 or a <> la or p <> lp)"""


@query("detail_since_last_run", f"""
    with {WINDOWS}
    select k as patient_unique_ident, a as address, p as pbp_pclm, run as run_id,
           case when nth = 1 then timestamp '2013-01-01' else til end as start_date,
           lead(til) over (partition by k order by run) as end_date from opened""")
def _(t):
    state = load_state(t.spark, f"{nights(t)}/detail")
    return state.select("patient_unique_ident", "address", "pbp_pclm", C("run_id").cast("int").alias("run_id"), "start_date", "end_date")


@query("ledger_of_nightly_runs", f"""
    with {WINDOWS}
    select run_id, run_datetime, status as stars_patients_detail, done as stars_patients_detail_complete_datetime,
           coalesce(n, case when done is not null then 0 end) as details_imported
    from (values (1, timestamp '1996-01-01', 'Success', timestamp '1996-01-01'), (2, timestamp '1997-06-01', 'Not Complete', null),
                 (3, timestamp '1999-01-01', 'Success', timestamp '1999-01-01'), (4, timestamp '2001-01-01', 'Success', timestamp '2001-01-01'))
         l(run_id, run_datetime, status, done) left join (select run, count(*) as n from opened group by run) on run = run_id""")
def _(t):
    ledger = load_state(t.spark, f"{nights(t)}/run_ledger")
    return ledger.select(C("run_id").cast("int").alias("run_id"), "run_datetime", "stars_patients_detail",
                         "stars_patients_detail_complete_datetime", "details_imported")


# ---- do not call ------------------------------------------------------------------------

@query("dnc_flag", """
    with a as (select o_custkey as k, o_orderpriority as p, o_orderdate = max(o_orderdate) over (partition by o_custkey) as newest from orders),
         ids as (select k from a join customer on c_custkey = k where newest and left(p, 1) = '1' and c_mktsegment <> 'BUILDING'
                 union select o_custkey from orders where o_orderstatus = 'F' and o_totalprice > 450000 and year(o_orderdate) = 1998
                 union select o_custkey from orders where cast(o_orderdate as date) = (select max(cast(o_orderdate as date)) from orders)
                       and o_orderstatus = 'P')
    select c_custkey as patient_unique_ident, case when k is not null then true else false end as dnc_flag,
           case when k is not null then 'dncfile' end as dnc_flag_source
    from customer left join ids on k = c_custkey""")
def _(t):
    key = C("o_custkey").cast("string")
    feeds = {
        69: t.orders.select(key.alias("patient_id"), C("o_orderdate").alias("update_datetime"),
                            F.left("o_orderpriority", F.lit(1)).alias("carrier_code")),
        73: t.orders.where("o_totalprice > 450000").select(
            key.alias("hicn"), F.when(C("o_orderstatus") == "F", "n").otherwise("y").alias("ok to call"),
            F.year("o_orderdate").alias("runyear")),
        30: t.orders.select(key.alias("patientid"), F.to_date("o_orderdate").alias("file_date"),
                            F.when(C("o_orderstatus") == "P", "dnc").alias("clientdef1"))}
    members = customers(t, 69).withColumns({"dnc_flag": F.lit(False), "dnc_flag_source": F.lit(None).cast("string")})
    return plans.merge_dnc(members, feeds, run(69)).select("patient_unique_ident", "dnc_flag", "dnc_flag_source")
