"""Adherence staging, drug counts and days covered."""

from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from checks.registry import query
from tidewell.functions import text
from tidewell.params import RunParams
from tidewell.plans import adherence
from tidewell.session import shared_folder
from tidewell.sources import tables

C = F.col
P = RunParams(client_id=62, run_year=1998, as_of=datetime(1998, 12, 31), run_id=77)


def claims(t):
    rows = t.lineitem.join(t.orders, C("l_orderkey") == C("o_orderkey"))
    rows = rows.join(t.supplier.select("s_suppkey", "s_nationkey"), C("l_suppkey") == C("s_suppkey"))
    return rows.select(
        F.lit(62).alias("pmd_client_id"), C("l_orderkey").cast("string").alias("transaction_id"),
        C("o_custkey").cast("string").alias("patient_id"), C("l_shipdate").alias("date_of_service"),
        text.pad_code("l_partkey").alias("product_service_id"), C("l_quantity").cast("int").alias("days_supply"),
        C("l_quantity").alias("quantity_dispensed"), C("l_suppkey").cast("string").alias("prescriber_id"),
        C("l_suppkey").cast("string").alias("pharmacy_id"),
        F.concat(F.lit("H"), F.lpad(C("s_nationkey").cast("string"), 4, "0")).alias("accountid2"),
        F.when(C("l_linestatus") == "O", "D").otherwise("y").alias("medicare_part_d_ind"),
        F.when(C("l_returnflag") == "R", 333).alias("claimexccd"), F.year("l_shipdate").alias("runyear"),
        F.lit("rx").alias("prescription_service_reference_num"))


def drugs(t, *types):
    return t.part.where(C("p_type").isin(list(types))).select(
        text.pad_code("p_partkey").alias("ndc"), C("p_type").alias("measureuse"), C("p_name").alias("Drug Name"),
        C("p_brand").alias("Drug Description"), C("p_size").cast("string").alias("strength"),
        F.lit("MG").alias("strength_unit_of_measure"), F.lit("TABLET").alias("dosage_form"), F.lit("gpi").alias("gpi"))


def members(t):
    return t.customer.select(C("c_custkey").cast("string").alias("patient_id"), C("c_custkey").alias("patient_unique_ident"),
                             F.when(C("c_mktsegment") == "BUILDING", 15).otherwise(62).alias("pmd_client_id"))


def contracts(t):
    """Nations as plans; each is listed for two measures, and a third of them is not active."""
    plans = t.nation.select(F.concat(F.lit("H"), F.lpad(C("n_nationkey").cast("string"), 4, "0")).alias("planidentifier_pclm"),
                            (C("n_regionkey") < 3).alias("analytics_contract"),
                            F.explode(F.array(F.lit("RAS"), F.lit("Statin"))).alias("measure_use"))
    return plans.withColumns({"pmd_client_id": F.lit(62), "contract_year": F.lit(1998)})


BASE = """
    base as (select l_orderkey, o_custkey, l_shipdate, l_partkey, l_quantity, l_suppkey, l_linestatus, l_returnflag, p_type,
                    p_name, p_brand, p_size, 'H' || lpad(cast(s_nationkey as varchar), 4, '0') as plan,
                    cast(l_shipdate as date) + cast(l_quantity as int) - 1 as last_day
             from lineitem join orders on l_orderkey = o_orderkey join customer on c_custkey = o_custkey
                  join supplier on s_suppkey = l_suppkey join nation on n_nationkey = s_nationkey
                  join part on p_partkey = l_partkey
             where year(l_shipdate) = 1998 and c_mktsegment <> 'BUILDING' and n_regionkey < 3)"""
STAGED = """77 as evalrun_id, 62 as pmd_client_id, 1998 as runyear, o_custkey as pmd_patient_id,
    cast(l_orderkey as varchar) as transaction_id, plan as planidentifier_pclm,
    case l_linestatus when 'O' then 'D' else 'y' end as medicare_part_d_ind, cast(o_custkey as varchar) as patient_id,
    l_shipdate as date_of_service, dayofyear(l_shipdate)::int as julianstart, dayofyear(last_day)::int as julianend,
    last_day as supply_end, {prescriber}, {measure} as measureuse, left(p_name, 60) as drug_name,
    cast(l_quantity as int) as days_supply, l_quantity as quantity_dispensed, 'TABL' as dosage_form, 'gpi' as gpi,
    right('00000000000' || l_partkey, 11) as ndc, 'MG' as unit_of_measure, {texts}"""


ADHERENCE = f"""
    with {BASE}
    select {STAGED.format(prescriber="max(cast(l_suppkey as varchar)) as prescriber_id, max(cast(l_suppkey as varchar)) as pharmacy_id",
                          measure="p_type", texts="max(p_brand) as drug_description, max(cast(p_size as varchar)) as drug_strength")},
           'rx' as prescription_service_reference_num
    from base where l_returnflag <> 'R' and p_type in ('PROMO', 'SMALL', 'LARGE')
    group by o_custkey, l_orderkey, plan, l_linestatus, l_shipdate, last_day, p_type, p_name, l_quantity, l_partkey"""


@query("adherence_claims", ADHERENCE)
def _(t):
    staged = adherence.stage_adherence(claims(t), drugs(t, "PROMO", "SMALL", "LARGE"), members(t), contracts(t), P)
    return staged.withColumnRenamed("drug description", "drug_description")


@query("adherence_claims_by_key", ADHERENCE)
def _(t):
    """Claims and members stored by patient."""
    path = shared_folder(t.spark)
    tables.save_by_key(claims(t), f"{path}/claims", 1, "patient_id", 8)
    tables.save_by_key(members(t), f"{path}/members", 1, "patient_id", 8)
    stored = [tables.load_by_key(t.spark, f"{path}/{name}") for name in ("claims", "members")]
    staged = adherence.stage_adherence(stored[0], drugs(t, "PROMO", "SMALL", "LARGE"), stored[1], contracts(t), P)
    return staged.withColumnRenamed("drug description", "drug_description")


@query("adherence_changed_members", ADHERENCE)
def _(t):
    """A run after late claims, reversals, deleted claims, changed contracts, drug names and member numbers."""
    after = adherence.AdherenceInputs(claims(t), drugs(t, "PROMO", "SMALL", "LARGE"), members(t), contracts(t))
    number = C("transaction_id").cast("bigint")
    old_claims = after.claims.where(number % 50 != 1).withColumn("claimexccd", F.when(number % 40 != 2, C("claimexccd")))
    deleted = after.claims.where(number % 60 == 3).withColumn("transaction_id", F.concat(F.lit("-"), "transaction_id"))
    plan = F.substring("planidentifier_pclm", 2, 4).cast("int")
    before = adherence.AdherenceInputs(
        old_claims.unionByName(deleted),
        after.drugs.withColumn("Drug Name", F.when(C("strength").cast("int") == 7, "old name").otherwise(C("Drug Name"))),
        after.members.withColumn("patient_unique_ident", F.when(C("patient_unique_ident") % 90 == 4, -C("patient_unique_ident")).otherwise(
            C("patient_unique_ident"))),
        after.contracts.withColumn("analytics_contract", F.when(plan == 5, ~C("analytics_contract")).otherwise(C("analytics_contract"))))
    earlier = replace(P, run_id=76)
    staged = tables.written(adherence.stage_adherence(before.claims, before.drugs, before.members, before.contracts, earlier))
    return adherence.restage(staged, before, after, P).withColumnRenamed("drug description", "drug_description")


@query("insulin_claims", f"""
    with {BASE}
    select distinct {STAGED.format(prescriber="cast(l_suppkey as varchar) as prescriber_id, cast(l_suppkey as varchar) as pharmacy_id",
                    measure="'Diabetes-InsulinExclusion'", texts="p_brand as drug_description, cast(p_size as varchar) as drug_strength")}
    from base where p_type in ('MEDIUM')""")
def _(t):
    staged = adherence.stage_insulin(claims(t), drugs(t, "MEDIUM"), members(t), contracts(t), P)
    return staged.withColumnRenamed("drug description", "drug_description")


@query("ras_exclusion_claims", f"""
    with {BASE}
    select distinct {STAGED.format(prescriber="cast(l_suppkey as varchar) as prescriber_id, cast(l_suppkey as varchar) as pharmacy_id",
                    measure="p_type", texts="p_brand as drug_description, cast(p_size as varchar) as drug_strength")},
           'rx' as prescription_service_reference_num
    from base where l_returnflag <> 'R' and p_type in ('PROMO', 'SMALL') and p_size <= 20""")
def _(t):
    excluding = t.part.where("p_size <= 20").select(text.pad_code("p_partkey").alias("ndc"))
    staged = adherence.stage_ras_exclusion(claims(t), drugs(t, "PROMO", "SMALL"), members(t), contracts(t), excluding, P)
    return staged.withColumnRenamed("drug description", "drug_description")


def fills(t, lines=None):
    """All claims of the driver tables as staged fills: measure = part type, drug = part name."""
    rows = (t.lineitem if lines is None else lines).join(t.orders, C("l_orderkey") == C("o_orderkey")).join(t.part, C("l_partkey") == C("p_partkey"))
    return rows.select(F.lit(77).alias("evalrun_id"), C("o_custkey").alias("pmd_patient_id"), C("p_type").alias("measureuse"),
                       F.concat(C("o_orderstatus"), F.lit("-PLAN-"), C("o_orderpriority")).alias("planidentifier_pclm"),
                       C("p_name").alias("drug_name"), C("l_shipdate").alias("date_of_service"),
                       C("l_quantity").cast("int").alias("days_supply"))


COUNTED = """
    select 77 as evalrun_id, cast(o_custkey as varchar) as pmd_patient_id, p_type as measureuse,
           left(o_orderstatus || '-PLAN-' || o_orderpriority, 5) as planidentifier_pclm,
           count(distinct p_name) as pt_meas_plan_drugcounter
    from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
    group by 2, 3, 4 having count(distinct p_name)"""


@query("single_drug", f"{COUNTED} = 1")
def _(t):
    return adherence.single_drug(fills(t))


@query("multi_drug", f"{COUNTED} > 1")
def _(t):
    return adherence.multi_drug(fills(t))


def fills_before(t):
    """Fills of an earlier run: some members lack late ones, and some had others since taken back."""
    kept = t.lineitem.where("l_orderkey % 30 <> 0")
    taken_back = t.lineitem.where("l_orderkey % 50 = 7").withColumn("l_shipdate", C("l_shipdate") + F.expr("interval 11 days"))
    return fills(t, kept.unionByName(taken_back)).withColumn("evalrun_id", F.lit(76))


@query("multi_drug_changed_members", f"{COUNTED} > 1")
def _(t):
    before, after = fills_before(t), fills(t)
    previous = tables.written(adherence.multi_drug(before).withColumn("evalrun_id", F.lit(77)))
    return adherence.refresh_measures(previous, before, after, adherence.multi_drug)


FILLS = """
    f as (select o_custkey as m, p_type as u, cast(l_shipdate as date) as d, cast(l_quantity as int) as n
          from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
          where year(l_shipdate) = 1998)"""


@query("days_covered", f"""
    with {FILLS},
         days as (select distinct m, u, unnest(generate_series(d, least(d + n - 1, date '1998-12-31'), interval 1 day)) as day from f),
         first as (select m, u, min(dayofyear(d))::int as first_fill from f group by 1, 2)
    select days.m as pmd_patient_id, days.u as measureuse, first_fill, count(*)::int as days_covered,
           (365 - first_fill + 1)::int as days_in_period, (count(*) * 10000 // (365 - first_fill + 1))::bigint as pdc_bp
    from days join first on first.m = days.m and first.u = days.u group by 1, 2, 3""")
def _(t):
    return adherence.days_covered(fills(t), P, shift=False)


SHIFTED = f"""
    with recursive {FILLS},
         o as (select *, row_number() over (partition by m, u order by d, n) as r from f),
         s as (select m, u, r, d, n, d as a, d + n - 1 as b from o where r = 1
               union all
               select o.m, o.u, o.r, o.d, o.n, greatest(o.d, s.b + 1), greatest(o.d, s.b + 1) + o.n - 1
               from s join o on o.m = s.m and o.u = s.u and o.r = s.r + 1),
         days as (select m, u, sum(greatest(0, date_diff('day', a, least(b, date '1998-12-31')) + 1)) as covered,
                         min(dayofyear(d)) as first_fill from s group by 1, 2)
    select m as pmd_patient_id, u as measureuse, first_fill::int as first_fill, covered::int as days_covered,
           (365 - first_fill + 1)::int as days_in_period, (covered * 10000 // (365 - first_fill + 1))::bigint as pdc_bp from days"""


@query("days_covered_shifted", SHIFTED)
def _(t):
    return adherence.days_covered(fills(t), P, shift=True)


@query("days_covered_changed_members", SHIFTED)
def _(t):
    before, after = fills_before(t), fills(t)
    previous = tables.written(adherence.days_covered(before, P, shift=True))
    return adherence.refresh_measures(previous, before, after, lambda rows: adherence.days_covered(rows, P, shift=True))


@query("days_covered_until", f"""
    with {FILLS},
         lim as (select o_custkey as k, max(dayofyear(o_orderdate)) as lim from orders where year(o_orderdate) = 1998 group by 1),
         g as (select f.*, dayofyear(d) as fd, lim from f join lim on k = m where dayofyear(d) <= lim),
         days as (select distinct m, u, unnest(generate_series(fd, least(fd + n - 1, lim))) as day from g),
         first as (select m, u, min(fd) as first_fill, max(lim) as lim from g group by 1, 2)
    select days.m as pmd_patient_id, days.u as measureuse, first_fill::int as first_fill, count(*)::int as days_covered,
           (lim - first_fill + 1)::int as days_in_period, (count(*) * 10000 // (lim - first_fill + 1))::bigint as pdc_bp
    from days join first on first.m = days.m and first.u = days.u group by 1, 2, first_fill, lim""")
def _(t):
    ends = t.orders.where(F.year("o_orderdate") == 1998).select(
        C("o_custkey").alias("pmd_patient_id"), F.to_date("o_orderdate").alias("eligibilityenddate"))
    return adherence.days_covered(fills(t), P, shift=False, eligible_until=ends)


@query("shifted_fills", f"""
    with recursive {FILLS},
         g as (select m, u, d, sum(n)::int as n, count(*) as c from f group by 1, 2, 3),
         o as (select *, row_number() over (partition by m, u order by d) as r from g),
         s as (select m, u, r, d, n, c, dayofyear(d)::int as a from o where r = 1
               union all
               select o.m, o.u, o.r, o.d, o.n, o.c, greatest(dayofyear(o.d)::int, s.a + s.n)
               from s join o on o.m = s.m and o.u = s.u and o.r = s.r + 1)
    select m as pmd_patient_id, u as measureuse, d as fill_day, c as fills, n as days, dayofyear(d)::int as julianstart,
           a as modifiedjulianstart, a + n - 1 as modifiedjulianend, (a - dayofyear(d))::int as slack from s""")
def _(t):
    return adherence.shifted_fills(fills(t), P)
