"""Claim loads: every client feed, built from the line items, against SQL."""

from datetime import datetime

from pyspark.sql import functions as F

from checks.registry import query
from checks.scalars import cents, overpunched
from tidewell.functions import text
from tidewell.operators import matching, picking
from tidewell.params import RunParams
from tidewell.plans import claims
from tidewell.plans.feeds import MEDICAL_FEEDS, PHARMACY_FEEDS

AS_OF = datetime(1999, 1, 15)
C = F.col


def params(client, year=1998):
    return RunParams(client_id=client, run_year=year, as_of=AS_OF, run_id=5)


@query("claims_latest_totals", """
    with v as (select * from (select *, row_number() over (partition by l_orderkey order by l_shipdate desc,
                  l_linenumber desc, l_partkey desc, l_suppkey desc, l_extendedprice desc) as r from lineitem) where r = 1),
         k as (select *, l_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R') as reversed
               from v where not exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus = 'F'))
    select right('00000000000' || l_partkey, 11) as product_service_id, count(*) as n_claims,
           count(*) filter (reversed) as n_reversed, sum(cast(l_quantity as bigint))::bigint as days_supply
    from k group by 1""")
def _(t):
    """Flagship: newest version per transaction, known ones left out, reversals flagged, totals per drug."""
    from tidewell.operators.changes import flag_matched
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                              "l_quantity", "l_shipdate", "l_returnflag")
    known = t.orders.where("o_orderstatus = 'F'")
    newest = picking.dedup_latest(lines, ["l_orderkey"], ["l_shipdate", "l_linenumber"],
                                  ["l_partkey", "l_suppkey", "l_extendedprice"])
    fresh = matching.only_new(newest, known, [("l_orderkey", "o_orderkey")])
    flagged = flag_matched(fresh, t.lineitem.where("l_returnflag = 'R'"), ["l_orderkey"], {"claimexccd": F.lit(333)})
    return flagged.groupBy(text.pad_code("l_partkey").alias("product_service_id")).agg(
        F.count(F.lit(1)).alias("n_claims"), F.count("claimexccd").alias("n_reversed"),
        F.sum(C("l_quantity").cast("bigint")).alias("days_supply"))


def lines(t, *more):
    """Line items with their member; what every raw feed is made from."""
    if isinstance(t, WrittenLines):
        return t.lines
    return t.lineitem.join(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", *more),
                           C("l_orderkey") == C("o_orderkey"))


class WrittenLines:
    """Tables whose line items, joined to their orders, are written once for all loads of a query.

    With ``by_year`` they have the year they were shipped in as ``runyear`` and are kept by it, so a load reads one year.
    """

    def __init__(self, t, *columns, more=(), by_year=False):
        from tidewell.sources.tables import written
        rows = lines(t, *more).select(*columns, *([F.year("l_shipdate").alias("runyear")] if by_year else []))
        self.tables, self.lines = t, written(rows, ["runyear"] if by_year else [])

    def __getattr__(self, name):
        return getattr(self.tables, name)


LINES_67 = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate", "l_returnflag",
            "o_custkey", "o_orderstatus")
LINES_52 = (*LINES_67, "l_tax", "l_discount", "l_linestatus", "l_extendedprice")
LINES_MEDICAL = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_linestatus", "o_custkey",
                 "o_orderstatus", "o_orderpriority")


def drugs(t):
    """Drug list with two names for most codes."""
    code = text.pad_code("p_partkey").alias("ndc11")
    listed = t.part.where("p_size <= 40")
    return listed.select(code, C("p_name").alias("medstaken")).unionByName(listed.select(code, C("p_brand").alias("medstaken")))


DRUGS = """dr as (select right('00000000000' || p_partkey, 11) as ndc11, min(least(p_name, p_brand)) as medstaken
                  from part where p_size <= 40 group by 1)"""
LINES = """li as (select l.*, o.o_custkey, o.o_orderstatus, o.o_orderdate, o.o_orderpriority
                  from lineitem l join orders o on l_orderkey = o_orderkey)"""


def as_text(name):
    return C(name).cast("string")


# ---- client 52: least sequence ----------------------------------------------------

def raw_52(t):
    return lines(t).select(
        as_text("l_orderkey").alias("transaction_id"), C("l_linenumber").alias("seq_num"),
        F.when(C("l_tax") > 0.07, "N").when(C("l_linestatus") == "O", "Y").otherwise("y").alias("medicare_part_d"),
        as_text("o_custkey").alias("patient_id"), F.lit("1950-02-03").alias("patient_dob"),
        F.when(C("l_discount") > 0.09, "U").when(C("l_discount") > 0.04, "F").otherwise("1").alias("patient_gender"),
        F.when(C("l_returnflag") == "R", "X").when(C("l_returnflag") == "A", "p").otherwise("P").alias("transaction_status"),
        F.to_date("l_shipdate").cast("string").alias("date_of_service"), as_text("l_partkey").alias("ndc_code"),
        F.lit("drug").alias("product_service_name"), as_text("l_quantity").alias("quantity_dispensed"),
        as_text("l_linenumber").alias("days_supply"), as_text("l_suppkey").alias("prescriber_npi"),
        as_text("l_suppkey").alias("pharmacy_npi"),
        F.when(C("l_linestatus") == "O", "not a date").otherwise(F.to_date("l_shipdate").cast("string")).alias("adjudication_date"),
        as_text("l_tax").alias("admin_fee"), as_text("l_extendedprice").alias("ingredient_cost"),
        F.lit("1.50").alias("disp_fee"), F.lit("0").alias("sales_tax"), as_text("l_orderkey").alias("prescription_num"))


LOAD_52 = f"""
    with {LINES}, {DRUGS},
    ok as (select * from li where l_tax <= 0.07 and l_discount <= 0.09 and length(cast(l_partkey as varchar)) > 1),
    paid as (select * from ok where l_returnflag <> 'R'),
    least98 as (select l_orderkey as k, min(l_linenumber) as m from paid where year(l_shipdate) = 1998 group by 1),
    old as (select cast(l_orderkey as varchar) as transaction_id, l_linenumber as seq, l_shipdate, l_partkey from li
            where o_orderstatus = 'F' and l_linestatus = 'O'),
    kept as (select * from old where not (year(l_shipdate) = 1998 and exists
                (select 1 from least98 where cast(k as varchar) = transaction_id and m < seq))),
    first as (select l_orderkey as k, min(l_linenumber) as m from paid group by 1),
    fresh as (select distinct cast(l_orderkey as varchar) as transaction_id, l_linenumber as seq, l_shipdate, l_partkey,
                     l_linenumber as days, medstaken, l_extendedprice, l_tax, l_suppkey, l_quantity,
                     case when l_linestatus = 'O' then null else cast(l_shipdate as date) end as adjudicated
              from paid join first on k = l_orderkey and m = l_linenumber
                   left join dr on ndc11 = right('00000000000' || l_partkey, 11)
              where cast(l_orderkey as varchar) not in (select transaction_id from kept)),
    rev as (select l_orderkey as k, min(l_linenumber) as m from ok where l_returnflag = 'R' and year(l_shipdate) = 1998 group by 1),
    state as (select transaction_id, seq, l_shipdate, l_partkey, null as days, null as medstaken, null as cost, null as adjudicated from kept
              union all select transaction_id, seq, l_shipdate, l_partkey, days, medstaken, l_extendedprice, adjudicated from fresh)
    select transaction_id, cast(seq as varchar) as paired_adjustment_sequence_num, l_shipdate as date_of_service,
           right('00000000000' || l_partkey, 11) as product_service_id, days as days_supply, medstaken as compositionname,
           cost as ingredient_cost, adjudicated as adjudication_date, year(l_shipdate)::int as runyear,
           case when k is not null and year(l_shipdate) = 1998 then 333 end as claimexccd
    from state left join rev on cast(k as varchar) = transaction_id and m = seq"""


def existing_52(t):
    return lines(t).where("o_orderstatus = 'F' and l_linestatus = 'O'").select(
        as_text("l_orderkey").alias("transaction_id"), F.lit(52).cast("bigint").alias("pmd_client_id"),
        as_text("o_custkey").alias("patient_id"), as_text("l_linenumber").alias("paired_adjustment_sequence_num"),
        C("l_shipdate").alias("date_of_service"), text.pad_code("l_partkey").alias("product_service_id"),
        F.year("l_shipdate").alias("runyear"), F.lit(None).cast("int").alias("claimexccd"))


@query("load_claims_52", LOAD_52)
def _(t):
    state = claims.load_claims(raw_52(t), drugs(t), existing_52(t), PHARMACY_FEEDS[52], params(52))
    return state.select("transaction_id", "paired_adjustment_sequence_num", "date_of_service", "product_service_id",
                        "days_supply", "compositionname", C("ingredient_cost").cast("double").alias("ingredient_cost"),
                        "adjudication_date", "runyear", "claimexccd")


# ---- client 15: packed amounts ----------------------------------------------------

def raw_15(t):
    claim = F.concat(as_text("l_orderkey"), F.lit("-"), as_text("l_linenumber"))
    number = F.translate(claim, "-", "")
    plans = F.array(*[F.lit(x) for x in ("9999", "3000", "4000", "4500", "5000", "8000", "7000", "6000")])
    price = overpunched(cents("l_extendedprice"), C("l_returnflag") == "A")
    units = overpunched((C("l_quantity") * 1000).cast("bigint").cast("string"), F.lit(False))
    day = F.to_date("l_shipdate").cast("string")
    return lines(t).select(
        number.alias("transactionclaimid"), number.alias("xreftransactionid"),
        F.when(C("l_returnflag") == "R", "32").otherwise("31").alias("transactiontypecd"),
        F.when(C("l_tax") > 0.07, "N").otherwise("y").alias("medicareddrug"),
        as_text("o_custkey").alias("cardholderidpersoncd"), F.lit("1950-02-03").alias("mbrdob"), day.alias("datefilled"),
        F.lit("1").alias("prescriptionorigincd"), text.pad_code("l_partkey").alias("ndc"), F.lit("drug").alias("drugname"),
        F.lit("g").alias("genericcd"), as_text("l_partkey").alias("gpi"), units.alias("qtydispensed"),
        as_text("l_linenumber").alias("dayssupply"), F.lit("10MG").alias("drugstrength"),
        as_text("l_suppkey").alias("prescribernpi"), as_text("l_suppkey").alias("pharmacynpi"), day.alias("adjudicationdate"),
        F.lit("DE").alias("recordidentifier"), F.get(plans, C("l_linenumber")).alias("plantype2"),
        as_text("l_orderkey").alias("prescriptionnumber9"), price.alias("adminfee"), F.lit("").alias("ucamt"),
        price.alias("calcingredientcost"), price.alias("dispensingfee"), price.alias("taxamt"), price.alias("amtbilled"),
        price.alias("otherpayoramt"), price.alias("licssubsidyamt"))


@query("load_claims_15", f"""
    with {LINES}, {DRUGS},
    raw as (select *, cast(l_orderkey as varchar) || cast(l_linenumber as varchar) as txn from li where l_tax <= 0.07),
    old as (select txn, l_shipdate, l_partkey, null as gpi_code, null as plan, null as amount, null as qty, null as medstaken,
                   case when l_linestatus = 'O' then 999 end as code
            from raw where o_orderstatus = 'F' and l_linestatus = 'O'),
    fresh as (select distinct txn, l_shipdate, l_partkey, rpad(cast(l_partkey as varchar), 14, ' ') as gpi_code,
                     case when l_linenumber in (1, 2, 3, 5) then 'H5425' else 'H5943' end as plan,
                     case when l_returnflag = 'A' then -l_extendedprice else l_extendedprice end as amount,
                     l_quantity as qty, medstaken, null as code, l_suppkey, o_custkey
              from raw left join dr on ndc11 = right('00000000000' || l_partkey, 11)
              where l_returnflag <> 'R' and l_linenumber between 1 and 5
                and not exists (select 1 from old where old.txn = raw.txn and year(old.l_shipdate) = year(raw.l_shipdate))),
    state as (select txn, l_shipdate, l_partkey, gpi_code, plan, amount, qty, medstaken, code from old
              union all select txn, l_shipdate, l_partkey, gpi_code, plan, amount, qty, medstaken, code from fresh)
    select txn as transaction_id, l_shipdate as date_of_service, right('00000000000' || l_partkey, 11) as product_service_id,
           gpi_code, plan as accountid2, amount as gross_cost, case when gpi_code is not null then 0.0 end as usual_customary,
           qty as quantity_dispensed, medstaken as compositionname,
           case when code is null and year(l_shipdate) = 1998 and txn in (select txn from raw where l_returnflag = 'R')
                then 333 else code end as claimexccd
    from state""")
def _(t):
    feed = PHARMACY_FEEDS[15]
    number = F.concat(as_text("l_orderkey"), as_text("l_linenumber"))
    existing = lines(t).where("o_orderstatus = 'F' and l_linestatus = 'O' and l_tax <= 0.07").select(
        number.alias("transaction_id"), F.lit(15).cast("bigint").alias("pmd_client_id"),
        as_text("o_custkey").alias("patient_id"), C("l_shipdate").alias("date_of_service"),
        text.pad_code("l_partkey").alias("product_service_id"), F.year("l_shipdate").alias("runyear"),
        F.lit(999).alias("claimexccd"))
    state = claims.load_claims(raw_15(t), drugs(t), existing, feed, params(15))
    return state.select("transaction_id", "date_of_service", "product_service_id", "gpi_code", "accountid2",
                        C("gross_cost").cast("double").alias("gross_cost"),
                        C("usual_customary").cast("double").alias("usual_customary"),
                        "quantity_dispensed", C("compositionname"), "claimexccd")


# ---- client 69: trimmed key -------------------------------------------------------

@query("load_claims_69", f"""
    with {LINES}, {DRUGS},
    raw as (select *, cast(l_orderkey as varchar) || cast(l_linenumber as varchar) as txn from li),
    old as (select * from raw where o_orderstatus = 'F'),
    fresh as (select distinct txn, o_custkey, l_shipdate, l_partkey, l_quantity, l_linenumber, l_suppkey, medstaken
              from raw left join dr on ndc11 = right('00000000000' || l_partkey, 11)
              where l_returnflag <> 'R' and o_orderstatus <> 'F' and not exists
                (select 1 from old where old.txn = raw.txn and year(old.l_shipdate) = year(raw.l_shipdate))),
    state as (select txn, l_shipdate, l_partkey, l_quantity, null as medstaken, null as account from old
              union all select txn, l_shipdate, l_partkey, l_quantity, medstaken, left('G' || o_custkey || '-plan', 5) from fresh)
    select txn as transaction_id, l_shipdate as date_of_service, right('00000000000' || l_partkey, 11) as product_service_id,
           l_quantity as quantity_dispensed, medstaken as compositionname, account as accountid2,
           case when year(l_shipdate) = 1998 and txn in (select txn from raw where l_returnflag = 'R') then 333 end as claimexccd
    from state""")
def _(t):
    feed = PHARMACY_FEEDS[69]
    number = F.concat(as_text("l_orderkey"), as_text("l_linenumber"))
    raw = lines(t).select(
        as_text("o_custkey").alias("memberid"), F.lit("1950-02-03").alias("memberdob"),
        F.to_date("l_shipdate").cast("string").alias("datefilled"), text.pad_code("l_partkey").alias("ndc"),
        F.lit("drug").alias("productdesc"), as_text("l_quantity").alias("metricqty"),
        F.concat(as_text("l_linenumber"), F.lit(".6")).alias("dayssupply"), as_text("l_suppkey").alias("prescriber_npi_nbr"),
        as_text("l_suppkey").alias("pharmcacy_npi_nbr"), F.concat(F.lit(" "), number, F.lit("  ")).alias("authnumber"),
        F.concat(F.lit("G"), as_text("o_custkey"), F.lit("-plan")).alias("groupnumber"),
        as_text("l_orderkey").alias("rxnumber"),
        F.when(C("l_returnflag") == "R", " r ").when(C("l_returnflag") == "N", "n").alias("reversal"))
    existing = lines(t).where("o_orderstatus = 'F'").select(
        number.alias("transaction_id"), F.lit(69).cast("bigint").alias("pmd_client_id"),
        as_text("o_custkey").alias("patient_id"), C("l_shipdate").alias("date_of_service"),
        text.pad_code("l_partkey").alias("product_service_id"), C("l_quantity").alias("quantity_dispensed"),
        F.year("l_shipdate").alias("runyear"), F.lit(None).cast("int").alias("claimexccd"))
    state = claims.load_claims(raw, drugs(t), existing, feed, params(69))
    return state.select("transaction_id", "date_of_service", "product_service_id", "quantity_dispensed",
                        "compositionname", "accountid2", "claimexccd")


# ---- client 62: newest version, account from the period ---------------------------

def member_periods(t, client):
    """Orders of a member as plan periods of the year, open for a quarter."""
    day = F.to_date("o_orderdate")
    return t.orders.where(F.year("o_orderdate") == 1998).select(
        C("o_custkey").alias("patient_unique_ident"), F.lit(client).alias("pmd_client_id"),
        C("o_orderpriority").alias("planidentifier_pclm"), day.alias("eligibilitystartdate"),
        F.date_add(day, 90).alias("eligibilityenddate"), F.lit(1998).alias("runyear"))


@query("load_claims_62", f"""
    with {LINES}, {DRUGS},
    old as (select distinct l_orderkey as k, year(l_shipdate) as y from li where o_orderstatus = 'F' and l_linestatus = 'O'),
    ranked as (select *, row_number() over (partition by l_orderkey order by l_shipdate desc,
                      lpad(cast(l_linenumber as varchar), 2, '0') || lpad(cast(l_partkey as varchar), 10, '0')
                      || lpad(cast(l_suppkey as varchar), 10, '0') || cast(l_extendedprice as varchar) desc) as r
               from li where l_returnflag <> 'R' and l_tax <= 0.07
                 and not exists (select 1 from old where k = l_orderkey and y = year(l_shipdate))),
    fresh as (select ranked.*, medstaken from ranked left join dr on ndc11 = right('00000000000' || l_partkey, 11) where r = 1),
    state as (select l_orderkey, o_custkey, l_shipdate, l_partkey, null as cost, null as medstaken, 'KEPT' as account from li
              where o_orderstatus = 'F' and l_linestatus = 'O'
              union all select l_orderkey, o_custkey, l_shipdate, l_partkey, l_extendedprice, medstaken, '' from fresh),
    per as (select o_custkey as member, cast(o_orderdate as date) as s, cast(o_orderdate as date) + 90 as e,
                   left(o_orderpriority, 5) as plan from orders where year(o_orderdate) = 1998),
    days as (select distinct o_custkey as member, cast(l_shipdate as date) as day from state),
    hit as (select days.member, day, plan, row_number() over (partition by days.member, day order by s desc, e desc, plan desc) as r
            from days join per on per.member = days.member and day between s and e)
    select cast(l_orderkey as varchar) as transaction_id, l_shipdate as date_of_service,
           right('00000000000' || l_partkey, 11) as product_service_id, cost as ingredient_cost, medstaken as compositionname,
           case when account = '' and year(l_shipdate) = 1998 and plan is not null then plan else account end as accountid2,
           case when year(l_shipdate) = 1998 and l_orderkey in (select l_orderkey from li where l_returnflag = 'R' and l_tax <= 0.07)
                then 333 end as claimexccd
    from state left join hit on hit.member = o_custkey and day = cast(l_shipdate as date) and hit.r = 1""")
def _(t):
    feed = PHARMACY_FEEDS[62]
    version = F.concat(F.lpad(as_text("l_linenumber"), 2, "0"), F.lpad(as_text("l_partkey"), 10, "0"),
                       F.lpad(as_text("l_suppkey"), 10, "0"), as_text("l_extendedprice"))
    day = F.to_date("l_shipdate").cast("string")
    price = as_text("l_extendedprice")
    raw = lines(t).select(
        as_text("l_orderkey").alias("transaction_id"), as_text("o_custkey").alias("patient_id"),
        as_text("o_custkey").alias("cardholder_id"), F.lit("1950-02-03").alias("patient_dob"), day.alias("date_of_service"),
        text.pad_code("l_partkey").alias("ndc_code"), F.lit("drug").alias("productnameshort"),
        as_text("l_quantity").alias("quantity_dispensed"), as_text("l_linenumber").alias("days_supply"),
        as_text("l_suppkey").alias("prescriber_npi"), as_text("l_suppkey").alias("pharmacy_npi"),
        day.alias("adjudication_date"), price.alias("admin_fee"), price.alias("usual_customary"),
        price.alias("ingredient_cost_submitted"), price.alias("ingredient_cost"), price.alias("disp_fee"),
        price.alias("sales_tax"), as_text("l_orderkey").alias("prescription_num"),
        F.when(C("l_returnflag") == "R", "R").otherwise("p ").alias("transaction_status"),
        F.when(C("l_tax") > 0.07, "NO").otherwise("Yes").alias("medicare_park_d"),
        as_text("l_orderkey").alias("client_def_1"), version.alias("file_date"), C("l_shipdate").alias("update_datetime"))
    existing = lines(t).where("o_orderstatus = 'F' and l_linestatus = 'O'").select(
        as_text("l_orderkey").alias("transaction_id"), F.lit(62).cast("bigint").alias("pmd_client_id"),
        as_text("o_custkey").alias("patient_id"), C("l_shipdate").alias("date_of_service"),
        text.pad_code("l_partkey").alias("product_service_id"), F.lit("KEPT").alias("accountid2"),
        F.year("l_shipdate").alias("runyear"), F.lit(None).cast("int").alias("claimexccd"))
    members = t.customer.select(C("c_custkey").alias("patient_unique_ident"), F.lit(62).alias("pmd_client_id"),
                                as_text("c_custkey").alias("patient_id"))
    state = claims.load_claims(raw, drugs(t), existing, feed, params(62), members, member_periods(t, 62))
    return state.select("transaction_id", "date_of_service", "product_service_id",
                        C("ingredient_cost").cast("double").alias("ingredient_cost"), "compositionname", "accountid2",
                        "claimexccd")


# ---- client 67: two reversal rules ------------------------------------------------

SHIFT = 6500  # days; moves the service dates around the change-over of the rules


LOAD_67 = f"""
    with {LINES}, {DRUGS},
    raw as (select *, cast(l_orderkey as varchar) || cast(l_linenumber as varchar) as txn,
                   cast(cast(l_shipdate as date) + {SHIFT} as timestamp) as served from li),
    old as (select * from raw where o_orderstatus = 'F'),
    fresh as (select distinct txn, o_custkey, served, l_partkey, l_quantity, l_linenumber, l_suppkey, medstaken, l_orderkey
              from raw left join dr on ndc11 = right('00000000000' || l_partkey, 11)
              where l_returnflag <> 'R' and o_orderstatus <> 'F'
                and not exists (select 1 from old where old.txn = raw.txn and year(old.served) = year(raw.served))),
    state as (select txn, served, l_partkey, null as medstaken, null as supply from old
              union all select txn, served, l_partkey, medstaken, l_linenumber::int + 1 from fresh),
    rev as (select txn, cast(l_orderkey as varchar) || '1' as original from raw where l_returnflag = 'R')
    select txn as transaction_id, served as date_of_service, right('00000000000' || l_partkey, 11) as product_service_id,
           medstaken as compositionname, supply as days_supply,
           case when year(served) = 2016 and served <= timestamp '2016-09-01' and txn in (select original from rev) then 333
                when year(served) = 2016 and served > timestamp '2016-09-01' and txn in (select txn from rev) then 333
           end as claimexccd
    from state"""


def feed_67(t):
    """(raw rows, stored claims): known orders are in the feed again."""
    number = F.concat(as_text("l_orderkey"), as_text("l_linenumber"))
    served = F.date_add(F.to_date("l_shipdate"), SHIFT)
    raw = lines(t).select(
        number.alias("transaction_id"), F.concat(as_text("l_orderkey"), F.lit("1")).alias("reversed_claim_id"),
        as_text("o_custkey").alias("patient_id"), served.cast("string").alias("date_of_service"),
        text.pad_code("l_partkey").alias("ndc_code"), F.lit("drug").alias("productnameshort"),
        as_text("l_quantity").alias("quantity_dispensed"), F.concat(as_text("l_linenumber"), F.lit(".6")).alias("days_supply"),
        as_text("l_suppkey").alias("prescriber_npi"), as_text("l_suppkey").alias("pharmacy_npi"),
        F.lit("PLAN7").alias("plan_code"), as_text("l_orderkey").alias("prescription_num"),
        F.when(C("l_returnflag") == "R", "Reversal").otherwise(" Paid").alias("transaction_status"))
    existing = lines(t).where("o_orderstatus = 'F'").select(
        number.alias("transaction_id"), F.lit(67).cast("bigint").alias("pmd_client_id"),
        as_text("o_custkey").alias("patient_id"), served.cast("timestamp_ntz").alias("date_of_service"),
        text.pad_code("l_partkey").alias("product_service_id"), F.year(served).alias("runyear"),
        F.lit(None).cast("int").alias("claimexccd"))
    return raw, existing


COLUMNS_67 = ("transaction_id", "date_of_service", "product_service_id", "compositionname", "days_supply", "claimexccd")


@query("load_claims_67", LOAD_67)
def _(t):
    raw, existing = feed_67(t)
    return claims.load_claims(raw, drugs(t), existing, PHARMACY_FEEDS[67], params(67, 2016)).select(*COLUMNS_67)


def with_unreadable(raw):
    """The feed with rows that have no readable day, or no transaction, among the others."""
    paid = raw.where("transaction_status = ' Paid' and transaction_id like '%1'")
    return raw.unionByName(paid.withColumn("date_of_service", F.lit("unknown"))).unionByName(
        paid.withColumn("transaction_id", F.lit(None).cast("string")))


@query("load_claims_67_twice", LOAD_67)
def _(t):
    from tidewell.session import shared_folder
    from tidewell.sources import tables
    t = WrittenLines(t, *LINES_67)
    raw, existing = feed_67(t)
    path = shared_folder(t.spark)
    raw, p = with_unreadable(raw), params(67, 2016)
    for run_id in (1, 2):  # the second load adds nothing
        state = existing if run_id == 1 else tables.load_state(t.spark, path)
        tables.save_state(claims.load_claims(raw, drugs(t), state, PHARMACY_FEEDS[67], p), path, run_id,
                          ["pmd_client_id", "runyear"])
    return tables.load_state(t.spark, path).select(*COLUMNS_67)


@query("claims_loaded_in_place", f"""
    with c52 as ({LOAD_52}), c67 as ({LOAD_67})
    select 52 as pmd_client_id, transaction_id, date_of_service, product_service_id, compositionname, days_supply, claimexccd from c52
    union all select 67, * from c67""")
def _(t):
    """Two clients in one table kept by client and year; the second load of a feed adds nothing."""
    from tidewell.session import shared_folder
    from tidewell.sources import tables
    path = shared_folder(t.spark)
    t = WrittenLines(t, *LINES_52)
    raw, existing = feed_67(t)
    tables.replace_partitions(existing.unionByName(existing_52(t), allowMissingColumns=True), path, 0, claims.CLAIM_PARTITION)
    for run_id, client, feed, year in ((1, 67, raw, 2016), (2, 52, raw_52(t), 1998), (3, 67, raw, 2016)):
        p = RunParams(client_id=client, run_year=year, as_of=AS_OF, run_id=run_id)
        claims.load_claims_into(t.spark, path, feed, drugs(t), PHARMACY_FEEDS[client], p)
    return tables.load_partitions(t.spark, path).select(C("pmd_client_id").cast("int").alias("pmd_client_id"), *COLUMNS_67)


@query("rejected_rows", f"""
    with {LINES},
    paid as (select cast(l_orderkey as varchar) || cast(l_linenumber as varchar) as txn from li
             where l_returnflag <> 'R' and l_linenumber % 10 = 1)
    select txn as transaction_id, 'unreadable service date' as reject_reason, 'date_of_service' as dirty from paid
    union all select null, 'no transaction id', '' from paid""")
def _(t):
    rows = claims.rejected_rows(with_unreadable(feed_67(t)[0]), PHARMACY_FEEDS[67])
    return rows.select("transaction_id", "reject_reason", F.array_join("dirty_columns", ",").alias("dirty"))


@query("claims_two_rule_reversal", """
    with r as (select l_orderkey as k, l_linenumber as n from lineitem where l_returnflag = 'R')
    select l_orderkey, l_linenumber, l_partkey, l_shipdate,
           case when l_shipdate <= timestamp '1998-09-01' and l_orderkey in (select k from r) then 333
                when l_shipdate > timestamp '1998-09-01' and l_linenumber in (select n from r where k = l_orderkey) then 333
           end as claimexccd
    from lineitem""")
def _(t):
    from datetime import date

    from tidewell.functions.dates import cutover
    from tidewell.operators.changes import flag_matched
    old, new = cutover("l_shipdate", date(1998, 9, 1))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate",
                             F.lit(None).cast("int").alias("claimexccd"))
    reversals = t.lineitem.where("l_returnflag = 'R'")
    rows = flag_matched(rows, reversals, ["l_orderkey"], {"claimexccd": 333}, old)
    return flag_matched(rows, reversals, ["l_orderkey", "l_linenumber"], {"claimexccd": 333}, new)


# ---- medical ----------------------------------------------------------------------

def raw_medical(t):
    rows = lines(t, "o_orderpriority")
    day = F.to_date("l_shipdate").cast("string")
    made = {
        "plan code": F.concat(F.lit("H"), C("o_orderpriority")), "claim id": as_text("l_orderkey"),
        "claim line number": as_text("l_linenumber"), "claim status": as_text("l_suppkey"),
        "claim submit date": day, "admission date": F.when(C("l_linestatus") == "O", day).otherwise("none"),
        "discharge date": day, "procedure date": F.lit("2020-13-45"), "patient id": as_text("o_custkey"),
        "servicing provider npi": as_text("l_suppkey"), "facility npi": F.lit(None).cast("string"),
        "unit qty": as_text("l_linenumber"), "admission type": as_text("l_linenumber"),
        "dx code principal": F.concat(F.lit("D"), as_text("l_partkey"), F.lit("0000000")),
        "runyear": C("runyear") if "runyear" in rows.columns else F.year("l_shipdate")}
    needed = set()
    for _, *arguments in MEDICAL_FEEDS[62].columns.values():
        names = arguments[0] if isinstance(arguments[0], tuple) else (arguments[0],)
        needed |= {n for n in names if isinstance(n, str)}
    blank = {n: F.lit("x") for n in sorted(needed) if n not in made}
    return rows.select(*[c.alias(n) for n, c in {**made, **blank}.items()])


LOAD_MEDICAL = f"""
    with {LINES},
    raw as (select *, 'H' || o_orderpriority as plan, left('H' || o_orderpriority, 5) as plan5 from li),
    old as (select * from raw where o_orderstatus = 'F' and l_linestatus = 'O'),
    fresh as (select distinct l_orderkey, l_linenumber, plan5, l_suppkey, l_shipdate, o_custkey, l_partkey, l_linestatus
              from raw where not exists (select 1 from old where year(old.l_shipdate) = 1998 and old.l_orderkey = raw.l_orderkey
                  and old.l_linenumber = raw.l_linenumber and old.plan5 = raw.plan5)),
    state as (select l_orderkey, l_linenumber, plan5, 0 as status, l_shipdate, null as facility, null as admitted, null as dx,
                     null as operated from old
              union all
              select l_orderkey, l_linenumber, plan5, l_suppkey, l_shipdate, cast(l_suppkey as varchar),
                     case when l_linestatus = 'O' then cast(cast(l_shipdate as date) as timestamp) else timestamp '1900-01-01' end,
                     left('D' || l_partkey || '0000000', 7), date '1900-01-01' from fresh),
    newest as (select l_orderkey, l_linenumber, plan5, l_suppkey, row_number() over
                  (partition by l_orderkey, l_linenumber, plan5 order by cast(l_shipdate as date) desc, l_suppkey desc) as r
               from raw where year(l_shipdate) = 1998)
    select cast(s.l_orderkey as varchar) as claim_id, s.l_linenumber as claim_line_num, s.plan5 as plan_code,
           case when year(l_shipdate) = 1998 and n.l_suppkey is not null then n.l_suppkey else status end as claim_status,
           cast(l_shipdate as date) as claim_submit_date, facility as facility_npi, admitted as admission_date,
           dx as dx_code_principal, operated as procedure_date, year(l_shipdate)::int as runyear
    from state s left join newest n on n.l_orderkey = s.l_orderkey and n.l_linenumber = s.l_linenumber
         and n.plan5 = s.plan5 and r = 1"""


def medical_state(t):
    return lines(t, "o_orderpriority").where("o_orderstatus = 'F' and l_linestatus = 'O'").select(
        F.lit(62).alias("pmd_client_id"), F.left(F.concat(F.lit("H"), C("o_orderpriority")), F.lit(5)).alias("plan_code"),
        as_text("l_orderkey").alias("claim_id"), C("l_linenumber").cast("bigint").alias("claim_line_num"),
        F.lit(0).cast("smallint").alias("claim_status"), F.to_date("l_shipdate").alias("claim_submit_date"),
        F.year("l_shipdate").alias("runyear"))


COLUMNS_MEDICAL = ("claim_id", "claim_line_num", "plan_code", "claim_status", "claim_submit_date", "facility_npi",
                   "admission_date", "dx_code_principal", "procedure_date", "runyear")


@query("load_medical_62", LOAD_MEDICAL)
def _(t):
    return claims.load_medical(raw_medical(t), medical_state(t), MEDICAL_FEEDS[62], params(62)).select(*COLUMNS_MEDICAL)


@query("load_medical_62_twice", f"""
    with {LINES},
    raw as (select *, left('H' || o_orderpriority, 5) as plan5, year(l_shipdate)::int as y, cast(l_shipdate as date) as day,
                   left('D' || l_partkey || '0000000', 7) as dx from li),
    loaded as (select distinct y, l_orderkey, l_linenumber, plan5, l_suppkey, day, o_custkey, dx, l_linestatus from raw),
    newest as (select *, row_number() over (partition by y, l_orderkey, l_linenumber, plan5 order by day desc, l_suppkey desc) as r from raw)
    select cast(s.l_orderkey as varchar) as claim_id, s.l_linenumber as claim_line_num, s.plan5 as plan_code,
           n.l_suppkey as claim_status, s.day as claim_submit_date, cast(s.l_suppkey as varchar) as facility_npi,
           case when s.l_linestatus = 'O' then cast(s.day as timestamp) else timestamp '1900-01-01' end as admission_date,
           s.dx as dx_code_principal, date '1900-01-01' as procedure_date, s.y as runyear, cast(s.o_custkey as varchar) as patient_id,
           s.day as discharge_date, s.l_linenumber as unit_qty
    from loaded s join newest n on n.y = s.y and n.l_orderkey = s.l_orderkey and n.l_linenumber = s.l_linenumber
         and n.plan5 = s.plan5 and r = 1""")
def _(t):
    from tidewell.session import shared_folder
    from tidewell.sources import tables
    t = WrittenLines(t, *LINES_MEDICAL, more=["o_orderpriority"], by_year=True)
    raw, path = raw_medical(t), shared_folder(t.spark)
    raw = raw.unionByName(raw.withColumn("claim line number", F.lit("first")))  # unreadable lines are not loaded
    tables.replace_partitions(medical_state(t).where("false"), path, 0, claims.CLAIM_PARTITION)
    years = [r[0] for r in raw.select("runyear").distinct().orderBy("runyear").collect()]
    for run_id, year in enumerate([*years, years[-1], years[len(years) // 2]], 1):  # a year's second load adds nothing
        p = RunParams(client_id=62, run_year=year, as_of=AS_OF, run_id=run_id)
        claims.load_medical_into(t.spark, path, raw.where(C("runyear") == year), MEDICAL_FEEDS[62], p)
    return tables.load_partitions(t.spark, path).select(*COLUMNS_MEDICAL, "patient_id", "discharge_date", "unit_qty")


@query("new_load_errors", """
    with r as (select l_orderkey, l_linenumber, l_partkey, l_shipdate,
                      row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate, l_partkey) as r from lineitem),
         e as (select o_orderkey as k, cast(o_orderdate as date) as d from orders)
    select 999 as errorcode, cast(l_orderkey as varchar) as claim_id, l_linenumber as claim_line_num,
           cast(l_shipdate as date) as admission_date, l_partkey as part
    from r where r > 1 and not exists (select 1 from e where k = l_orderkey and d + 1 = cast(l_shipdate as date))""")
def _(t):
    day = F.to_date("l_shipdate")
    rows = t.lineitem.select(day.alias("admission_date"), C("l_partkey").alias("part"), F.lit(62).alias("pmd_client_id"),
                             as_text("l_orderkey").alias("claim_id"), C("l_linenumber").alias("claim_line_num"))
    reported = t.orders.join(t.lineitem, C("l_orderkey") == C("o_orderkey")).select(
        F.lit(999).alias("errorcode"), F.lit(62).alias("pmd_client_id"), as_text("o_orderkey").alias("claim_id"),
        C("l_linenumber").alias("claim_line_num"), F.date_add(F.to_date("o_orderdate"), 1).alias("admission_date"))
    _, bad = claims.split_errors(rows, reported, ("claim_id", "claim_line_num"))
    return bad.select("errorcode", "claim_id", "claim_line_num", "admission_date", "part")


@query("good_load_lines", """
    select cast(l_orderkey as varchar) as claim_id, l_linenumber as claim_line_num, l_partkey as part, cast(l_shipdate as date) as admission_date
    from (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_shipdate) as r
          from (select l_orderkey, l_linenumber, l_partkey, l_shipdate from lineitem
                union all select l_orderkey, l_linenumber, l_partkey, l_shipdate from lineitem where l_returnflag = 'R')) where r = 1""")
def _(t):
    twice = t.lineitem.unionByName(t.lineitem.where("l_returnflag = 'R'"))  # a repeat of a line is an error, the line itself is good
    rows = twice.select(as_text("l_orderkey").alias("claim_id"), C("l_linenumber").alias("claim_line_num"), C("l_partkey").alias("part"),
                        F.to_date("l_shipdate").alias("admission_date"), F.lit(62).alias("pmd_client_id"))
    none = rows.where("false").withColumn("errorcode", F.lit(999))
    good, _ = claims.split_errors(rows, none, ("claim_id", "claim_line_num"))
    return good.select("claim_id", "claim_line_num", "part", "admission_date")


@query("orphan_count", """
    select count(*) as orphaned_measureclaims_to_date from lineitem join orders on l_orderkey = o_orderkey
    where l_partkey in (select p_partkey from part where p_type = 'PROMO')
      and not exists (select 1 from customer where c_custkey = o_custkey and c_mktsegment <> 'BUILDING')""")
def _(t):
    rows = lines(t).select(as_text("o_custkey").alias("patient_id"), F.lit(52).alias("pmd_client_id"),
                           text.pad_code("l_partkey").alias("product_service_id"))
    members = t.customer.select(as_text("c_custkey").alias("patient_id"),
                                F.when(C("c_mktsegment") == "BUILDING", 15).otherwise(52).alias("pmd_client_id"))
    codes = t.part.where("p_type = 'PROMO'").select(text.pad_code("p_partkey").alias("ndc"))
    return claims.orphaned_claims(rows, members, codes, 52)
