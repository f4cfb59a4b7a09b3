"""Client feeds as data: columns, accepted rows, duplicates, known rows, reversals.

A client differs from another only by an entry here; the loaders in
``tidewell.plans.claims`` have no branch per client. A new client is a new entry.

A column rule is (kind, source) or (kind, source, argument); see ``RULES``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import amounts, codes, dates, text

REVERSED = 333  # fixed value: claim exception code of a reversed claim

Rule = tuple


def _source(name: str) -> Column:
    return F.col(f"`{name}`")


# Kind of a column rule to the expression it builds.
RULES = {
    "text": lambda s, n=None: text.varchar(_source(s), n) if n else _source(s).cast("string"),
    "trimmed": lambda s, n: text.left(F.trim(_source(s)), n),
    "left": lambda s, n: text.left(_source(s), n),
    "char": lambda s, n: text.char(_source(s), n),
    "code": lambda s, n=11: text.pad_code(_source(s), n),
    "long": lambda s: amounts.typed(F.trim(_source(s).cast("string")), "bigint"),
    "int": lambda s: amounts.typed(_source(s), "int"),
    "whole": lambda s: amounts.rounded(amounts.typed(_source(s), "double")).cast("int"),
    "short": lambda s: amounts.typed(_source(s), "smallint"),
    "float": lambda s: amounts.typed(_source(s), "double"),
    "date": lambda s: amounts.typed(_source(s), "date"),
    "timestamp": lambda s: amounts.typed(_source(s), "timestamp_ntz"),
    "date_or": lambda s, default=None: dates.date_or(_source(s), default),
    "midnight_or": lambda s, default=None: dates.date_or(_source(s), default).cast("timestamp_ntz"),
    "money": lambda s: amounts.money(_source(s)),
    "packed_money": lambda s: amounts.packed_money(_source(s)),
    "packed_quantity": lambda s: amounts.packed_quantity(_source(s)),
    "year": lambda s: F.year(amounts.typed(_source(s), "date")),
    "codes": lambda s, pairs: codes.map_codes(_source(s), pairs),
    "first_of": lambda s, n: text.varchar(F.coalesce(*[_source(x) for x in s]), n),
    "const": lambda value, type_name="string": F.lit(value).cast(type_name),
    "null": lambda type_name: F.lit(None).cast(type_name),
}

# Kind of an accept rule to the predicate it builds.
TESTS = {
    "is": lambda s, v: text.eq_ci(_source(s), v, strip=True),
    "is_not": lambda s, v: F.lower(F.trim(F.coalesce(_source(s), F.lit("")))) != v.lower(),
    "in": lambda s, v: text.in_set(_source(s), v),
    "filled": lambda s: _source(s).isNotNull(),
    "longer": lambda s, n: text.present(_source(s), n + 1),
}


def build(rule: Rule) -> Column:
    kind, *arguments = rule
    return RULES[kind](*arguments)


def sources(rule: Rule) -> list[str]:
    """Raw columns that a rule reads."""
    kind, *arguments = rule
    if kind in ("const", "null"):
        return []
    return list(arguments[0]) if kind == "first_of" else [arguments[0]]


# Kinds of rules that read a typed value, and its type.
READ_AS = {"long": "bigint", "int": "int", "whole": "double", "short": "smallint", "float": "double", "date": "date",
           "timestamp": "timestamp_ntz"}


def dirty_cells(columns: Mapping[str, Rule]) -> dict[str, Column]:
    """Per typed column: a value is there and can't be read."""
    return {name: amounts.dirty(F.trim(_source(rule[1]).cast("string")), READ_AS[rule[0]])
            for name, rule in columns.items() if rule[0] in READ_AS}


def accept(df: DataFrame, tests: tuple) -> DataFrame:
    return df.where(reduce(and_, [TESTS[kind](*arguments) for kind, *arguments in tests]))


def standardize(df: DataFrame, columns: Mapping[str, Rule]) -> DataFrame:
    """One projection from a raw feed to the canonical schema."""
    return df.select(*[build(rule).alias(name) for name, rule in columns.items()])


@dataclass(frozen=True)
class Reversal:
    """Which raw rows reverse which loaded claims."""

    tests: tuple
    key: str  # raw column that names the reversed claim
    until: date | None = None  # service date up to and including
    after: date | None = None  # service date later than
    in_year: str | None = None  # raw date column that must lie in the run year
    min_sequence: str | None = None  # raw sequence column; least one must equal the stored one
    only_open: bool = False  # leave claims alone that have a code already


@dataclass(frozen=True)
class PharmacyFeed:
    client_id: int
    columns: Mapping[str, Rule]
    tests: tuple
    transaction: str
    drug_code: str
    padded_lookup: bool = False
    dedup: str = "distinct"  # or "min_sequence", "latest"
    sequence: str | None = None
    latest_by: Mapping[str, Rule] = field(default_factory=dict)
    known_by_year: bool = True
    nulls_match: bool = False
    drop_later_than: tuple | None = None  # accept rules of the stored-sequence clean-up
    service_date: str = "date_of_service"
    reversals: tuple[Reversal, ...] = ()
    account_from_period: bool = False


_MEASURED_52 = (("is", "medicare_part_d", "y"), ("filled", "patient_id"),
                ("in", "patient_gender", ("1", "2", "F", "M")), ("longer", "ndc_code", 1))

# Source columns, widths and codes of each client's feed.
PHARMACY_FEEDS = {
    52: PharmacyFeed(
        client_id=52,
        transaction="transaction_id",
        drug_code="ndc_code",
        padded_lookup=True,
        tests=(*_MEASURED_52, ("is", "transaction_status", "p")),
        dedup="min_sequence",
        sequence="seq_num",
        known_by_year=False,
        nulls_match=True,
        drop_later_than=(*_MEASURED_52, ("is", "transaction_status", "p")),
        columns={
            "transaction_id": ("text", "transaction_id"),
            "pmd_pclaim_id": ("long", "transaction_id"),
            "pmd_client_id": ("const", 52, "bigint"),
            "medicare_part_d_ind": ("text", "medicare_part_d", 1),
            "patient_id": ("text", "patient_id"),
            "cardholder_id": ("text", "patient_id"),
            "patient_dob": ("date", "patient_dob"),
            "cardholder_dob": ("date", "patient_dob"),
            "date_of_service": ("timestamp", "date_of_service"),
            "product_service_id": ("code", "ndc_code"),
            "product_service_desc": ("text", "product_service_name", 70),
            "quantity_dispensed": ("float", "quantity_dispensed"),
            "days_supply": ("int", "days_supply"),
            "prescriber_id": ("text", "prescriber_npi", 50),
            "pharmacy_id": ("text", "pharmacy_npi", 50),
            "adjudication_date": ("date_or", "adjudication_date"),
            "administrative_fee_amt": ("money", "admin_fee"),
            "ingredient_cost": ("money", "ingredient_cost"),
            "dispensing_fee": ("money", "disp_fee"),
            "total_sales_tax": ("money", "sales_tax"),
            "drgmtch": ("const", ""),
            "compositionname": ("text", "medstaken", 50),
            "formattedpackageidentifier": ("text", "ndc_code"),
            "accountid": ("const", "H0251"),
            "accountid2": ("const", "H0251"),
            "prescription_service_reference_num": ("text", "prescription_num", 50),
            "paired_adjustment_sequence_num": ("text", "seq_num", 10),
        },
        reversals=(Reversal(
            tests=(*_MEASURED_52, ("is", "transaction_status", "x")),
            key="transaction_id", in_year="date_of_service", min_sequence="seq_num"),),
    ),
    15: PharmacyFeed(
        client_id=15,
        transaction="transactionclaimid",
        drug_code="ndc",
        nulls_match=True,
        service_date="datefilled",
        tests=(("is", "medicareddrug", "y"), ("filled", "cardholderidpersoncd"), ("filled", "datefilled"),
               ("in", "transactiontypecd", ("31",)),
               ("in", "plantype2", ("3000", "4000", "4500", "5000", "8000"))),
        columns={
            "pmd_pclaim_id": ("long", "transactionclaimid"),
            "pmd_client_id": ("const", 15, "bigint"),
            "medicare_part_d_ind": ("text", "medicareddrug", 1),
            "patient_id": ("text", "cardholderidpersoncd", 50),
            "patient_dob": ("date", "mbrdob"),
            "date_of_service": ("timestamp", "datefilled"),
            "prescription_origin_code": ("int", "prescriptionorigincd"),
            "product_service_id": ("code", "ndc"),
            "product_service_desc": ("text", "drugname", 70),
            "gcn_num": ("text", "genericcd", 6),
            "gpi_code": ("char", "gpi", 14),
            "quantity_dispensed": ("packed_quantity", "qtydispensed"),
            "days_supply": ("int", "dayssupply"),
            "drug_strength": ("text", "drugstrength", 15),
            "prescriber_id": ("text", "prescribernpi", 50),
            "pharmacy_id": ("text", "pharmacynpi", 50),
            "transaction_id": ("text", "transactionclaimid", 100),
            "adjudication_date": ("date_or", "adjudicationdate"),
            "transaction_status": ("text", "recordidentifier", 2),
            "administrative_fee_amt": ("packed_money", "adminfee"),
            "usual_customary": ("packed_money", "ucamt"),
            "ingredient_cost": ("packed_money", "calcingredientcost"),
            "dispensing_fee": ("packed_money", "dispensingfee"),
            "total_sales_tax": ("packed_money", "taxamt"),
            "gross_cost": ("packed_money", "amtbilled"),
            "other_payer_amt_paid": ("packed_money", "otherpayoramt"),
            "drgmtch": ("const", ""),
            "compositionname": ("text", "medstaken", 50),
            "formattedpackageidentifier": ("text", "ndc"),
            "accountid2": ("codes", "plantype2",
                           {("3000", "4000", "4500", "8000"): "H5425", "5000": "H5943"}),
            "prescription_service_reference_num": ("text", "prescriptionnumber9", 50),
            "lis_subsidy_amt": ("packed_money", "licssubsidyamt"),
        },
        reversals=(Reversal(
            tests=(("in", "transactiontypecd", ("32",)), ("is", "medicareddrug", "y"),
                   ("filled", "cardholderidpersoncd")),
            key="xreftransactionid", only_open=True),),
    ),
    69: PharmacyFeed(
        client_id=69,
        transaction="authnumber",
        drug_code="ndc",
        nulls_match=True,
        service_date="datefilled",
        tests=(("is_not", "reversal", "r"),),
        columns={
            "pmd_pclaim_id": ("const", 0, "bigint"),
            "pmd_client_id": ("const", 69, "bigint"),
            "medicare_part_d_ind": ("const", "D"),
            "patient_id": ("text", "memberid", 50),
            "cardholder_id": ("null", "string"),
            "patient_dob": ("date", "memberdob"),
            "date_of_service": ("timestamp", "datefilled"),
            "product_service_id": ("code", "ndc"),
            "product_service_desc": ("text", "productdesc", 70),
            "quantity_dispensed": ("float", "metricqty"),
            "days_supply": ("whole", "dayssupply"),
            "prescriber_id": ("text", "prescriber_npi_nbr", 50),
            "pharmacy_id": ("text", "pharmcacy_npi_nbr", 50),
            "transaction_id": ("trimmed", "authnumber", 100),
            "adjudication_date": ("null", "date"),
            "drgmtch": ("const", ""),
            "compositionname": ("trimmed", "medstaken", 4000),
            "formattedpackageidentifier": ("trimmed", "ndc", 4000),
            "accountid": ("left", "groupnumber", 5),
            "accountid2": ("left", "groupnumber", 5),
            "prescription_service_reference_num": ("text", "rxnumber"),
        },
        reversals=(Reversal(tests=(("is", "reversal", "r"),), key="authnumber"),),
    ),
    62: PharmacyFeed(
        client_id=62,
        transaction="transaction_id",
        drug_code="ndc_code",
        tests=(("is", "transaction_status", "p"), ("is", "medicare_park_d", "yes")),
        dedup="latest",
        latest_by={"__adjudicated": ("date", "adjudication_date"),
                   "__filed": ("text", "file_date"), "__updated": ("timestamp", "update_datetime")},
        columns={
            "pmd_pclaim_id": ("long", "transaction_id"),
            "pmd_client_id": ("const", 62, "bigint"),
            "medicare_part_d_ind": ("const", "D"),
            "patient_id": ("text", "patient_id", 50),
            "cardholder_id": ("text", "cardholder_id", 50),
            "patient_dob": ("date", "patient_dob"),
            "cardholder_dob": ("date", "patient_dob"),
            "date_of_service": ("timestamp", "date_of_service"),
            "product_service_id": ("code", "ndc_code"),
            "product_service_desc": ("text", "productnameshort", 70),
            "quantity_dispensed": ("float", "quantity_dispensed"),
            "days_supply": ("int", "days_supply"),
            "prescriber_id": ("text", "prescriber_npi", 50),
            "pharmacy_id": ("text", "pharmacy_npi", 50),
            "transaction_id": ("trimmed", "transaction_id", 100),
            "adjudication_date": ("date", "adjudication_date"),
            "administrative_fee_amt": ("money", "admin_fee"),
            "usual_customary": ("money", "usual_customary"),
            "ingredient_cost_submitted": ("money", "ingredient_cost_submitted"),
            "ingredient_cost": ("money", "ingredient_cost"),
            "dispensing_fee": ("money", "disp_fee"),
            "total_sales_tax": ("money", "sales_tax"),
            "drgmtch": ("const", ""),
            "compositionname": ("trimmed", "medstaken", 4000),
            "formattedpackageidentifier": ("trimmed", "ndc_code", 4000),
            "accountid": ("const", ""),
            "accountid2": ("const", ""),
            "prescription_service_reference_num": ("text", "prescription_num"),
        },
        reversals=(Reversal(
            tests=(("is", "transaction_status", "r"), ("is", "medicare_park_d", "yes")), key="client_def_1"),),
        account_from_period=True,
    ),
    67: PharmacyFeed(
        client_id=67,
        transaction="transaction_id",
        drug_code="ndc_code",
        tests=(("is", "transaction_status", "paid"),),
        columns={
            "pmd_pclaim_id": ("long", "transaction_id"),
            "pmd_client_id": ("const", 67, "bigint"),
            "medicare_part_d_ind": ("const", "D"),
            "patient_id": ("text", "patient_id", 50),
            "cardholder_id": ("null", "string"),
            "patient_dob": ("null", "date"),
            "date_of_service": ("timestamp", "date_of_service"),
            "product_service_id": ("code", "ndc_code"),
            "product_service_desc": ("text", "productnameshort", 70),
            "quantity_dispensed": ("float", "quantity_dispensed"),
            "days_supply": ("whole", "days_supply"),
            "prescriber_id": ("text", "prescriber_npi", 50),
            "pharmacy_id": ("text", "pharmacy_npi", 50),
            "transaction_id": ("trimmed", "transaction_id", 100),
            "adjudication_date": ("null", "date"),
            "drgmtch": ("const", ""),
            "compositionname": ("trimmed", "medstaken", 4000),
            "formattedpackageidentifier": ("trimmed", "ndc_code", 4000),
            "accountid": ("text", "plan_code"),
            "accountid2": ("text", "plan_code"),
            "prescription_service_reference_num": ("text", "prescription_num"),
        },
        reversals=(
            Reversal(tests=(("is", "transaction_status", "reversal"),), key="reversed_claim_id",
                     until=date(2016, 9, 1)),
            Reversal(tests=(("is", "transaction_status", "reversal"),), key="transaction_id",
                     after=date(2016, 9, 1)),
        ),
    ),
}


@dataclass(frozen=True)
class MedicalFeed:
    client_id: int
    columns: Mapping[str, Rule]
    claim: str
    line: str
    plan: str
    status: str
    submitted: str


_NO_DATE = date(1900, 1, 1)  # fixed value: stands for an unreadable date

# Source columns and widths of the medical claim-line feed.
MEDICAL_FEEDS = {
    62: MedicalFeed(
        client_id=62,
        claim="claim id",
        line="claim line number",
        plan="plan code",
        status="claim status",
        submitted="claim submit date",
        columns={
            "pmd_client_id": ("const", 62, "int"),
            "plan_code": ("left", "plan code", 5),
            "bill_type": ("text", "bill type", 4),
            "claim_id": ("text", "claim id", 50),
            "claim_type": ("text", "claim type", 2),
            "claim_line_num": ("long", "claim line number"),
            "place_of_service": ("text", "place of service", 2),
            "claim_status": ("short", "claim status"),
            "claim_submit_date": ("date", "claim submit date"),
            "admission_date": ("midnight_or", "admission date", _NO_DATE),
            "admission_type": ("short", "admission type"),
            "discharge_date": ("date_or", "discharge date", _NO_DATE),
            "discharge_status": ("text", "discharge status", 2),
            "patient_id": ("text", "patient id", 50),
            "patient_id_qual": ("text", "patient id qual", 2),
            "servicing_provider_npi": ("text", "servicing provider npi", 10),
            "facility_npi": ("first_of", ("facility npi", "servicing provider npi"), 10),
            "dx_code_admitting": ("text", "dx code admitting", 7),
            "dx_code_principal": ("text", "dx code principal", 7),
            **{f"dx_code_{n}": ("text", f"dx code {n}", 7) for n in range(2, 19)},
            "icd_proc_code_principal": ("text", "idc proc code prinicipal", 7),
            **{f"icd_proc_code_{n}": ("text", f"idc proc code {n}", 7) for n in range(2, 7)},
            "type_of_service": ("text", "type of service", 3),
            "revenue_code": ("text", "revenue code", 4),
            "procedure_date": ("date_or", "procedure date", _NO_DATE),
            "procedure_code": ("text", "procedure code", 5),
            "procedure_mod_code_1": ("text", "procedure mode code 1", 2),
            **{f"procedure_mod_code_{n}": ("text", f"procedure mode code_{n}", 2) for n in range(2, 5)},
            "unit_qty": ("int", "unit qty"),
            **{f"filler{n}": ("text", f"client def {n}", 25) for n in range(1, 4)},
            "runyear": ("int", "runyear"),
        },
    ),
}


@dataclass(frozen=True)
class MembershipFeed:
    """Member file that gives plan-benefit periods."""

    client_id: int
    member: str
    start: str
    end: str
    tests: tuple
    plan: Rule
    benefit: Rule


# Source columns of the member files.
MEMBERSHIP_FEEDS = {
    52: MembershipFeed(52, member="unique_patient_id", start="mbr_plan_eff_dt", end="dsenrl_dt",
                       tests=(("longer", "account_code", 0),),
                       plan=("const", "H0251"), benefit=("text", "account_code")),
    62: MembershipFeed(62, member="patientid", start="patient_effdate", end="prgm_term_date",
                       tests=(("filled", "plan_code"),),
                       plan=("left", "plan_code", 5), benefit=("right", "plan_code", 3)),
    69: MembershipFeed(69, member="patient_id", start="patient_effective_date", end="patient_term_date",
                       tests=(("longer", "account_code", 0),),
                       plan=("left", "group_code", 5), benefit=("blank_to", "account_code", "none")),
}
RULES["right"] = lambda s, n: text.right(_source(s), n)
RULES["blank_to"] = lambda s, sentinel: text.blank_to(_source(s), sentinel)

# Clients of the dispatch table. Where no feed entry exists above, only
# the id is known; its loader enters as configuration.
CLIENT_IDS = (15, 30, 52, 54, 56, 62, 63, 66, 67, 69, 73, 75, 76, 77, 78, 81, 82, 83, 84,
              85, 87, 88, 89, 90, 91, 92, 94, 95, 96)
