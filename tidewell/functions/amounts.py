"""Amounts in text feeds: money, implied decimals and signed overpunch."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell.functions.text import _col

MONEY = "decimal(19,2)"

# Last character of an overpunched number, for digits 0 to 9.
POSITIVE_SIGNS = "{ABCDEFGHI"
NEGATIVE_SIGNS = "}JKLMNOPQR"


def typed(value: Column | str, type_name: str) -> Column:
    """Cast that gives NULL instead of failing the job on a dirty value."""
    return _col(value).try_cast(type_name)


def dirty(value: Column | str, type_name: str) -> Column:
    """True where a value is present but cannot be cast (for a reject output)."""
    return _col(value).isNotNull() & typed(value, type_name).isNull()


def money(value: Column | str) -> Column:
    """Two-digit amount from text, with or without a currency sign and commas."""
    plain = F.translate(_col(value).cast("string"), "$,", "")
    return plain.try_cast(MONEY)


def _unpacked(value: Column | str, suffix: str = "") -> Column:
    """Plain number as text, from text whose last character carries digit and sign."""
    text = F.trim(_col(value).cast("string"))
    last = F.right(text, F.lit(1))
    sign = F.when(last.isin(list(NEGATIVE_SIGNS)), "-").otherwise("")
    digit = F.translate(last, POSITIVE_SIGNS + NEGATIVE_SIGNS, "0123456789" * 2)
    return F.concat(sign, F.substring(text, F.lit(1), F.length(text) - 1), digit, F.lit(suffix))


def unpack_decimal(value: Column | str) -> Column:
    """Signed whole number from signed-overpunch text."""
    return _unpacked(value).try_cast("decimal(18,0)")


def packed_money(value: Column | str) -> Column:
    """Packed cents to money; empty text counts as zero.

    The decimal point is moved in the text, which needs one cast and no division.
    """
    amount = _unpacked(value, "E-2").try_cast(MONEY)
    return F.when(F.length(_col(value)) == 0, F.lit(0).cast(MONEY)).otherwise(amount)


def packed_quantity(value: Column | str, scale: int = 1000) -> Column:
    """Packed quantity by whole-number division; empty text counts as zero."""
    units = F.call_function("div", _unpacked(value).try_cast("bigint"), F.lit(scale).cast("bigint"))
    return F.when(F.length(_col(value)) == 0, F.lit(0.0)).otherwise(units.cast("double"))


def implied_decimal(value: Column | str, places: int = 2) -> Column:
    """Amount from plain digits with an unwritten decimal point before the last ``places``."""
    return F.concat(F.trim(_col(value).cast("string")), F.lit(f"E-{places}")).try_cast(MONEY)


def rounded(value: Column | str, n: int = 0) -> Column:
    return F.round(_col(value), n)
