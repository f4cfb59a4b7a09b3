"""Code maps, column choice and age bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell.functions.text import _col

# Labels of the age bands; the position is the sort key.
AGE_BANDS = (
    "0 - tens", "teens", "twenties", "thirties", "forties",
    "fifties", "sixties", "seventies", "eighties", "ninety_andabove",
)
NO_BIRTH_DATE = ("nodob", 999)


def map_codes(value: Column | str, pairs: Mapping, default=None) -> Column:
    """Translate codes; a key may be a tuple of codes that share one result."""
    col, out = _col(value), None
    for codes, result in pairs.items():
        codes = codes if isinstance(codes, tuple) else (codes,)
        test = col.isin(list(codes))
        out = F.when(test, F.lit(result)) if out is None else out.when(test, F.lit(result))
    return out.otherwise(F.lit(default)) if default is not None else out


def pick(value: Column | str, listed: Sequence, when_listed: Column, otherwise: Column) -> Column:
    """Take one of two columns by whether a discriminator is in a list."""
    return F.when(_col(value).isin(list(listed)), when_listed).otherwise(otherwise)


def recode_missing_detail(status: Column | str, detail: Column | str, status_value: int = 2) -> Column:
    """A given status without a detail counts as detail 0."""
    gap = (_col(status) == status_value) & _col(detail).isNull()
    return F.when(gap, F.lit(0)).otherwise(_col(detail))


def age_band_sort(birth: Column | str, as_of: date) -> Column:
    """Band number from the difference of calendar years (not completed years)."""
    years = F.lit(as_of.year) - F.year(_col(birth))
    band = F.when(years <= 10, 0).when(years >= 90, 9).otherwise(F.floor(years / 10))
    return F.coalesce(band, F.lit(NO_BIRTH_DATE[1])).cast("int")


def age_band(birth: Column | str, as_of: date) -> Column:
    """Label of the band, or the label for a missing birth date."""
    band = age_band_sort(birth, as_of)
    labels = F.array(*[F.lit(label) for label in AGE_BANDS])
    return F.coalesce(F.get(labels, band), F.lit(NO_BIRTH_DATE[0]))
