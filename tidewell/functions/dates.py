"""Date expressions. Years are tested as ranges so that filters reach the scan."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell.functions.text import _col

DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "yyyyMMdd")


def moment(value: datetime | date) -> Column:
    """Wall-clock literal, the same in every session time zone."""
    if not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def first_day(year: int) -> date:
    return date(year, 1, 1)


def year_start(year: int) -> Column:
    return F.lit(first_day(year))


def year_end(year: int) -> Column:
    return F.lit(date(year, 12, 31))


def year(value: Column | str) -> Column:
    return F.year(_col(value))


def in_year(value: Column | str, wanted: int) -> Column:
    """Date or timestamp lies in the year; a plain range, so it is pushed down."""
    col = _col(value)
    return (col >= F.lit(date(wanted, 1, 1))) & (col < F.lit(date(wanted + 1, 1, 1)))


def cutover(value: Column | str, day: date, inclusive_old: bool = True) -> tuple[Column, Column]:
    """Predicates (old rule, new rule) around a change-over moment."""
    col, change = _col(value), moment(day)
    return (col <= change, col > change) if inclusive_old else (col < change, col >= change)


def day_of_year(value: Column | str) -> Column:
    return F.dayofyear(_col(value))


def supply_end(start: Column | str, days: Column | str) -> Column:
    """Last day a fill covers."""
    return F.date_add(F.to_date(_col(start)), _col(days).cast("int") - 1)


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(_col(later), _col(earlier))


# What may stand behind a date: nothing, or a time of day with or without a zone.
TIME_OF_DAY = r"^$|^[ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?( ?(Z|UTC|[AaPp][Mm]|[+-]\d{1,2}:?\d{0,2}))?$"


def _as_iso(text: Column, layout: str) -> tuple[Column, Column]:
    """Does the text have the layout's separators and nothing but a time behind, and its parts in ISO order."""
    fits = F.rlike(F.substring(text, len(layout) + 1, 64), F.lit(TIME_OF_DAY)) & (F.length(text) >= len(layout))
    for place, sign in enumerate(layout):
        if not sign.isalpha():
            fits = fits & (F.substring(text, place + 1, 1) == sign)
    part = {name: F.substring(text, layout.index(name) + 1, len(name)) for name in ("yyyy", "MM", "dd")}
    return fits, F.concat_ws("-", part["yyyy"], part["MM"], part["dd"])


def date_or(value: Column | str, default=None, formats=DATE_FORMATS) -> Column:
    """Date in the first layout that the text fits, else ``default`` (NULL when not given).

    Dates and timestamps are taken as they are; in a text a time of day may follow,
    and a month or day of one digit counts as padded. Parts are put in ISO order and
    cast once; a cast that fails gives NULL at no cost, where a parser would raise an
    exception for every unreadable row.
    """
    text, iso = F.trim(_col(value).cast("string")), None
    text = F.regexp_replace(text, r"(?<=^|[/-])(\d)(?=[/-]|$|[ T])", "0$1")
    for layout in formats:
        fits, ordered = _as_iso(text, layout)
        iso = F.when(fits, ordered) if iso is None else iso.when(fits, ordered)
    last = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(iso.try_cast("date"), last.cast("date"))


def completed_age(birth: Column | str, as_of: Column | date) -> Column:
    """Whole years lived; a 29 February birthday falls on 28 February otherwise."""
    born = _col(birth).cast("date")
    today = as_of if isinstance(as_of, Column) else F.lit(as_of)
    years = F.year(today) - F.year(born)
    birthday = F.add_months(born, years * 12)
    return years - F.when(today < birthday, 1).otherwise(0)


def to_local(value: Column | str, tz: str) -> Column:
    """UTC wall time to the wall time of ``tz``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _col(value).cast("timestamp_ntz"))


def day_key(value: Column | str) -> Column:
    return F.to_date(_col(value))


def clamp_period(start: Column | str, end: Column | str, run_year: int) -> tuple[Column, Column]:
    """Fit a period into the run year.

    An end after the year moves to 31 December. A start before the year moves to
    1 January only when the moved end lies in the year, so a period that ended
    earlier keeps its start.
    """
    start, end = _col(start), _col(end)
    new_end = F.when(end > year_end(run_year), year_end(run_year)).otherwise(end)
    begins_before = start < year_start(run_year)
    ends_inside = (new_end >= year_start(run_year)) & (new_end <= year_end(run_year))
    new_start = F.when(begins_before & ends_inside, year_start(run_year)).otherwise(start)
    return new_start, new_end
