"""Text expressions and the predicates built on them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Three-digit starts that mark a phone number as a placeholder.
INVALID_PHONE_STARTS = (
    "999", "111", "222", "333", "444", "555", "666", "777", "888", "123", "000",
)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def left(value: Column | str, n: int) -> Column:
    return F.left(_col(value), F.lit(n))


def right(value: Column | str, n: int) -> Column:
    return F.right(_col(value), F.lit(n))


def trim(value: Column | str) -> Column:
    return F.trim(_col(value))


def lower(value: Column | str) -> Column:
    return F.lower(_col(value))


def upper(value: Column | str) -> Column:
    return F.upper(_col(value))


def length(value: Column | str) -> Column:
    return F.length(_col(value))


def varchar(value: Column | str, n: int) -> Column:
    """Cast to text of at most ``n`` characters (Spark's own cast does not cut)."""
    return left(_col(value).cast("string"), n)


def char(value: Column | str, n: int) -> Column:
    """Fixed-width text, padded with blanks on the right."""
    return F.rpad(varchar(value, n), n, " ")


def pad_code(value: Column | str, width: int = 11) -> Column:
    """Zero-pad on the left and keep the right end; ``lpad`` would keep the left end."""
    padded = F.concat(F.lit("0" * width), _col(value).cast("string"))
    return right(padded, width)


def concat_skip_null(*values: Column | str) -> Column:
    """Concatenate, treating NULL as empty text."""
    return F.concat_ws("", *[_col(v) for v in values])


def starts_with(value: Column | str, prefix: str) -> Column:
    return _col(value).startswith(prefix)


def name_hash(*values: Column | str, sep: str = "") -> Column:
    """MD5 of the joined names.

    Without a separator ("AB", "C") and ("A", "BC") give the same id; pass one
    where ids need not agree with earlier ones.
    """
    return F.md5(F.concat_ws(sep, *[_col(v) for v in values]))


def row_id(*values: Column | str) -> Column:
    """Stable row id, in place of a random one."""
    parts = [F.coalesce(_col(v).cast("string"), F.lit("\u0000")) for v in values]
    return F.sha2(F.concat_ws("\u0001", *parts), 256)


def blank_to(value: Column | str, sentinel) -> Column:
    """Replace empty text by ``sentinel``; NULL stays NULL."""
    return F.when(length(value) == 0, F.lit(sentinel)).otherwise(_col(value))


# ---- predicates ---------------------------------------------------------------

def eq_ci(value: Column | str, wanted: str, strip: bool = False) -> Column:
    """Equality without regard to case; ``strip`` also drops outer blanks."""
    side = trim(value) if strip else _col(value)
    return F.lower(side) == F.lit(wanted.lower())


def in_set(value: Column | str, values: Iterable) -> Column:
    return _col(value).isin(list(values))


def in_ci(value: Column | str, values: Iterable[str]) -> Column:
    return F.lower(_col(value)).isin([v.lower() for v in values])


def present(value: Column | str, min_len: int = 1) -> Column:
    """Not NULL and at least ``min_len`` characters long."""
    return F.coalesce(length(value) >= min_len, F.lit(False))


def between(value: Column | str, low, high) -> Column:
    return _col(value).between(low, high)


def valid_phone(value: Column | str, min_len: int = 10) -> Column:
    """False for NULL, too short or placeholder numbers; never NULL itself."""
    phone = _col(value)
    placeholder = left(phone, 3).isin(list(INVALID_PHONE_STARTS))
    return F.coalesce(~placeholder & (F.length(F.trim(phone)) >= min_len), F.lit(False))
