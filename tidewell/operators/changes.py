"""Changes to tables as functions from the old state to the new one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.text import _col
from tidewell.operators.matching import (
    Key, as_of_period, match_side, one_per_key, only_new, other,
)


def _old(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None)


def changed_keys(before: DataFrame, after: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Keys whose rows (by ``cols``, as a multiset) differ between two states of a table, each once.

    Each state is reduced to one short row per key before it moves: the number of rows and two sums of their hash.
    """
    def digests(df: DataFrame, mark: str) -> DataFrame:
        value = F.xxhash64(*[part for c in cols for part in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])
        low, high = value.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftright(value, 32)
        sums = df.groupBy(F.col(f"`{key}`").alias(key)).agg(
            F.count(F.lit(1)).alias("n"), F.sum(low).alias("low"), F.sum(high).alias("high"))
        return sums.select(key, F.struct("n", "low", "high").alias(mark))

    both = digests(before, "__before").unionByName(digests(after, "__after"), allowMissingColumns=True)
    one = both.groupBy(key).agg(F.first("__before", ignorenulls=True).alias("__before"), F.first("__after", ignorenulls=True).alias("__after"))
    return one.where(~F.col("__before").eqNullSafe(F.col("__after"))).select(key)


def carry_over(previous: DataFrame, fresh: DataFrame, changed: DataFrame, key: str) -> DataFrame:
    """Rows of ``previous`` whose key is not among the changed ones, and the ``fresh`` rows made for those."""
    kept = only_new(previous, changed, [key], null_safe=True)
    return kept.unionByName(fresh.select(*[F.col(f"`{c}`") for c in previous.columns]))


def with_marker(df: DataFrame, ids: DataFrame, keys: Sequence[Key], name: str, null_safe: bool = False) -> DataFrame:
    """Add a boolean column: the row's key occurs in ``ids``."""
    side, condition = match_side(ids, keys, null_safe)
    side = side.distinct().withColumn(name, F.lit(True))
    joined = df.join(side, condition, "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.col(name).isNotNull().alias(name))


def assign(df: DataFrame, condition: Column, values: Mapping) -> DataFrame:
    """Set columns where the condition holds; all other rows keep theirs."""
    new = {}
    for name, value in values.items():
        value = value if isinstance(value, Column) else F.lit(value)
        new[name] = F.when(condition, value).otherwise(_old(df, name))
    return df.withColumns(new)


def flag_matched(df: DataFrame, ids: DataFrame, keys: Sequence[Key], values: Mapping,
                 scope: Column | None = None) -> DataFrame:
    """Set ``values`` on the rows in scope whose key occurs in ``ids``."""
    marked = with_marker(df, ids, keys, "__hit")
    condition = F.col("__hit") if scope is None else F.col("__hit") & F.coalesce(scope, F.lit(False))
    return assign(marked, condition, values).drop("__hit")


def delete_matched(df: DataFrame, second: DataFrame, keys: Sequence[Key], residual: Column | None = None,
                   carry: Sequence[str] = ()) -> DataFrame:
    """Drop rows with a partner that also meets the residual condition."""
    side, condition = match_side(second, keys, carry=carry)
    return df.join(side, condition if residual is None else condition & residual, "left_anti")


def update_from(df: DataFrame, source: DataFrame, keys: Sequence[Key], cols: Mapping[str, str],
                scope: Column | None = None, reset: bool = False, order: Sequence[str] = (),
                unique: bool = False, also: Mapping | None = None) -> DataFrame:
    """Copy ``cols`` (target name to source name) from the matching source row.

    The source is first cut to one row per key, the greatest by ``order``, unless
    ``unique`` says that it has no more. A matched NULL is copied. With ``reset`` rows
    in scope without a match become NULL. ``also`` gives further values for the rows
    that are set, such as the time of the update. One left join, one pass.
    """
    right_keys = [k[1] if isinstance(k, tuple) else k for k in keys]
    wanted = list(dict.fromkeys(cols.values()))
    slim = source.select(*dict.fromkeys([*right_keys, *wanted])) if unique else one_per_key(source, right_keys, wanted, order=order)
    slim = slim.withColumn("__matched", F.lit(True))
    side, condition = match_side(slim, keys, carry=[*wanted, "__matched"])
    joined = df.join(side, condition, "left")
    hit = F.lit(True) if reset else other("__matched").isNotNull()
    if scope is not None:
        hit = hit & F.coalesce(scope, F.lit(False))
    also = also or {}
    out = [F.col(f"`{c}`") for c in df.columns if c not in cols and c not in also]
    new = [F.when(hit, other(src)).otherwise(_old(df, name)).alias(name) for name, src in cols.items()]
    new += [F.when(hit, value).otherwise(_old(df, name)).alias(name) for name, value in also.items()]
    final = joined.select(*out, *new)
    names = list(dict.fromkeys([*df.columns, *cols, *also]))
    return final.select(*[F.col(f"`{c}`") for c in names])


def fill_blank_from_period(df: DataFrame, periods: DataFrame, key: str, at: str, start: str, end: str,
                           target: str, source: str, scope: Column | None = None,
                           transform=lambda c: c, also: Mapping | None = None) -> DataFrame:
    """Fill an empty column from the period that covers the row's day.

    Only rows in scope whose column is empty are joined; the others pass by. ``also``
    gives further values for the rows that are filled.
    """
    spans = periods.withColumn("__fill", transform(F.col(source))).select(key, start, end, "__fill")
    blank = F.length(F.coalesce(F.col(target), F.lit(""))) == 0
    if scope is not None:
        blank = blank & F.coalesce(scope, F.lit(False))
    placed = as_of_period(df.where(blank), spans, key, at, start, end, ["__fill"])
    filled = assign(placed, F.col("__fill").isNotNull(), {target: F.col("__fill"), **(also or {})}).drop("__fill")
    return filled.unionByName(df.where(~blank), allowMissingColumns=True)


def refresh_flag(df: DataFrame, scope_ids: DataFrame, set_ids: DataFrame, key: str, flag: str,
                 gate: Column | None = None, open_rows: Column | None = None) -> DataFrame:
    """Reset a flag and set it again, in one pass.

    Open rows of ``scope_ids`` get true when the key is also in ``set_ids`` and
    false when not; every other row, or every row when the gate is closed, keeps
    its value.
    """
    scope = scope_ids.select(key).distinct().withColumn("__in_set", F.lit(False))
    wanted = set_ids.select(key).distinct().withColumn("__in_set", F.lit(True))
    state = scope.unionByName(wanted).groupBy(key).agg(
        F.max("__in_set").alias("__value"), F.min("__in_set").alias("__least"))
    state = state.where(~F.col("__least")).select(key, "__value")  # only keys in scope
    side, condition = match_side(state, [key], carry=["__value"])
    joined = df.join(side, condition, "left")
    hit = other("__value").isNotNull()
    if open_rows is not None:
        hit = hit & open_rows
    if gate is not None:
        hit = hit & gate
    return assign(joined, hit, {flag: other("__value")}).select(
        *[F.col(f"`{c}`") for c in dict.fromkeys([*df.columns, flag])])


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
           insert_values: Mapping | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Update matched rows and add the others; the source is made unique first.

    Of several source rows of a key the greatest by ``order`` wins, then by the other
    columns by name, so the order of the columns doesn't matter.
    A source row with a NULL key matches nothing and is added. A left join plus
    an anti join, both of which AQE can split for a hot key (a full outer join it
    cannot).
    """
    rest = sorted(c for c in source.columns if c not in keys)
    keyed = reduce(and_, [F.col(k).isNotNull() for k in keys])
    unique = one_per_key(source.where(keyed), keys, rest, order=order)
    updated = update_from(target, unique, list(keys), {c: c for c in update_cols}, unique=True)
    added = only_new(unique, target, list(keys)).unionByName(source.where(~keyed).distinct())
    for name, value in (insert_values or {}).items():
        added = added.withColumn(name, value if isinstance(value, Column) else F.lit(value))
    return updated.unionByName(added, allowMissingColumns=True)


def exclude_keys(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Drop rows of listed keys; rows without a key stay."""
    if not values:
        return df
    return df.where(F.coalesce(~_col(col).isin(list(values)), F.lit(True)))


def open_rows(df: DataFrame, end: str = "end_date") -> DataFrame:
    return df.where(F.col(end).isNull())


def not_reversed(df: DataFrame, code: str = "claimexccd") -> DataFrame:
    return df.where(F.col(code).isNull())
