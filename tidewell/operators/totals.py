"""Aggregations. All of them combine on the map side before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.text import _col


def collapse(df: DataFrame, max_cols: Sequence[str]) -> DataFrame:
    """Group by every other column and keep the greatest of ``max_cols``."""
    keys = [c for c in df.columns if c not in max_cols]
    grouped = df.groupBy(*[F.col(f"`{c}`") for c in keys])
    out = grouped.agg(*[F.max(F.col(f"`{c}`")).alias(c) for c in max_cols])
    return out.select(*[F.col(f"`{c}`") for c in df.columns])


def count_of_counts(df: DataFrame, keys: Sequence[str], item: str, alias: str = "n_items") -> DataFrame:
    """Number of different items per key, counted in two steps."""
    items = df.groupBy(*keys, item).agg(F.count(F.lit(1)).alias("n_rows"))
    return items.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def regroup(df: DataFrame, first_keys: Sequence[str], second_keys: Mapping[str, Column], col: str, fn: str = "max") -> DataFrame:
    """Aggregate, derive coarser keys from the result, aggregate again."""
    agg = getattr(F, fn)
    inner = df.groupBy(*first_keys).agg(agg(col).alias(col))
    outer = inner.select(*[c.alias(n) for n, c in second_keys.items()], F.col(col))
    return outer.groupBy(*second_keys).agg(agg(col).alias(col))


def join_rows(df: DataFrame, text: Column | str, sep: str, order: Sequence[str], alias: str = "joined") -> DataFrame:
    """All rows as one text, in a given order. For report tables of a few rows only."""
    ordering = ", ".join(f"`{c}`" for c in order)
    quoted = sep.replace("'", "\\'")
    named = df.withColumn("__text", _col(text))
    return named.agg(F.expr(f"listagg(__text, '{quoted}') within group (order by {ordering})").alias(alias))


def row_count(df: DataFrame, alias: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def max_or(df: DataFrame, col: str | Column, default, alias: str = "value") -> DataFrame:
    """One row with the greatest value, or the default for an empty table."""
    return df.agg(F.coalesce(F.max(_col(col)), F.lit(default)).alias(alias))


def scalar(df: DataFrame, agg: Column) -> Column:
    """Whole-table aggregate as a scalar subquery, inside the plan."""
    return df.agg(agg.alias("value")).scalar()


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Union by column name with one duplicate removal at the end."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out.distinct()
