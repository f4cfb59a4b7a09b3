"""One row out of many: latest version, extremes, first occurrence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.text import _col
from tidewell.operators.matching import match_side, other

CHUNK = 100_000  # copies of one row that a task writes out at a time


def top1_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order.

    Spark turns ``row_number() = 1`` into a group limit that runs before the
    shuffle, so every task sends at most one row per key, also for a hot key. That
    needs a shuffle between the input and the window: for rows that were just
    joined on the same keys use ``dedup_latest``, which has no such condition.
    ``order`` should be total, or the winner among equals is open.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__place", F.row_number().over(window)).where("__place = 1").drop("__place")


def dedup_latest(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str], tie_break: Sequence[str] = ()) -> DataFrame:
    """Newest version per key; a missing date counts as newest, a missing tie-breaker as oldest.

    An aggregate: rows of a hot key shrink to one per task before any shuffle,
    and input that a join has left sorted by key is not sorted again.
    """
    rank = [part for c in latest_by for part in (F.col(c).isNull(), F.col(c))]
    rank += [F.col(c) for c in tie_break]
    names = {f"r{i}": c for i, c in enumerate(rank)}
    payload = [F.col(f"`{c}`") for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(
        F.max_by(F.struct(*payload), F.struct(*[c.alias(n) for n, c in names.items()])).alias("__row"))
    return newest.select(*[F.col(f"`{c}`") if c in keys else F.col("__row")[c].alias(c) for c in df.columns])


def extreme_per_key(df: DataFrame, keys: Sequence[str], col: str, fn: str = "max", alias: str | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(getattr(F, fn)(col).alias(alias or col))


def latest_with_ties(df: DataFrame, keys: Sequence[str], col: str | Column, fn: str = "max") -> DataFrame:
    """All rows that carry the extreme value of their key, ties kept.

    An aggregate and a semi join, not a window: any number of ties of one key may
    be spread over many tasks.
    """
    value = _col(col)
    best = df.groupBy(*keys).agg(getattr(F, fn)(value).alias("extreme"))
    side, condition = match_side(best, [*keys, (value, "extreme")])
    return df.join(side, condition, "left_semi")


def distinct_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each row once; the rows of a key come together, so that a join on the keys needn't move them again.

    For wide rows that have few copies: they move as one packed column and meet no hash table, just the row before.
    """
    rest = [c for c in df.columns if c not in keys]
    packed = df.select(*keys, F.struct(*[F.col(f"`{c}`") for c in rest]).alias("__row"))
    before = F.lag("__row").over(Window.partitionBy(*keys).orderBy("__row"))
    once = packed.withColumn("__before", before).where(~F.col("__row").eqNullSafe(F.col("__before")))
    return once.select(*[F.col(f"`{c}`") if c in keys else F.col("__row")[c].alias(c) for c in df.columns])


def mark_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), chunk: int = CHUNK) -> DataFrame:
    """Add ``is_first``: true on exactly one row of each key, the least by ``order``.

    Equal rows are counted instead of numbered, so any number of copies of a row,
    or of rows of a key, shrinks before the shuffle. The copies are written out
    again at the end, in chunks spread over tasks. Nothing depends on the order
    in which rows arrive, so a repeated task gives the same rows.
    """
    cols = df.columns
    ranked = [*order, *[c for c in cols if c not in order and c not in keys]]
    copies = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__copies"))
    least = copies.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("__least"))

    def marked(rows: DataFrame) -> DataFrame:
        side, condition = match_side(least, list(keys), null_safe=True, carry=["__least"])
        joined = rows.join(side, condition, "left")
        leads = F.struct(*ranked).eqNullSafe(other("__least"))
        more = F.col("__copies") - F.when(leads, 1).otherwise(0)
        pieces = F.array(F.when(leads, F.struct(F.lit(True).alias("is_first"), F.lit(1).cast("bigint").alias("__n"))),
                         F.when(more > 0, F.struct(F.lit(False).alias("is_first"), more.alias("__n"))))
        return joined.select(*cols, F.inline(F.array_compact(pieces)))

    def written_out(rows: DataFrame, count: Column) -> DataFrame:
        return rows.select(*cols, "is_first", F.explode(F.sequence(F.lit(1), count)).alias("__i")).drop("__i")

    few = written_out(marked(copies.where(F.col("__copies") <= chunk)), F.col("__n"))
    many = marked(copies.where(F.col("__copies") > chunk))
    last = F.floor((F.col("__n") - 1) / chunk)
    many = many.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    many = many.repartition(*cols, "__chunk")
    size = F.least(F.lit(chunk).cast("bigint"), F.col("__n") - F.col("__chunk") * chunk)
    return few.unionByName(written_out(many, size))


def split_occurrence(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(first record of each key, all further records)."""
    marked = mark_first(df, keys, df.columns)
    return marked.where("is_first").drop("is_first"), marked.where("not is_first").drop("is_first")
