"""Joins by meaning: new rows, matching rows, lookups, periods.

No join here carries a broadcast hint but that of a key filter, which has a bounded size. Spark broadcasts a side by the size it finds
at run time; beyond its bound the join shuffles, and AQE splits a partition that one
key has made too large.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.text import _col

Key = str | tuple[str | Column, str | Column]

_OTHER = "__other_"


def other(name: str) -> Column:
    """Column of the second table inside a residual condition."""
    return F.col(_OTHER + name)


def match_side(second: DataFrame, keys: Sequence[Key], null_safe: bool = False,
               carry: Sequence[str] = ()) -> tuple[DataFrame, Column]:
    """Second table reduced to renamed key (and carried) columns, and the condition."""
    columns, tests = {}, []
    for i, key in enumerate(keys):
        mine, theirs = key if isinstance(key, tuple) else (key, key)
        name = theirs if isinstance(theirs, str) else f"key{i}"
        columns[_OTHER + name] = _col(theirs)
        mine = _col(mine)
        tests.append(mine.eqNullSafe(other(name)) if null_safe else mine == other(name))
    for name in carry:
        columns.setdefault(_OTHER + name, F.col(name))
    side = second.select(*[c.alias(n) for n, c in columns.items()])
    return side, reduce(and_, tests)


def drop_other(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(_OTHER)])


def only_new(df: DataFrame, existing: DataFrame, keys: Sequence[Key], null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is not in ``existing``.

    With ``null_safe`` NULL keys match each other; without it a NULL key matches
    nothing, so its rows are kept.
    """
    side, condition = match_side(existing, keys, null_safe)
    return df.join(side, condition, "left_anti")


def having_match(df: DataFrame, second: DataFrame, keys: Sequence[Key], residual: Column | None = None,
                 carry: Sequence[str] = ()) -> DataFrame:
    """Rows of ``df`` with at least one partner; partners never multiply rows."""
    side, condition = match_side(second, keys, carry=carry)
    return df.join(side, condition if residual is None else condition & residual, "left_semi")


FILTER_WORDS = 1 << 20  # of a Bloom filter: 8 MB of bits, whatever the number of keys
PROBES = 3


def _filter_place(key: Column) -> tuple[Column, Column]:
    """Word of a key, and the bits of it that the key sets."""
    word, mask = F.pmod(F.xxhash64(key), F.lit(FILTER_WORDS)), F.lit(0).cast("bigint")
    for k in range(PROBES):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(key, F.lit(k)), F.lit(64)).cast("int")))
    return word, mask


def key_filter(keys: DataFrame, name: str) -> DataFrame:
    """Bloom filter of the values of a column: (word, bits), at most ``FILTER_WORDS`` rows.

    Beyond some ten million keys it lets ever more others pass, but it never holds a key back.
    """
    word, mask = _filter_place(F.col(name))
    return keys.where(F.col(name).isNotNull()).groupBy(word.alias("word")).agg(F.bit_or(mask).alias("bits"))


def might_match(df: DataFrame, wanted: DataFrame, key: Key) -> DataFrame:
    """Rows of ``df`` that may have a partner in ``wanted``; those that can't go before any shuffle.

    A Bloom filter of the wanted keys, of bounded size, is sent to the tasks that scan ``df``, and the range of the keys
    reaches the scan itself. A join on the same key should follow: some rows without a partner pass.
    """
    name, second = key if isinstance(key, tuple) else (key, key)
    kind = wanted.schema[second].dataType
    value = F.col(name).cast(kind)
    spans = wanted.agg(F.min(second).alias("low"), F.max(second).alias("high"))
    near = df.where(value.between(spans.select("low").scalar(), spans.select("high").scalar()))
    return _filtered(near, wanted, value, second, "inner").where("__hit").select(*[F.col(f"`{c}`") for c in df.columns])


def passes_by(df: DataFrame, wanted: DataFrame, key: Key) -> DataFrame:
    """Rows of ``df`` that ``might_match`` leaves out, rows without a key among them; nothing is shuffled."""
    name, second = key if isinstance(key, tuple) else (key, key)
    value = F.col(name).cast(wanted.schema[second].dataType)
    rows = _filtered(df, wanted, value, second, "left")
    return rows.where(~F.coalesce("__hit", F.lit(False))).select(*[F.col(f"`{c}`") for c in df.columns])


def _filtered(df: DataFrame, wanted: DataFrame, value: Column, second: str, how: str) -> DataFrame:
    word, mask = _filter_place(value)
    held = F.broadcast(key_filter(wanted, second).withColumnsRenamed({"word": "__word", "bits": "__bits"}))
    word = F.when(value.isNotNull(), word)
    return df.join(held, word == F.col("__word"), how).withColumn("__hit", F.col("__bits").bitwiseAND(mask) == mask)


def not_in(df: DataFrame, second: DataFrame, key: str, second_key: str | None = None) -> DataFrame:
    """SQL ``NOT IN``: one NULL in ``second`` empties the result.

    Spark's own null-aware anti join must broadcast the second table whatever its
    size. Here the NULL rules come from two scalar counts and the rest is an
    ordinary anti join.
    """
    second_key = second_key or key
    counts = second.agg(F.count(F.lit(1)).alias("n"), F.count(second_key).alias("filled"))
    size = counts.select("n").scalar()
    nulls = counts.select(F.col("n") - F.col("filled")).scalar()
    kept = only_new(df, second, [(key, second_key)])
    return kept.where((size == 0) | ((nulls == 0) & F.col(key).isNotNull()))


def one_per_key(df: DataFrame, keys: Sequence[str], cols: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by ``order``, then by the columns themselves.

    An aggregate, so that a key with many rows shrinks before the shuffle.
    """
    ordered = [F.col(c) for c in (*order, *[c for c in cols if c not in order])]
    best = df.groupBy(*keys).agg(F.max(F.struct(*ordered)).alias("__best"))
    return best.select(*keys, *[F.col("__best")[c].alias(c) for c in cols])


def lookup(df: DataFrame, dim: DataFrame, on: Sequence[Key], cols: Sequence[str], unique: bool = False) -> DataFrame:
    """Left lookup that never multiplies rows.

    Unless ``unique`` says that the dimension already has one row per key, it is
    reduced to the smallest (by ``cols``) first.
    """
    names = [key[1] if isinstance(key, tuple) else key for key in on]
    if not unique:
        least = dim.groupBy(*names).agg(F.min(F.struct(*cols)).alias("__least"))
        dim = least.select(*names, *[F.col("__least")[c].alias(c) for c in cols])
    side, condition = match_side(dim, on, carry=cols)
    joined = df.join(side, condition, "left")
    return drop_other(joined.select(*df.columns, *[other(c).alias(c) for c in cols]))


def join_on(left: DataFrame, right: DataFrame, left_key: Column | str, right_key: Column | str,
            how: str = "inner") -> DataFrame:
    """Equi-join on an expression of each side (padded, cut or cast keys)."""
    first = left.withColumn("__key", _col(left_key))
    second = right.withColumn("__key", _col(right_key))
    return first.join(second, "__key", how).drop("__key")


def join_ci(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner") -> DataFrame:
    """Equi-join without regard to case."""
    return join_on(left, right, F.lower(F.col(left_key)), F.lower(F.col(right_key)), how)


def join_cast(left: DataFrame, right: DataFrame, left_key: str, right_key: str, type_name: str,
              how: str = "inner") -> DataFrame:
    """Equi-join of keys that differ in type; a dirty key matches nothing."""
    return join_on(left, right, F.col(left_key).try_cast(type_name),
                   F.col(right_key).try_cast(type_name), how)


def covered_on(members: DataFrame, periods: DataFrame, key: str, day, start: str, end: str) -> DataFrame:
    """Members with a period around the day; the day test runs in the period scan."""
    on_day = periods.where((F.col(start) <= F.lit(day)) & (F.col(end) >= F.lit(day)))
    return having_match(members, on_day, [key])


EPOCH = "0001-01-01"
BLOCK_SHIFT = 4  # a block of days has sixteen blocks of the level below
FEW = 32  # periods of a key that are paired with its days


def _blocks_of_spans(spans: DataFrame, top: Column) -> DataFrame:
    """``spans`` (days from ``__first`` to before ``__end``) as the fewest blocks (level, block) that make them up.

    On each level the days that are left lie between two block bounds. Blocks up to the next bounds of the level above
    are taken, and what is between those goes up.
    """
    def shifted(value: Column, level: Column, way: str = "shiftright") -> Column:
        return F.call_function(way, value, level * BLOCK_SHIFT)

    def ceiled(level: Column) -> Column:
        return shifted(F.col("__first") + shifted(F.lit(1).cast("bigint"), level, "shiftleft") - 1, level)

    def numbers(low: Column, high: Column) -> Column:
        return F.when(low < high, F.sequence(low, high - 1)).otherwise(F.array().cast("array<bigint>"))

    level = F.col("level")
    rows = spans.withColumn("level", F.explode(F.sequence(F.lit(0), top)))
    rows = rows.withColumns({"__low": ceiled(level), "__high": shifted(F.col("__end"), level)}).where("__low < __high")
    rows = rows.withColumns({"__low_up": F.shiftleft(ceiled(level + 1), BLOCK_SHIFT),
                             "__high_up": F.shiftleft(shifted(F.col("__end"), level + 1), BLOCK_SHIFT)})
    inner = numbers(F.col("__low"), F.col("__high"))
    outer = F.concat(numbers(F.col("__low"), F.col("__low_up")), numbers(F.col("__high_up"), F.col("__high")))
    return rows.withColumn("block", F.explode(F.when(F.col("__low_up") <= F.col("__high_up"), outer).otherwise(inner)))


def as_of_period(facts: DataFrame, periods: DataFrame, key: str, at: str, start: str, end: str,
                 cols: Sequence[str]) -> DataFrame:
    """Attach ``cols`` of the period that covers each fact's day.

    The range test runs on distinct (key, day) points against periods reduced to
    one row per start, so a key with very many facts costs no more than its days. Of overlapping periods the one
    that starts last wins, then the one that ends last, then the greatest value. Keys with many periods
    go through ``_hits_by_block``; days and periods of a key are paired only where it has few.
    """
    day = F.to_date(F.col(at))
    points = facts.select(F.col(key).alias("__point_key"), day.alias("__point_day"))
    points = points.where("__point_key is not null and __point_day is not null").distinct()
    spans = periods.where(F.col(key).isNotNull() & F.col(start).isNotNull() & F.col(end).isNotNull()).groupBy(
        F.col(key).alias("__span_key"), start, *cols).agg(F.max(end).alias(end))
    spans = spans.select("__span_key", F.to_date(start).alias("__from"), F.to_date(end).alias("__to"),
                         F.struct(F.col(start), F.col(end), *[F.col(c) for c in cols]).alias("__span"))
    busy = spans.groupBy("__span_key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > FEW).select(F.col("__span_key").alias("__busy"))
    few = spans.join(busy, F.col("__span_key") == F.col("__busy"), "left_anti")
    paired = points.join(few, (F.col("__point_key") == F.col("__span_key")) & F.col("__point_day").between(F.col("__from"), F.col("__to")))
    many = _hits_by_block(points.join(busy, F.col("__point_key") == F.col("__busy"), "left_semi"),
                          spans.join(busy, F.col("__span_key") == F.col("__busy"), "left_semi"))
    hits = paired.select("__point_key", "__point_day", "__span").unionByName(many)
    best = hits.groupBy("__point_key", "__point_day").agg(F.max("__span").alias("__best"))
    best = best.select("__point_key", "__point_day", *[F.col("__best")[c].alias(_OTHER + c) for c in cols])
    condition = (F.col(key) == F.col("__point_key")) & (day == F.col("__point_day"))
    joined = facts.join(best, condition, "left")
    extra = [other(c).alias(c) for c in cols]
    return joined.select(*facts.columns, *extra)


def _hits_by_block(points: DataFrame, spans: DataFrame) -> DataFrame:
    """Points with the winning periods of the blocks of days they lie in; days and periods of a key are never paired.

    A period is cut into blocks of days, of six sizes at most, and a block keeps the one period that would win in it, found by
    an aggregate. A day lies in one block of each size, so it meets as many rows. A key with very many days and periods is spread
    over its blocks.
    """
    points = points.withColumn("__day", F.datediff("__point_day", F.lit(EPOCH).cast("date")).cast("bigint"))
    # Only days that occur matter, so a period without end is no longer than they reach.
    reach = points.agg(F.min("__day").alias("low"), F.max("__day").alias("high"))
    low, high = reach.select("low").scalar(), reach.select("high").scalar()
    top = F.floor(F.log2((high - low + 1).cast("double")) / BLOCK_SHIFT).cast("int")  # no larger block fits in

    def number(name: str) -> Column:
        return F.datediff(name, F.lit(EPOCH).cast("date")).cast("bigint")

    bounds = spans.select("__span_key", "__span", F.greatest(number("__from") - low, F.lit(0)).alias("__first"),
                          (F.least(number("__to"), high) - low + 1).alias("__end")).where(F.col("__first") < F.col("__end"))
    winners = _blocks_of_spans(bounds, top).groupBy("__span_key", "level", "block").agg(F.max("__span").alias("__span"))
    steps = points.withColumn("__level", F.explode(F.sequence(F.lit(0), top)))
    steps = steps.withColumn("__block", F.call_function("shiftright", F.col("__day") - low, F.col("__level") * BLOCK_SHIFT))
    hits = steps.join(winners, (F.col("__point_key") == F.col("__span_key")) & (F.col("__level") == F.col("level"))
                      & (F.col("__block") == F.col("block")))
    return hits.select("__point_key", "__point_day", "__span")


def changed_rows(new: DataFrame, current: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Rows of ``new`` with no equal row in ``current``; NULL equals NULL."""
    side, condition = match_side(current, [key], carry=cols)
    same = reduce(and_, [F.col(c).eqNullSafe(other(c)) for c in cols], condition)
    return new.join(side, same, "left_anti")


def prev_value(df: DataFrame, closed: DataFrame, key: str, col: str, order: str) -> DataFrame:
    """Add ``previous_<col>`` from the latest closed row of each key."""
    latest = one_per_key(closed, [key], [col], order=[order])
    side, condition = match_side(latest, [key], carry=[col])
    joined = df.join(side, condition, "left")
    return joined.select(*df.columns, other(col).alias(f"previous_{col}"))
