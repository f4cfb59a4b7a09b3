"""Dimension with full history (type 2): one pass from old state to new state."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.dates import moment
from tidewell.functions.text import valid_phone
from tidewell.operators.matching import might_match, one_per_key, passes_by
from tidewell.sources.tables import written

# Fixed value: start of the first version of every member.
FIRST_START = datetime(2013, 1, 1)


def row_digest(cols: Sequence[str], defaults: dict | None = None) -> Column:
    """Hash of columns in which NULL differs from every value (but a column's default) and keeps its place."""
    defaults = defaults or {}
    values = [F.coalesce(F.col(c), F.lit(defaults[c])) if c in defaults else F.col(c) for c in cols]
    return F.xxhash64(*[part for value in values for part in (value.isNull(), value)])


def scd2_merge_by_hash(dim: DataFrame, staged: DataFrame, key: str, cols: Sequence[str], as_of: date | datetime,
                       row_hash: str | None = None, order: Sequence[str] = (), defaults: dict | None = None, **rules) -> DataFrame:
    """``scd2_merge`` for large dimensions and files in which few members have changed.

    Of the dimension only key and hash of open versions move, to where the staged rows are; staged rows whose hash is that of the single open version go. The others
    are written, and a Bloom filter of their keys tells the rows of the dimension that may be concerned: those are
    merged, values compared exactly. All other rows, closed ones too, pass by without a shuffle.

    The hash is that of the compared columns, taken as they are scanned. ``row_hash`` names a column that keeps it with each
    open version instead, so that the columns aren't read; nothing else may change them then.
    """
    value = F.coalesce(F.col(row_hash), row_digest(cols, defaults)) if row_hash else row_digest(cols, defaults)
    opened = dim.where(F.col("end_date").isNull() & F.col(key).isNotNull())
    known = opened.groupBy(F.col(key).alias("__known")).agg(F.count(F.lit(1)).alias("__open"), F.min(value).alias("__hash"))
    carried = sorted(c for c in staged.columns if c in dim.columns and c not in (key, row_hash))
    fresh = one_per_key(staged.where(F.col(key).isNotNull()), [key], carried, order=order)
    side = known.join(fresh, F.col("__known") == F.col(key), "full_outer")
    absent = F.col("__known").isNull()
    concerned = side.where((F.col("__open") > 1) | F.col(key).isNotNull() & (absent | (F.col("__hash") != row_digest(cols, defaults))))
    concerned = written(concerned.withColumn("__concerned", F.coalesce("__known", key)))
    near = might_match(dim, concerned, (key, "__concerned"))
    rows = concerned.where(F.col(key).isNotNull()).select(key, *carried)
    merged = scd2_merge(near, rows, key, cols, as_of, defaults=defaults, **rules)
    state = merged.unionByName(passes_by(dim, concerned, (key, "__concerned")))
    return state.withColumn(row_hash, F.when(F.col("end_date").isNull(), value)) if row_hash else state


def scd2_merge(dim: DataFrame, staged: DataFrame, key: str, cols: Sequence[str], as_of: date | datetime,
               first_start: datetime = FIRST_START, repair: str | None = None,
               extra: dict[str, Column] | None = None, defaults: dict | None = None,
               as_written: bool = False, order: Sequence[str] = ()) -> DataFrame:
    """New state of the dimension after merging staged rows.

    * a key never seen gets one open row from ``first_start``;
    * a key whose open row differs in ``cols`` (NULL equals NULL) has that row
      closed at ``as_of`` and a new one opened there;
    * a key with closed rows only gets a new open row at ``as_of``;
    * everything else is left alone, so a rerun changes nothing.

    Of several staged rows of a key the greatest by ``order`` (say, its time) counts,
    then by the carried columns by name. Of several open rows of a key the one that
    starts last stays open and the others are closed at ``as_of``, so that each key has
    one open row. ``repair`` names a phone column: an invalid number is
    replaced by that of the open row, so it opens no version of its own and a
    feed that repeats it changes nothing. ``extra`` gives bookkeeping columns for
    opened rows; ``defaults`` gives values that count as equal to NULL when versions
    are compared. ``as_written`` gives new keys a closed first row and an open second
    one, and compares invalid numbers as they are.

    Closed rows are not shuffled except for their keys; open rows, staged rows
    and those keys share one partitioning.
    """
    today = moment(date(as_of.year, as_of.month, as_of.day))
    first = moment(first_start)
    extra = extra or {}
    carried = [c for c in staged.columns if c in dim.columns and c != key]
    names = dim.columns

    closed = dim.where(F.col("end_date").isNotNull())
    latest = Window.partitionBy(key).orderBy(F.col("start_date").desc_nulls_last(), row_digest(sorted(names)))
    opened = dim.where(F.col("end_date").isNull())
    ranked = opened.where(F.col(key).isNotNull()).withColumn("__rank", F.row_number().over(latest))
    current = ranked.where("__rank = 1").drop("__rank")
    superseded = ranked.where("__rank > 1").withColumn("end_date", today.cast(dim.schema["end_date"].dataType)).select(*names)
    nameless = opened.where(F.col(key).isNull())
    fresh = one_per_key(staged.where(F.col(key).isNotNull()), [key], sorted(carried), order=order)
    seen = closed.select(key).distinct().withColumn("__seen", F.lit(True))
    fresh = fresh.join(seen, key, "left")

    old = current.select(F.col(key).alias("__old_key"), F.struct(*[F.col(c) for c in names]).alias("__old"))
    new = fresh.select(F.col(key).alias("__new_key"), F.struct(*[F.col(c) for c in [key, *carried]]).alias("__new"),
                       "__seen")
    both = old.join(new, F.col("__old_key") == F.col("__new_key"), "full_outer")

    defaults = defaults or {}

    def compared(side: str, name: str) -> Column:
        value = F.col(side)[name]
        if side == "__new" and name == repair and not as_written:
            value = F.when(valid_phone(value), value).otherwise(F.col("__old")[name])
        return F.coalesce(value, F.lit(defaults[name])) if name in defaults else value

    same = reduce(and_, [compared("__old", c).eqNullSafe(compared("__new", c)) for c in cols])
    has_old, has_new = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    changed = has_old & has_new & ~same
    unseen = ~has_old & has_new & F.col("__seen").isNull()
    reopened = changed | (~has_old & has_new & F.col("__seen").isNotNull())

    def version(start: Column, end: Column, repaired: bool) -> Column:
        fields = []
        for field in dim.schema.fields:
            name = field.name
            if name == "start_date":
                value = start
            elif name == "end_date":
                value = end
            elif name in extra:
                value = extra[name]
            elif name == repair and repaired:
                value = F.col("__new")[name]
                value = F.when(valid_phone(value), value).otherwise(F.col("__old")[name])
            elif name == key or name in carried:
                value = F.col("__new")[name]
            else:  # a column the feed does not carry starts empty in a new version
                value = F.lit(None)
            fields.append(value.cast(field.dataType).alias(name))
        return F.struct(*fields)

    no_end = F.lit(None).cast("timestamp_ntz")
    kept_fields = [F.when(changed, today).otherwise(F.col("__old")[n]).alias(n) if n == "end_date"
                   else F.col("__old")[n].alias(n) for n in names]
    rows = [F.when(has_old, F.struct(*kept_fields)),
            F.when(reopened, version(today, no_end, True))]
    if as_written:
        rows += [F.when(unseen, version(first, today, False)), F.when(unseen, version(today, no_end, False))]
    else:
        rows += [F.when(unseen, version(first, no_end, False))]
    merged = both.select(F.inline(F.array_compact(F.array(*rows))))
    return closed.unionByName(superseded).unionByName(nameless).unionByName(merged.select(*names))
