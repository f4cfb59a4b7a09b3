"""Vectors compressed to codes of four parts, with codebooks learnt in exact integer rounds.

Components become integers floor(1024 x); a vector is cut into four consecutive parts and each
part is coded by the nearest of 256 entries of its position's codebook. Codebooks start as the
parts of the first 256 vectors and are replaced by floored means, in a fixed number of rounds.

Most entries are never looked at again after the first round, by norm-of-sum bounds. The entries
of a position lie in groups; for each group a vector keeps a lower bound of the distance to the
group's entries but its own one, with the round in which the bound was taken. All earlier codebooks are
retained, so in a later round the bound is lowered by the true net displacement
|c(now) - c(then)| of the group's entry that is furthest from where it was, which is never more than
the sum of its drifts round by round. Only groups whose lowered bound does not exceed the exact
distance to the vector's own entry are scanned again, in exact integers; bounds of others keep
their old stamp.

Spark passes over the vectors once a round and writes codes, bounds and stamps to the shared folder;
tasks send at most one partial sum for each entry. The driver holds the codebooks only.

Defined cases: rows whose vector is null, empty or holds null or non-finite components are left out, and so
are rows whose vector has another length than most (of equally common lengths the greatest), or a component
of 2^14 or more either way (sums of squared distances might not fit a long integer); the first vectors are those of the least vec_id, null
ids last, equal ids by their components; with fewer than 256 rows there are as many entries; lengths that four does
not divide are cut at floor(k * length / 4); a row is returned as often as it is given; an empty table
gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import lists_of, map_batches, read_table, share, staged

PARTS = 4
ENTRIES = 256
ROUNDS = 4
GROUPS = 16  # groups of entries of one codebook; one bound each
SCALE = 1024
LARGEST = 1 << 24  # of integer components
ROWS = 4096  # vectors worked on at a time
WIDEST_BOUND = 65535
NONE = np.int64(1) << 62  # more than any squared distance


def usable(vector: str) -> Column:
    """Whether a vector has components and all of them are numbers in range."""
    largest = F.lit(float(LARGEST // SCALE))
    inside = F.forall(vector, lambda x: F.coalesce(F.abs(x) < largest, F.lit(False)))
    return F.coalesce(inside & (F.size(vector) > 0), F.lit(False))


def integer_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, label, ints) of the usable rows whose vectors have the commonest length."""
    kept = table.where(usable("embedding"))
    lengths = kept.groupBy(F.size("embedding").alias("length")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    ints = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("int"))
    rows = kept.where(F.size("embedding") == (common["length"] if common else 0))
    return rows.select("vec_id", "label", ints.alias("ints"))


def cuts_of(length: int) -> list[slice]:
    return [slice(k * length // PARTS, (k + 1) * length // PARTS) for k in range(PARTS)]


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances between the rows of two integer arrays."""
    reach = max(int(np.abs(x).max(initial=0)), int(np.abs(y).max(initial=0)))
    if 4 * max(1, x.shape[1]) * reach * reach < 1 << 52:  # every term and sum is an integer below 2^53
        a, b = x.astype(np.float64), y.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    return np.stack([((x - entry) ** 2).sum(1) for entry in y], axis=1)


def grouped(book: np.ndarray, groups: int = GROUPS, rounds: int = 5) -> list[np.ndarray]:
    """Indexes of the entries of one codebook in groups of near ones."""
    centres = book[np.linspace(0, len(book) - 1, min(groups, len(book))).astype(int)].astype(float)
    for _ in range(rounds):
        near = np.argmin(((book[:, None, :] - centres[None]) ** 2).sum(2), axis=1)
        for g in range(len(centres)):
            if (near == g).any():
                centres[g] = book[near == g].mean(0)
    return [np.flatnonzero(near == g) for g in range(len(centres)) if (near == g).any()]


class Books:
    """Codebooks of all rounds so far: ``history[t][p]`` is the codebook of part p in round t."""

    def __init__(self, first: np.ndarray):
        self.cuts = cuts_of(first.shape[1])
        self.history = [[first[:, cut].astype(np.int64) for cut in self.cuts]]
        self.groups = [grouped(book) for book in self.history[0]]

    @property
    def now(self) -> list[np.ndarray]:
        return self.history[-1]

    def add(self, sums: dict[tuple[int, int], tuple[int, np.ndarray]]) -> None:
        """Next round's codebooks from (count, sum) of (part, entry); unused entries stay."""
        books = [book.copy() for book in self.now]
        for (part, entry), (count, total) in sums.items():
            books[part][entry] = total // count
        self.history.append(books)

    def displacement(self, part: int) -> np.ndarray:
        """Largest net way that entries of a group went since each round, by round and group."""
        now = self.now[part]
        ways = [np.sqrt(((now - then[part]).astype(float) ** 2).sum(1)) for then in self.history]
        return np.array([[w[g].max() for g in self.groups[part]] for w in ways]) * (1 + 1e-9)

    def digest(self) -> str:
        values = (str(v) for book in self.now for v in book.ravel().tolist())
        return hashlib.sha256(",".join(values).encode()).hexdigest()


def whole(distance2: np.ndarray) -> np.ndarray:
    """Square roots rounded down, as stored bounds."""
    return np.minimum(np.floor(np.sqrt(distance2) * (1 - 1e-12)), WIDEST_BOUND)


def nearest(books: Books, part: int, x: np.ndarray, own: np.ndarray, bounds: np.ndarray, stamps: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(entry, squared distance) of each row, ties to the lower index, and the number of exact distances.

    ``own`` is the entry of the round before (-1: none). ``bounds`` and ``stamps``, one column for each
    group, are brought up to date in place.
    """
    now, groups, round_ = books.now[part], books.groups[part], len(books.history) - 1
    n = len(x)
    moved = books.displacement(part)
    known = own >= 0
    d_own = np.full(n, NONE)
    step = x[known] - now[own[known]]
    d_own[known] = (step * step).sum(1)
    best, at = d_own.copy(), own.copy()
    looked = int(known.sum())
    scanned = []
    for g, members in enumerate(groups):
        low = bounds[:, g] - moved[stamps[:, g], g]
        rows = np.flatnonzero(low <= np.sqrt(best) * (1 + 1e-12))
        if not len(rows):
            continue
        looked += len(rows) * len(members)
        far = squared(x[rows], now[members])
        mine = members[None, :] == own[rows][:, None]
        far[mine] = NONE
        k = far.argmin(1)  # the first of equal ones, and members ascend
        least = far[np.arange(len(rows)), k]
        far[np.arange(len(rows)), k] = NONE
        entry, second = members[k], far.min(1)
        better = (least < best[rows]) | (least == best[rows]) & (entry < at[rows]) & (least < NONE)
        best[rows[better]], at[rows[better]] = least[better], entry[better]
        scanned.append((g, rows, entry, least, second))
    changed = known & (at != own)
    for g, rows, entry, least, second in scanned:
        bounds[rows, g] = whole(np.where(at[rows] == entry, second, least))
        stamps[rows, g] = round_
    group_of = np.zeros(len(now), np.int64)
    for g, members in enumerate(groups):
        group_of[members] = g
    # An entry that a vector leaves is no longer left out of its group's bound.
    rows = np.flatnonzero(changed)
    g = group_of[own[rows]]
    low = np.maximum(bounds[rows, g] - moved[stamps[rows, g], g], 0)
    bounds[rows, g] = np.floor(np.minimum(low, whole(d_own[rows])))
    stamps[rows, g] = round_
    return at, best, looked


def gathered(batches: Iterator[dict], rows: int = ROWS) -> Iterator[dict]:
    """Batches put together until they have at least ``rows`` rows."""
    held: list[dict] = []
    count = 0
    for batch in batches:
        held.append(batch)
        count += len(batch["ints"])
        if count >= rows:
            yield {c: pa.concat_arrays([b[c] for b in held]) for c in batch}
            held, count = [], 0
    if held:
        yield {c: pa.concat_arrays([b[c] for b in held]) for c in held[0]}


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.int64)


def packed(values: np.ndarray) -> pa.Array:
    """Rows of an array as one binary value each."""
    width = values.shape[1] * values.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(width), len(values), [None, pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def unpacked(column: pa.Array, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


STATE = "vec_id bigint, label {label}, ints array<int>, code binary, error bigint, bounds binary, stamps binary"


def assigned(rows: DataFrame, books: Books, fresh: bool) -> DataFrame:
    """``rows`` with the code of each vector in the present codebooks, its error, bounds and stamps."""
    get = share(rows.sparkSession, books)
    label = rows.schema["label"].dataType.simpleString()

    def run(batches):
        books = get()
        ends = np.cumsum([0] + [len(g) for g in books.groups])
        for batch in gathered(batches):
            x = matrix(batch["ints"])
            n = len(x)
            if fresh:
                code = np.full((n, PARTS), -1, np.int64)
                bounds, stamps = np.zeros((n, ends[-1]), np.uint16), np.zeros((n, ends[-1]), np.uint8)
            else:
                code = unpacked(batch["code"], np.uint8, PARTS).astype(np.int64)
                bounds = unpacked(batch["bounds"], np.uint16, ends[-1]).copy()
                stamps = unpacked(batch["stamps"], np.uint8, ends[-1]).copy()
            error = np.zeros(n, np.int64)
            for p, cut in enumerate(books.cuts):
                span = slice(ends[p], ends[p + 1])
                b, s = bounds[:, span].astype(float), stamps[:, span].astype(np.int64)
                code[:, p], far, _ = nearest(books, p, x[:, cut], code[:, p], b, s)
                bounds[:, span], stamps[:, span] = b, s
                error += far
            yield {"vec_id": batch["vec_id"], "label": batch["label"], "ints": batch["ints"], "code": packed(code.astype(np.uint8)),
                   "error": error, "bounds": packed(bounds), "stamps": packed(stamps)}

    return map_batches(rows, run, STATE.format(label=label))


def sums_of(state: DataFrame, cuts: list[slice]) -> dict[tuple[int, int], tuple[int, np.ndarray]]:
    """(count, sum) of the parts that each (part, entry) has; a task sends one row for each at most."""

    def run(batches):
        counts, totals = np.zeros((PARTS, ENTRIES), np.int64), {}
        for batch in gathered(batches):
            x, code = matrix(batch["ints"]), unpacked(batch["code"], np.uint8, PARTS)
            for p, cut in enumerate(cuts):
                counts[p] += np.bincount(code[:, p], minlength=ENTRIES)
                order = np.argsort(code[:, p], kind="stable")
                entries, starts = np.unique(code[order, p], return_index=True)
                total = totals.setdefault(p, np.zeros((ENTRIES, cut.stop - cut.start), np.int64))
                if total.shape[1]:
                    total[entries] += np.add.reduceat(x[order][:, cut], starts, axis=0)
        part, entry = np.nonzero(counts)
        if len(part):
            rows = [totals[p][e] for p, e in zip(part, entry)]
            yield {"part": part, "entry": entry, "n": counts[part, entry], "total": lists_of(np.concatenate(rows), [len(r) for r in rows])}

    partial = map_batches(state.select("ints", "code"), run, "part int, entry int, n bigint, total array<bigint>")
    counts = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"))
    places = partial.select("part", "entry", F.posexplode("total").alias("place", "value"))
    sums = places.groupBy("part", "entry", "place").agg(F.sum("value").alias("value"))
    whole_sums = sums.groupBy("part", "entry").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("total"))
    rows = counts.join(whole_sums, ["part", "entry"], "left").select("part", "entry", "n", "total.value").collect()
    return {(r["part"], r["entry"]): (r["n"], np.array(r["value"] or [], np.int64)) for r in rows}


def compress(table: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per usable row: vec_id, code, error, label_error, codebooks_sha256."""
    rows = staged(integer_vectors(table), "vectors")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(ENTRIES).select("ints").collect()
    if not first:
        return rows.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"),
                           F.lit(0).cast("bigint").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    books = Books(np.array([r["ints"] for r in first], np.int64))
    state = rows
    for t in range(rounds):
        state = staged(assigned(state, books, fresh=t == 0), f"round{t}")
        books.add(sums_of(state, books.cuts))
    last = assigned(state, books, fresh=rounds == 0)
    coded = staged(last.select("vec_id", "label", F.lower(F.hex("code")).alias("code"), "error"), "codes")
    errors = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    both = coded.join(errors, coded["label"].eqNullSafe(errors["of_label"]))
    return both.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def op12_code_compression(spark: SparkSession, folder: str) -> DataFrame:
    return compress(read_table(spark, folder, "embeddings"))


def sql(rounds: int = ROUNDS) -> str:
    """The same by comparing every part with every entry in every round."""

    def nearest_of(t: int) -> str:
        return f"""
near{t} AS MATERIALIZED (
  SELECT n, part, arg_min(entry, (far, entry)) AS entry, min(far) AS far FROM (
    SELECT p.n, p.part, b.entry, list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS far
    FROM parts p JOIN book{t} b USING (part)) GROUP BY n, part)"""

    steps = []
    for t in range(rounds):
        steps.append(nearest_of(t))
        steps.append(f"""
book{t + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM book{t} b LEFT JOIN (
    SELECT part, entry, list((s - ((s % c) + c) % c) // c ORDER BY place) AS x FROM (
      SELECT part, entry, place, sum(v)::BIGINT AS s, count(*) AS c FROM (
        SELECT p.part, a.entry, unnest(p.x) AS v, unnest(range(len(p.x))) AS place
        FROM parts p JOIN near{t} a USING (n, part)) GROUP BY part, entry, place) GROUP BY part, entry) m USING (part, entry))""")
    steps.append(nearest_of(rounds))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS n, vec_id, label,
         list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})::BIGINT) AS ints
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT n, part, ints[part * len(ints) // {PARTS} + 1:(part + 1) * len(ints) // {PARTS}] AS x
  FROM kept, range({PARTS}) r(part)),
book0 AS MATERIALIZED (SELECT part, n AS entry, x FROM parts WHERE n < {ENTRIES}),{','.join(steps)},
coded AS MATERIALIZED (
  SELECT n, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(far)::BIGINT AS error FROM near{rounds} GROUP BY n)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) FROM book{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (n)
"""


SQL = sql()
