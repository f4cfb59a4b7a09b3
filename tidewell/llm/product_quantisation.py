"""Near-duplicate vectors through coarse inverted lists and product-quantised residuals.

1. Equal vectors become one with the number of its copies. A bounded sample fits the index: list centres on the
   unit sphere (leaders further apart than linked vectors, moved by a few k-means rounds) and codebooks
   of residual subspaces.
2. Every vector is stored in the list of its nearest centre, with the codes of its residual and the length of what
   the codes leave out. It also visits each list whose bisector with its own is within ``reach``: linked
   vectors in different lists lie on both sides of the bisector, and one of them is no further from it than half
   their distance. A reach of half the greatest distance of linked vectors would lose no pair. It is shortened to
   five standard deviations of how far linked vectors lie apart in one direction (``DEVIATIONS``), where that is less.
3. A list's members within half the link angle of its centre, its core, all link with each other: they are counted,
   not compared. Core members are compared only with vectors within one and a half link angles of the centre, as no
   other can link. So one large group of near copies costs no more than its members.
4. The rest is compared in blocks of bounded size, a list's members with each other and with its visitors: residual
   distances by table lookups over the codes (asymmetric: the query is not quantised), less the
   length the codes leave out, rule pairs out; what is left is compared by exact cosine. A pair that meets in
   both its lists counts in one. Tasks return each vector's number of links and its least linked one in the block, so no
   row is made for a pair.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing and are
their own component; only vectors of one length are compared; rows that repeat a vec_id are vectors of their
own, each returned; a row without vec_id links, but names no component, has none and is not kept; an empty table
gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import least_hashes, lists_of, map_batches, read_table, share, staged
from tidewell.llm.ngram_join import components

COSINE = 0.95
ANGLE = math.acos(COSINE)
CHORD = math.sqrt(2 - 2 * COSINE)
DEVIATIONS = 5
SAMPLE = 16384  # vectors that fit the index; there are at most a quarter as many lists
PARTS = 8  # subspaces of a residual
CODES = 256
BLOCK = 4096  # rows of one side of a comparison
STEP = 512  # queries of one table of distances
SLACK = 1e-4  # of estimated distances, for single precision


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square over- or underflows."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def kmeans(rows: np.ndarray, centres: np.ndarray, rounds: int, on_sphere: bool = False) -> np.ndarray:
    centres = centres.copy()
    for _ in range(rounds):
        near = nearest_of(rows, centres)
        sums, counts = np.zeros_like(centres), np.bincount(near, minlength=len(centres))
        np.add.at(sums, near, rows)
        used = counts > 0
        centres[used] = sums[used] / counts[used, None]
        if on_sphere:
            lengths = np.sqrt((centres * centres).sum(1, keepdims=True))
            centres = np.divide(centres, lengths, out=centres, where=lengths > 0)
    return centres


def nearest_of(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres * centres).sum(1) / 2
    return np.concatenate([(rows[k:k + 2048] @ centres.T - half).argmax(1) for k in range(0, len(rows), 2048)]) if len(rows) else np.empty(0, np.int64)


def leaders(rows: np.ndarray, most: int) -> np.ndarray:
    """The first rows that are not linked with an earlier one taken, at most ``most``."""
    taken = rows[:0]
    for k in range(0, len(rows), 256):
        block = rows[k:k + 256]
        block = block[~(block @ taken.T >= COSINE).any(1)] if len(taken) else block
        close = np.tril(block @ block.T >= COSINE, -1)
        stay = np.ones(len(block), bool)
        for i in range(len(block)):
            stay[i] = not (close[i] & stay).any()
        taken = np.concatenate([taken, block[stay]])[:most]
        if len(taken) == most:
            break
    return taken


@dataclass
class Index:
    """Centres of the lists and codebooks of residuals, of bounded size."""

    centres: np.ndarray
    books: list[np.ndarray]
    reach: float

    @classmethod
    def fit(cls, sample: np.ndarray, vectors: int, deviations: float = DEVIATIONS) -> Index:
        """``sample`` holds unit rows; ``vectors`` is the number of all vectors of this length."""
        lists = min(math.ceil(math.sqrt(vectors)), max(1, SAMPLE // 4), max(1, len(sample) // 4))
        centres = kmeans(sample, leaders(sample, lists), 3, on_sphere=True)
        residuals = sample - centres[nearest_of(sample, centres)]
        books = []
        for cut in cuts_of(sample.shape[1]):
            part = residuals[:, cut]
            start = part[np.linspace(0, len(part) - 1, min(CODES, len(part))).astype(int)]
            books.append(kmeans(part, start, 4))
        return cls(centres, books, CHORD / 2 * min(1.0, deviations / math.sqrt(sample.shape[1])))

    def place(self, rows: np.ndarray) -> dict[str, np.ndarray]:
        """Home list, its cosine, and the lists visited with their cosines, of unit rows."""
        near = rows @ self.centres.T
        home = near.argmax(1)
        own = near[np.arange(len(rows)), home]
        # Two centres are at most 2 apart, so no bisector is nearer than half the difference of cosines.
        row, other = np.nonzero(own[:, None] - near <= 2 * self.reach)
        apart = row, other = row[other != home[row]], other[other != home[row]]
        ways = self.centres[home[row]] - self.centres[other]
        width = np.sqrt((ways * ways).sum(1))
        visit = own[row] - near[apart] <= self.reach * width
        return {"home": home, "own": own, "row": row[visit], "visited": other[visit], "cosine": near[row[visit], other[visit]]}

    def encode(self, rows: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and lengths of what they leave out."""
        residuals = rows - self.centres[home]
        codes, left = np.empty((len(rows), len(self.books)), np.uint8), np.zeros(len(rows))
        for m, (cut, book) in enumerate(zip(cuts_of(rows.shape[1]), self.books)):
            codes[:, m] = nearest_of(residuals[:, cut], book)
            step = residuals[:, cut] - book[codes[:, m]]
            left += (step * step).sum(1)
        return codes, np.sqrt(left)

    def estimates(self, queries: np.ndarray, list_: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances from each query to each coded residual of a list, by table lookups."""
        residuals = queries - self.centres[list_]
        total = np.zeros((len(queries), len(codes)), np.float32)
        for m, (cut, book) in enumerate(zip(cuts_of(queries.shape[1]), self.books)):
            part = residuals[:, cut]
            table = ((part * part).sum(1)[:, None] - 2 * (part @ book.T) + (book * book).sum(1)).astype(np.float32)
            total += table[:, codes[:, m]]
        return total


def cuts_of(length: int) -> list[slice]:
    parts = min(PARTS, length)
    return [slice(k * length // parts, (k + 1) * length // parts) for k in range(parts)]


def is_core(cosine: np.ndarray) -> np.ndarray:
    return cosine >= math.cos(ANGLE / 2) + 1e-9


def is_rim(cosine: np.ndarray) -> np.ndarray:
    return cosine >= math.cos(1.5 * ANGLE) - 1e-9


PLACED = "vid bigint, copies bigint, vector binary, home int, core boolean, rim boolean, visits array<int>, rims array<boolean>, code binary, left float"


def placed(vectors: DataFrame, index: Index) -> DataFrame:
    get = share(vectors.sparkSession, index)

    def run(batches):
        index = get()
        for batch in batches:
            raw = batch["embedding"].flatten().to_numpy(zero_copy_only=False).reshape(len(batch["vid"]), -1)
            rows = unit(raw)
            at = index.place(rows)
            codes, left = index.encode(rows, at["home"])
            core, sizes = is_core(at["own"]), np.bincount(at["row"], minlength=len(rows))
            yield {"vid": batch["vid"], "copies": batch["copies"], "vector": [r.tobytes() for r in raw], "home": at["home"].astype(np.int32),
                   "core": core, "rim": is_rim(at["own"]) & ~core, "visits": lists_of(at["visited"].astype(np.int32), sizes),
                   "rims": lists_of_flags(is_rim(at["cosine"]), sizes), "code": [c.tobytes() for c in codes], "left": left.astype(np.float32)}

    return map_batches(vectors.select("vid", "copies", "embedding"), run, PLACED)


def lists_of_flags(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.bool_()))


# Cells: 2 * list holds members outside the core and all visitors; 2 * list + 1 the core, and the vectors near enough to link with it.
def cells_of(rows: DataFrame) -> DataFrame:
    """(cell, members, queries, copies: of the members, least: their least vid)."""
    core = F.col("core").cast("int")
    member = F.struct((F.col("home") * 2 + core).alias("cell"), F.lit(1).alias("member"))
    rim = F.when(F.col("rim"), F.array(F.struct((F.col("home") * 2 + 1).alias("cell"), F.lit(0).alias("member"))))
    visits = F.transform("visits", lambda v: F.struct((v * 2).alias("cell"), F.lit(0).alias("member")))
    rims = F.transform(F.filter(F.arrays_zip("visits", "rims"), lambda v: v["rims"]), lambda v: F.struct((v["visits"] * 2 + 1).alias("cell"), F.lit(0).alias("member")))
    entries = F.concat(F.array(member), F.coalesce(rim, F.array().cast("array<struct<cell:int,member:int>>")), visits, rims)
    flat = rows.select("vid", "copies", F.inline(entries))
    inside = F.col("member") == 1
    return flat.groupBy("cell").agg(
        F.sum("member").alias("members"), F.sum(1 - F.col("member")).alias("queries"),
        F.sum(F.when(inside, F.col("copies"))).alias("copies"), F.min(F.when(inside, F.col("vid"))).alias("least"))


def dealt(cell: np.ndarray, member: np.ndarray, block: np.ndarray, a: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, ...]:
    """Comparisons (entry, first block, second block, whether on the first side) that entries take part in.

    A cell has ``a`` blocks of members and ``v`` of queries; ``block`` is the entry's own. Cells outside a core compare
    each pair of member blocks; their first block of queries goes with the comparison of a block with itself.
    """
    shell = cell % 2 == 0
    tasks = np.where(member, np.where(shell, a + np.maximum(v - 1, 0), v), a)
    entry = np.repeat(np.arange(len(cell)), tasks)
    k = np.arange(len(entry)) - np.repeat(np.cumsum(tasks) - tasks, tasks)
    shell, member, block, a = shell[entry], member[entry], block[entry], a[entry]
    inner = shell & member & (k < a)
    first = np.where(inner, np.minimum(block, k), np.where(member, block, k))
    of_query = np.where(shell, np.where(block == 0, k, a + block), block)
    of_member = np.where(shell, np.where(inner, np.maximum(block, k), k + 1), k)
    second = np.where(member, of_member, of_query)
    return entry, first, second, member & ~(inner & (k < block))


TASK = "cell int, first int, second int, side boolean, vid bigint, copies bigint, vector binary, home int, visits array<int>, code binary, left float"


def comparisons(rows: DataFrame, blocks: dict[int, tuple[int, int]]) -> DataFrame:
    """Each vector in each comparison that it takes part in; ``blocks`` has the (member, query) blocks of the cells."""
    get = share(rows.sparkSession, blocks)

    def run(batches):
        blocks = get()
        for batch in batches:
            n = len(batch["vid"])
            home = batch["home"].to_numpy()
            core, rim = (batch[c].to_numpy(zero_copy_only=False) for c in ("core", "rim"))
            visited = batch["visits"].flatten().to_numpy()
            of = np.repeat(np.arange(n), batch["visits"].value_lengths().to_numpy())
            near = batch["rims"].flatten().to_numpy(zero_copy_only=False).astype(bool)
            cell = np.concatenate([2 * home + core, 2 * home[rim] + 1, 2 * visited, 2 * visited[near] + 1])
            row = np.concatenate([np.arange(n), np.flatnonzero(rim), of, of[near]])
            member = np.arange(len(cell)) < n
            a, v = np.array([blocks.get(c, (0, 0)) for c in cell.tolist()], np.int64).reshape(-1, 2).T
            vid = batch["vid"].to_numpy()
            spread = ((vid[row].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)
            block = spread % np.maximum(np.where(member, a, v), 1)
            entry, first, second, side = dealt(cell, member, block, a, v)
            for k in range(0, len(entry), 20_000):
                part = slice(k, k + 20_000)
                take = pa.array(row[entry[part]])
                kept = {c: batch[c].take(take) for c in ("vid", "copies", "vector", "home", "visits", "code", "left")}
                yield {"cell": cell[entry[part]], "first": first[part], "second": second[part], "side": side[part]} | kept

    return map_batches(rows, run, TASK)


def rooted(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least vertex that each of n vertices reaches over edges (a, b)."""
    least = np.arange(n)
    while True:
        before = least.copy()
        low = np.minimum(least[a], least[b])
        np.minimum.at(least, a, low)
        np.minimum.at(least, b, low)
        least = least[least]
        if (least == before).all():
            return least


def links_in(task: dict[str, np.ndarray], index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vid, linked copies, least vid linked in this comparison) of the vectors that link in it."""
    cell, side = int(task["cell"][0]), task["side"]
    list_, shell = cell // 2, cell % 2 == 0
    order = np.argsort(task["vid"], kind="stable")  # so that the least place is the least vid
    task, side = {c: x[order] for c, x in task.items()}, side[order]
    members, queries = np.flatnonzero(side), np.flatnonzero(~side)
    itself = shell and task["first"][0] == task["second"][0]
    queries = np.concatenate([members, queries]) if itself else queries
    rows, codes, left = task["rows"], task["code"][members], task["left"][members].astype(np.float32)
    bound = (left + np.float32(CHORD + SLACK)) ** 2
    # Lists that members visit, as sorted (member, list) numbers.
    lists = len(index.centres)
    visits = np.sort(np.concatenate([[-1], *[m * lists + np.asarray(task["visits"][m], np.int64) for m in members]]))
    pairs = []
    for k in range(0, len(queries), STEP):
        asked = queries[k:k + STEP]
        maybe = index.estimates(rows[asked], list_, codes) <= bound
        if itself:
            maybe &= members[None, :] < np.where(side[asked], asked, len(rows))[:, None]
        q, m = np.nonzero(maybe)
        if len(q) * 8 > maybe.size:
            cosine = (rows[asked] @ rows[members].T)[q, m]
        else:
            cosine = np.concatenate([np.empty(0), *[np.einsum("ij,ij->i", rows[asked[q[s:s + 65536]]], rows[members[m[s:s + 65536]]])
                                                     for s in range(0, len(q), 65536)]])
        linked = cosine >= COSINE
        q, m = asked[q[linked]], members[m[linked]]
        home = task["home"][q]
        wanted = m * lists + home
        found = visits[np.minimum(np.searchsorted(visits, wanted), len(visits) - 1)] == wanted
        once = (home == list_) | (home < list_) | ~found
        pairs.append((q[once], m[once]))
    q, m = (np.concatenate([pair[k] for pair in pairs] or [np.empty(0, np.int64)]) for k in (0, 1))
    n = len(rows)
    copies = task["copies"]
    counts = np.bincount(q, weights=copies[m], minlength=n) + np.bincount(m, weights=copies[q], minlength=n)
    linked = np.flatnonzero(counts)
    root = rooted(q, m, n)
    return task["vid"][linked], counts[linked].astype(np.int64), task["vid"][root[linked]]


LINKS = "vid bigint, links bigint, root bigint"


def compared(tasks: DataFrame, index: Index, kind: str) -> DataFrame:
    get = share(tasks.sparkSession, index)

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        column = {c: table.column(c).combine_chunks() for c in table.column_names}
        task = {c: column[c].to_numpy(zero_copy_only=False) for c in ("cell", "first", "second", "side", "vid", "copies", "home", "left")}
        task["visits"] = column["visits"].to_numpy(zero_copy_only=False)
        task["rows"] = unit(np.frombuffer(b"".join(column["vector"].to_pylist()), kind).reshape(len(table), -1))
        task["code"] = np.frombuffer(b"".join(column["code"].to_pylist()), np.uint8).reshape(len(table), -1)
        vid, links, root = links_in(task, get())
        return pa.table({"vid": vid, "links": links, "root": root})

    return tasks.groupBy("cell", "first", "second").applyInArrow(run, LINKS)


def links_of(vectors: DataFrame, count: int, deviations: float = DEVIATIONS) -> DataFrame:
    """(vid, links, root) in any number of rows a vector, for vectors of one length."""
    kind = "f4" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "f8"
    sample = least_hashes(vectors.select("h1", "h2", "embedding"), ["h1", "h2"], SAMPLE, count).select("embedding").toArrow()
    raw = sample.column("embedding").combine_chunks()
    index = Index.fit(unit(raw.flatten().to_numpy(zero_copy_only=False).reshape(len(raw), -1)), count, deviations)
    rows = staged(placed(vectors, index), "placed")
    cells = staged(cells_of(rows), "cells")  # two a list
    blocks = {r["cell"]: (-(-r["members"] // BLOCK), -(-r["queries"] // BLOCK))
              for r in cells.where("members + queries > 1 and members > 0").select("cell", "members", "queries").collect()}
    explicit = compared(comparisons(rows, blocks), index, kind)
    known = cells.where("cell % 2 = 1 and members > 1").select((F.col("cell") / 2).cast("int").alias("home"), F.col("copies").alias("all"), "least")
    cores = rows.where("core").select("vid", "copies", "home").join(known, "home")
    return explicit.unionByName(cores.select("vid", (F.col("all") - F.col("copies")).alias("links"), F.col("least").alias("root")))


def near_duplicates(table: DataFrame, deviations: float = DEVIATIONS) -> DataFrame:
    """One row per row: vec_id, n_links, component_id, kept."""
    element = table.schema["embedding"].dataType.elementType
    vector = F.col("embedding") if element.typeName() in ("float", "double") else F.col("embedding").cast("array<double>")
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    good = F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = table.select("vec_id", vector.alias("embedding")).withColumns({
        "good": good, "h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit(1), "embedding")})
    same = rows.where("good").groupBy("embedding", "h1", "h2").agg(F.count("*").alias("copies"), F.min("vec_id").alias("low"))
    # Written at once, so that the numbers stay.
    vectors = staged(same.withColumn("vid", F.monotonically_increasing_id()), "vectors")
    lengths = vectors.groupBy(F.size("embedding").alias("length")).count().collect()
    found = None
    for r in sorted(lengths):
        links = staged(links_of(vectors.where(F.size("embedding") == r["length"]), r["count"], deviations), "links")
        found = links if found is None else found.unionByName(links)
    if found is None:
        found = table.sparkSession.createDataFrame([], LINKS)
    counts = found.groupBy("vid").agg(F.sum("links").alias("links"))
    place = components(found.select(F.col("vid").alias("a"), F.col("root").alias("b"))).withColumnRenamed("sid", "vid")
    known = vectors.select("vid", "h1", "h2", "copies", "low").join(counts, "vid", "left").join(place, "vid", "left")
    known = staged(known.withColumn("component", F.coalesce("component", "vid")), "known")
    least = known.groupBy("component").agg(F.min("low").alias("least"))
    known = known.join(least, "component").select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "least")
    linked = rows.where("good").select("vec_id", "h1", "h2").join(known, ["h1", "h2"]).select("vec_id", "links", "least")
    alone = rows.where(~F.col("good")).select("vec_id", F.lit(0).cast("bigint").alias("links"), F.col("vec_id").alias("least"))
    component = F.when(F.col("vec_id").isNotNull(), F.col("least"))
    return linked.unionByName(alone).select(
        "vec_id", F.col("links").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op11_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read_table(spark, folder, "embeddings"))


# All pairs by exact cosine, for tables small enough.
SQL = f"""
WITH RECURSIVE good AS (
  SELECT row_number() OVER () AS n, vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.n AS a, b.n AS b, a.vec_id AS ida, b.vec_id AS idb FROM good a JOIN good b ON len(a.e) = len(b.e) AND a.n <> b.n
  WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}),
reach AS (SELECT a, b, ida, idb FROM links UNION SELECT r.a, l.b, r.ida, l.idb FROM reach r JOIN links l ON r.b = l.a),
found AS (
  SELECT g.vec_id, (SELECT count(*) FROM links WHERE a = g.n) AS n_links,
         least(vec_id, coalesce((SELECT min(idb) FROM reach WHERE a = g.n), vec_id)) AS component_id FROM good g
  UNION ALL
  SELECT vec_id, 0, vec_id FROM embeddings
  WHERE embedding IS NULL OR len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) > 0
    OR len(list_filter(embedding, lambda x: x <> 0)) = 0)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM found
"""
