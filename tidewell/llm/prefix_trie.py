"""Prefix trie of conversations by van Emde Boas recursion.

A conversation is the sequence of its turns, each known by a 128-bit digest. Sequences are cut at half
of the greatest depth (rounded up to a power of two): the first half goes into the upper trie, the rest
into the lower forest of the cut prefix, which is known by its name, the digest chained over its turns. Then
both are cut at half their height in the same round, and so on, so a trie of depth d takes log2(d) rounds
however its branches are spread. After each cut equal pieces of one forest become one piece with the
number of its members, so what many conversations share is carried once. Pieces of one turn are the nodes.

Totals of subtrees are grafted upward in the opposite order. Once the tries of height h have the totals within
them, each cut prefix u gets the sum over the roots of its lower forest and passes it to the h nodes on
its path within the upper trie, which are chained again from the piece that ends in u. A node is so
reached once a level, not once for each descendant.

All members of a node are never together in one place: counts are partial sums, and the ids of
conversations that end in a node are joined in slices of 4096 ids whose strings are then hashed in order
as a stream. The digests of one conversation are one row (some 24 bytes a turn), as its text would be.

Defined cases: rows without conv_id are not looked at; turns are ordered by number, null first, equal numbers
by the digest of role and text, and rows repeated in full are turns of their own; null role or text is
empty; for negative ids c - c % 20 is the multiple of 20 nearer to zero; an empty table gives no rows;
other columns are not looked at.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import map_batches, read_table, staged

FAMILY = 20  # conversations c - c % FAMILY .. share their first turns
HEADS = 4  # crc32 of the id modulo this many first turns come from the head of the family
SLICE_BITS = 12  # ids joined by one task are those that agree but for these low bits
ROOT = bytes(16)
WORDS = r"[^\x20\x09-\x0D]+"


def short(value: Column) -> Column:
    """128-bit digest of a string or of bytes."""
    return F.unhex(F.substring(F.sha2(value, 256), 1, 32))


def chained(start: Column, turns: Column) -> Column:
    """Name of the prefix that continues the prefix named ``start`` by ``turns``."""
    return F.aggregate(turns, start, lambda name, turn: short(F.concat(name, turn["token"])))


def chain(start: Column, turns: Column) -> Column:
    """``start`` and the names of all prefixes that continue it."""
    return F.aggregate(turns, F.array(start), lambda names, turn: F.concat(
        names, F.array(short(F.concat(F.element_at(names, -1), turn["token"])))))


def turns_of(table: DataFrame) -> DataFrame:
    """(conv_id, turns): the digests and numbers of words of each conversation's turns, in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    token = short(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = table.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), token.alias("token"), F.regexp_count(text, F.lit(WORDS)).cast("bigint").alias("words")).alias("at"))
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("at")).alias("turns"))
    return ordered.select("conv_id", F.transform("turns", lambda t: F.struct(t["token"], t["words"])).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the first turns of each conversation are those of the head of its family."""
    head = F.col("conv_id") - F.col("conv_id") % FAMILY
    taken = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
    heads = conversations.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("head"), F.slice("turns", 1, HEADS - 1).alias("first"))
    both = conversations.withColumns({"head": head, "taken": taken}).join(heads, "head", "left")
    rest = F.slice("turns", F.col("taken") + 1, F.greatest(F.size("turns") - F.col("taken"), F.lit(0)))
    first = F.coalesce(F.slice("first", F.lit(1), F.col("taken")), F.slice("turns", 1, 0))
    return both.select("conv_id", F.concat(first, rest).alias("turns"))


def cut(pieces: DataFrame, height: int) -> DataFrame:
    """Pieces of tries of twice the height cut in the middle; equal ones of a forest become one.

    A piece is (forest: name of the prefix it continues, start: its depth, turns, n: members, low: their least
    conv_id, more: whether any goes on after the piece).
    """
    first, size = F.slice("turns", 1, height), F.size("turns")
    long = size > height
    upper = F.struct("forest", "start", first.alias("turns"), "n", "low", (long | F.col("more")).alias("more"))
    lower = F.struct(
        chained(F.col("forest"), first).alias("forest"), (F.col("start") + height).alias("start"),
        F.slice("turns", height + 1, F.greatest(size - height, F.lit(0))).alias("turns"), "n", "low", "more")
    halves = pieces.select(F.inline(F.when(long, F.array(upper, lower)).otherwise(F.array(upper))))
    return halves.groupBy("forest", "start", "turns").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.bool_or("more").alias("more"))


def grafted(totals: DataFrame, pieces: DataFrame, height: int) -> DataFrame:
    """Totals of lower forests of a height, for all nodes on the paths of the upper tries to them.

    ``totals`` has (name, parent, depth, leaves, saved) in any number of rows a node; ``pieces`` are those of
    the cut at ``height``.
    """
    roots = totals.where((F.col("depth") - 1) % (2 * height) == height)
    forests = roots.groupBy(F.col("parent").alias("end")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    upper = pieces.where((F.col("start") % (2 * height) == 0) & (F.size("turns") == height) & F.col("more"))
    paths = upper.select("start", chain(F.col("forest"), F.col("turns")).alias("path"))
    found = paths.withColumn("end", F.element_at("path", -1)).join(forests, "end")
    steps = found.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(height))))
    return steps.select(
        F.element_at("path", F.col("step") + 1).alias("name"), F.element_at("path", F.col("step")).alias("parent"),
        (F.col("start") + F.col("step")).alias("depth"), "leaves", "saved")


def end_digests(sequences: DataFrame) -> DataFrame:
    """(name, ends_sha256): the ids of the conversations that end in a node, joined and hashed."""
    slices = sequences.groupBy("name", F.shiftright("conv_id", SLICE_BITS).alias("slice")).agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids"))
    joined = slices.select("name", "slice", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))
    ordered = joined.repartition("name").sortWithinPartitions("name", "slice")

    def run(batches):
        name = digest = None
        for batch in batches:
            names, digests = [], []
            for of, ids in zip(batch["name"].to_pylist(), batch["ids"].to_pylist()):
                if of == name:
                    digest.update(b"," + ids.encode())
                    continue
                if name is not None:
                    names.append(name)
                    digests.append(digest.hexdigest())
                name, digest = of, hashlib.sha256(ids.encode())
            yield {"name": names, "ends_sha256": digests}
        if name is not None:
            yield {"name": [name], "ends_sha256": [digest.hexdigest()]}

    return map_batches(ordered.select("name", "ids"), run, "name binary, ends_sha256 string")


def trie(sequences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes but the root (name, parent, depth, n, low), and totals (name, parent, depth, leaves, saved) in any
    number of rows a node, of (conv_id, turns)."""
    pieces = sequences.where(F.size("turns") > 0).groupBy("turns").agg(F.count("*").alias("n"), F.min("conv_id").alias("low"))
    pieces = pieces.select(
        F.lit(ROOT).alias("forest"), F.lit(0).cast("bigint").alias("start"), "turns", "n", "low", F.lit(False).alias("more"))
    deepest = sequences.agg(F.max(F.size("turns"))).first()[0] or 1
    heights = [1 << k for k in range((deepest - 1).bit_length())]
    at: dict[int, DataFrame] = {}
    for height in reversed(heights):
        pieces = at[height] = staged(cut(pieces, height), f"cut{height}")
    turn = F.col("turns")[0]
    nodes = pieces.select(
        chained(F.col("forest"), F.col("turns")).alias("name"), F.col("forest").alias("parent"), (F.col("start") + 1).alias("depth"), "n", "low",
        turn["words"].alias("words"), "more")
    nodes = staged(nodes, "nodes")
    totals = nodes.select("name", "parent", "depth", F.when(F.col("more"), 0).otherwise(1).cast("bigint").alias("leaves"),
                          ((F.col("n") - 1) * F.col("words")).alias("saved"))
    for height in heights:
        totals = totals.unionByName(staged(grafted(totals, at[height], height), f"graft{height}"))
    return nodes.select("name", "parent", "depth", "n", "low"), totals


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of ``conversations`` (conv_id, turns), the root included."""
    sequences = staged(conversations.withColumn("name", chained(F.lit(ROOT), F.col("turns"))), "sequences")
    nodes, totals = trie(sequences)
    root = sequences.agg(F.count("*").alias("n"), F.min("conv_id").alias("low")).where("n > 0").select(
        F.lit(ROOT).alias("name"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("bigint").alias("depth"), "n", "low")
    top = totals.where("depth = 1").select(F.lit(ROOT).alias("name"), "leaves", "saved")
    facts = nodes.unionByName(root)
    for more in (totals.select("name", "leaves", "saved"), top, end_digests(sequences),
                 nodes.select(F.col("parent").alias("name"), F.lit(1).cast("bigint").alias("child"))):
        facts = facts.unionByName(more, allowMissingColumns=True)
    rows = facts.groupBy("name").agg(
        *[F.max(c).alias(c) for c in ("parent", "depth", "n", "low", "ends_sha256")],
        *[F.sum(c).alias(c) for c in ("leaves", "saved", "child")])
    rows = staged(rows, "trie")
    above = rows.select(F.col("name").alias("parent"), F.col("low").alias("parent_conv_id"))
    return rows.join(above, "parent", "left").select(
        F.col("low").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"),
        F.coalesce("child", F.lit(0)).alias("n_children"),
        F.coalesce("leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved", F.lit(0)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    own = staged(turns_of(read_table(spark, folder, "conversations")), "conversations")
    return prefix_trie(rebuilt(own))


CRC32 = ("xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda ch: ord(ch)::BIGINT)), "
         "lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))")

SQL = f"""
WITH turns AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, token) AS pos, token
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
               sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS token
        FROM conversations WHERE conv_id IS NOT NULL)),
heads AS (SELECT conv_id, {CRC32.format('conv_id::VARCHAR')} % {HEADS} AS h FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT h.conv_id, 0 AS own, t.pos, t.token, t.text FROM heads h JOIN turns t ON t.conv_id = h.conv_id - h.conv_id % {FAMILY} AND t.pos <= h.h
  UNION ALL SELECT h.conv_id, 1, t.pos, t.token, t.text FROM heads h JOIN turns t ON t.conv_id = h.conv_id AND t.pos > h.h),
sequences AS (
  SELECT h.conv_id, coalesce(list(token ORDER BY own, pos) FILTER (token IS NOT NULL), []) AS s,
         coalesce(list(len(regexp_extract_all(text, '{WORDS}')) ORDER BY own, pos) FILTER (token IS NOT NULL), []) AS w
  FROM heads h LEFT JOIN rebuilt USING (conv_id) GROUP BY h.conv_id),
prefixes AS (SELECT conv_id, s[1:d] AS node, d, len(s) AS n_turns, CASE WHEN d > 0 THEN w[d] ELSE 0 END AS words
             FROM (SELECT *, unnest(range(len(s) + 1)) AS d FROM sequences)),
nodes AS (
  SELECT node, d, min(conv_id) AS low, count(*) AS n, any_value(words) AS words, bool_or(n_turns > d) AS inner_node,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n_turns = d), '')) AS ends_sha256
  FROM prefixes GROUP BY node, d),
above AS (SELECT node, n, words, inner_node, unnest(range(d + 1)) AS k FROM nodes),
totals AS (
  SELECT node[1:k] AS node, sum((NOT inner_node)::INT)::BIGINT AS leaves, sum((n - 1) * words)::BIGINT AS saved FROM above GROUP BY 1),
children AS (SELECT node[1:d - 1] AS node, count(*) AS c FROM nodes WHERE d > 0 GROUP BY 1)
SELECT v.low AS conv_id, v.d AS depth, p.low AS parent_conv_id, v.n AS n_convs, coalesce(c, 0) AS n_children, leaves AS n_leaves,
       saved AS saved_tokens, v.ends_sha256
FROM nodes v JOIN totals t ON v.node = t.node LEFT JOIN children c ON v.node = c.node
LEFT JOIN nodes p ON v.d > 0 AND p.node = v.node[1:v.d - 1]
"""
