"""Jaccard self-join of word shingle sets through prefixes of tokens and of token combinations.

A document is its set of distinct 5-word shingles; sets of Jaccard similarity 0.75 or more
link. Tokens are 64-bit hashes of shingles and a set is known by the 64-bit hash of its
tokens, so documents with equal sets are one vertex from the start.

1. Sets without partners go first. Linked sets x, y share at least 75% of the larger one. A fixed
   part of the hash space (``SKETCH``) is sent, token by token, to where equal tokens meet;
   a set stays only if enough of its tokens there occur in a second set.
2. For the sets that stay, tokens are counted exactly and ordered, rare ones first. The first
   |x| - ceil(0.75 |x|) + 1 tokens of x (its prefix) hold one of any linked partner's prefix. Where the
   prefix reaches frequent tokens (in more than ``FREQUENT`` sets), it is extended by g tokens: linked
   sets then share g + 1 tokens of their extended prefixes, of which either one is rare, and its key
   is the token, or two lie in the same one of g classes of frequent tokens, and their key is the
   combination of the two.
3. Members of a key are compared with ``CENTRES`` of them, and the links found are joined into
   components. Only keys whose members still lie in several components are compared in
   full, and only across components, a pair under the first key that both have. Sizes and parities of
   the tokens in 1024 classes (sets differ in at least as many tokens as parities) prune pairs
   inside the joins; what is left is verified on whole sets.

Nothing is capped: hot keys are reduced by components, not cut.

Defined cases: null, empty and blank texts have no shingles and are linked with nothing; texts of
1 to 4 words have one shingle; a row without doc_id has no component (null) and names none;
rows that repeat a doc_id are returned each; an empty table gives no rows; other columns are
not looked at.
"""

from __future__ import annotations

import string

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.llm.common import fresh, lists_of, map_batches, read_table, staged, texts_of

WORDS = 5
PER_CENT = 75
SKETCH = 0.35  # part of the hash space used to leave sets without partners out
FREQUENT = 64  # sets that hold a token; above it the token is keyed by combinations
SMALL = 16  # sets of fewer tokens use no combinations
CENTRES = 3

FOLD = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
ODD = np.uint64(0x9E3779B97F4A7C15)
U32, U29 = np.uint64(32), np.uint64(29)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U32)) * ODD
    return x ^ (x >> U29)


def tokens_of(text: str) -> np.ndarray:
    """Distinct shingle hashes of a text, in order."""
    words = text.encode("utf-8", "surrogatepass").translate(FOLD).split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    n = len(words) - width + 1
    rolled = np.full(n, width, np.uint64)
    for k in range(width):
        rolled = mixed(rolled * ODD + hashes[k:k + n])
    return np.unique(rolled)


def set_id(tokens: np.ndarray) -> int:
    """Signed 64-bit id of a set of tokens."""
    value = xxhash.xxh3_64_intdigest(tokens.tobytes())
    return value - (1 << 64) if value >> 63 else value


def allowed_misses(n):
    """Tokens of a set of n that a linked partner may lack."""
    return n - (PER_CENT * n + 99) // 100


# Rows of the first exchange: what a row says is packed with its kind into ``val``.
TOKEN, COUNTED_TOKEN, SET, DOCUMENT, NAMELESS = 0, 1, 2, 3, 4
KIND_BITS, HITS_BITS = 3, 28
LIMIT = np.uint64(int(SKETCH * 2 ** 32))


def sketch_rows(docs: DataFrame) -> DataFrame:
    """Tokens in the sketch, sets with what they need, and documents, one row each.

    Tokens that several sets of a batch hold are counted there and sent on once, so a
    frequent token sends a row per batch and not per document.
    """

    def run(batches):
        for batch in batches:
            ids = batch["doc_id"]
            sets: dict[int, np.ndarray] = {}
            of_row, n_row = [], []
            for text in texts_of(batch["text"]):
                tokens = tokens_of(text)
                sid = set_id(tokens) if len(tokens) else None
                if sid is not None:
                    sets.setdefault(sid, tokens)
                of_row.append(sid)
                n_row.append(len(tokens))
            n_row = np.array(n_row, np.int64) << KIND_BITS
            named = ids.is_valid().to_numpy(zero_copy_only=False)
            spread = mixed((np.arange(len(n_row)) + n_row).astype(np.uint64)).view(np.int64)
            yield {"key": np.where(named, ids.fill_null(0).to_numpy(), spread), "sid": of_row, "val": n_row + np.where(named, DOCUMENT, NAMELESS)}
            if not sets:
                continue
            sids = np.fromiter(sets, np.int64, len(sets))
            sizes = np.fromiter(map(len, sets.values()), np.int64, len(sets))
            tokens = np.concatenate(list(sets.values()))
            owner = np.repeat(np.arange(len(sids)), sizes)
            inside = (tokens >> U32) < LIMIT
            tokens, owner = tokens[inside], owner[inside]
            order = np.argsort(tokens, kind="stable")
            tokens, owner = tokens[order], owner[order]
            first = np.r_[True, tokens[1:] != tokens[:-1]] if len(tokens) else np.empty(0, bool)
            group = np.cumsum(first) - 1
            several = np.bincount(group)[group] > 1 if len(tokens) else first
            hits = np.bincount(owner[several], minlength=len(sids))
            needed = np.bincount(owner, minlength=len(sids)) - allowed_misses(sizes)
            yield {"key": sids, "sid": sids, "val": (((np.maximum(needed, 0) << HITS_BITS) + hits) << KIND_BITS) + SET}
            yield {"key": tokens[first], "sid": sids[owner[first]],
                   "val": np.where(several[first], COUNTED_TOKEN, TOKEN)}

    return map_batches(docs.select("doc_id", "text"), run, "key bigint, sid bigint, val bigint")


def meet(rows: DataFrame) -> DataFrame:
    """(kind, id, sid, val): documents, sets, and one row for each further token that a set shares.

    Equal tokens come together in order; the least and greatest set of a token tell whether
    there are several. Tokens without a second set, most of them, end here.
    """
    kind = F.col("val").bitwiseAND(F.lit((1 << KIND_BITS) - 1))
    # Documents stand by themselves wherever they fall.
    same = Window.partitionBy("key")
    seen = rows.withColumn("kind", kind).withColumn("least", F.min("sid").over(same)).withColumn("greatest", F.max("sid").over(same))
    told = (F.col("kind") >= SET) | (F.col("kind") == TOKEN) & (F.col("least") < F.col("greatest"))
    return seen.where(told).select("kind", "key", "sid", F.shiftright("val", KIND_BITS).alias("val"))


BITS = 1024
PARITY = tuple(f"p{k}" for k in range(BITS // 64))  # bit h is set if an odd number of tokens hash to h


def sets_of(docs: DataFrame) -> DataFrame:
    """(sid, n, parity, tokens) of each text that has any."""

    def run(batches):
        for batch in batches:
            sets = [t for t in map(tokens_of, texts_of(batch["text"])) if len(t)]
            if not sets:
                continue
            parity = np.zeros((len(sets), len(PARITY)), np.uint64)
            for k, tokens in enumerate(sets):
                odd = np.bincount((tokens & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
                parity[k] = np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)
            sizes = [len(t) for t in sets]
            yield {"sid": [set_id(t) for t in sets], "n": sizes, "tokens": lists_of(np.concatenate(sets), sizes)} | {
                p: np.ascontiguousarray(parity[:, k]) for k, p in enumerate(PARITY)}

    return map_batches(docs.select("text"), run, f"sid bigint, n bigint, {', '.join(f'{p} bigint' for p in PARITY)}, tokens array<bigint>")


def size_classes(n: int) -> list[int]:
    """Numbers of classes of frequent tokens for which a set of n gives combinations.

    A pair uses the number of its larger set. That is this set's own, or the next one
    where a linked partner can be so much larger.
    """
    own = n.bit_length() - 1
    wanted = [own] if n * 100 // PER_CENT < 1 << (own + 1) else [own, own + 1]
    return [max(1, (1 << k) // 8) for k in wanted]


def prefix_keys(n: int, counts: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Keys of a set of n from its tokens that other sets hold, rare ones first.

    ``counts`` says in how many sets each of ``tokens`` is; the other tokens of the set are in
    no other set and come first in its order, so they take their places in the prefix.
    """
    length = allowed_misses(n) + 1 - (n - len(tokens))
    if length <= 0:
        return np.empty(0, np.uint64)
    frequent = counts > FREQUENT
    if n < SMALL or not frequent[:length].any():
        return tokens[:length]
    # A linked partner may be below SMALL, where frequent tokens stand alone too.
    keys = [tokens[:length] if n * PER_CENT < SMALL * 100 else tokens[:length][~frequent[:length]]]
    for classes in size_classes(n):
        reach = min(len(tokens), length + classes)
        rare = tokens[:reach][~frequent[:reach]]
        keys.append(rare)
        often = np.sort(tokens[:reach][frequent[:reach]])
        label = often % np.uint64(classes)
        often = often[np.argsort(label, kind="stable")]
        ends = np.cumsum(np.bincount(label.astype(np.int64), minlength=classes))
        start = 0
        for end in ends:
            members = often[start:end]
            if len(members) > 1:
                i, j = np.triu_indices(len(members), 1)
                keys.append(mixed(mixed(members[i] + np.uint64(classes)) * ODD + members[j]))
            start = end
    return np.unique(np.concatenate(keys))


def prefix_rows(sets: DataFrame) -> DataFrame:
    """(key, sid): each set under each of its keys."""
    tokens = sets.select("sid", F.explode("tokens").alias("token"))
    counts = tokens.groupBy("token").agg(F.count("*").alias("count")).where("count > 1")
    held = tokens.join(counts, "token").groupBy("sid").agg(
        F.sort_array(F.collect_list(F.struct("count", "token"))).alias("held"))
    rows = sets.select("sid", "n").join(held, "sid")
    flat = rows.select("sid", "n", F.col("held.count").alias("counts"), F.col("held.token").alias("tokens"))

    def run(batches):
        for batch in batches:
            n = batch["n"].to_pylist()
            ends = np.cumsum(batch["tokens"].value_lengths().to_numpy())
            counts, tokens = batch["counts"].flatten().to_numpy(), batch["tokens"].flatten().to_numpy().view(np.uint64)
            keys = [prefix_keys(n[k], counts[(ends[k - 1] if k else 0):end], tokens[(ends[k - 1] if k else 0):end])
                    for k, end in enumerate(ends)]
            owner = batch["sid"].to_numpy().repeat([len(k) for k in keys])
            flat_keys = np.concatenate(keys)
            for at in range(0, len(owner), 100_000):
                yield {"key": flat_keys[at:at + 100_000], "sid": owner[at:at + 100_000]}

    return map_batches(flat, run, "key bigint, sid bigint")


def distinct_groups(keyed: DataFrame) -> DataFrame:
    """``keyed`` with one key of those that have the same members, and none with a single member."""
    members = keyed.groupBy("key").agg(
        F.count("*").alias("members"), *[F.bit_xor(F.xxhash64("sid", F.lit(k))).alias(f"who{k}") for k in (1, 2)])
    kept = members.where("members > 1").groupBy("members", "who1", "who2").agg(F.min("key").alias("key"))
    return keyed.join(kept.select("key"), "key", "left_semi")


def may_link(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """False only for pairs that can't link: a and b differ in at most a seventh of |a| + |b| tokens
    (the same as a Jaccard similarity of 3/4), and parities differ in no more places."""
    total = a["n"] + b["n"]
    apart = F.abs(a["n"] - b["n"]) * 7 <= total
    places = sum((F.bit_count(a[p].bitwiseXOR(b[p])) for p in PARITY[1:]), F.bit_count(a[PARITY[0]].bitwiseXOR(b[PARITY[0]])))
    return apart & (places * 7 <= total)


def columns_of(prefix: str) -> dict[str, Column]:
    return {c: F.col(f"{prefix}{c}") for c in ("sid", "n", *PARITY)}


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows of ``pairs`` (a, b) whose sets link."""
    tokens = sets.select("sid", "tokens")
    left = pairs.distinct().join(tokens.toDF("a", "ta"), "a")
    both = left.join(tokens.toDF("b", "tb"), "b")
    common = F.size(F.array_intersect("ta", "tb"))
    return both.where(100 * common >= PER_CENT * (F.size("ta") + F.size("tb") - common)).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(sid, component): the least vertex that links reach, by alternating large and small stars."""
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "edges")

    def mark(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    def star(edges: DataFrame, both_ways: bool) -> DataFrame:
        """Neighbours of each u (the greater ones, or the lesser ones and u itself) under its least neighbour."""
        if both_ways:
            near = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            near = edges
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = near.join(least, "u")
        if both_ways:
            made = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            made = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
        return made.where("u > v").distinct()

    before = mark(edges)
    while before[0]:
        edges = staged(star(star(edges, True), False), "edges")
        now = mark(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("sid"), F.col("v").alias("component"))


def linked_sets(sets: DataFrame) -> DataFrame:
    """(sid, component) of the sets that link with another one."""
    keyed = distinct_groups(staged(prefix_rows(sets), "keys"))
    keyed = staged(keyed.join(sets.select("sid", "n", *PARITY), "sid"), "groups")
    member = F.struct("sid", "n", *PARITY)
    groups = keyed.groupBy("key").agg(
        *[F.min_by(member, F.xxhash64("sid", F.lit(k))).alias(f"centre{k}") for k in range(CENTRES)])
    a = columns_of("")
    centres = F.array(*[f"centre{k}" for k in range(CENTRES)])
    near = F.filter(centres, lambda c: (c["sid"] != a["sid"]) & may_link(a, {k: c[k] for k in a}))
    tried = keyed.join(groups, "key").select("sid", F.explode(F.transform(near, lambda c: c["sid"])).alias("other"))
    pairs = tried.select(F.least("sid", "other").alias("a"), F.greatest("sid", "other").alias("b"))
    links = staged(verified(pairs, sets), "links")

    placed = keyed.join(components(links), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    placed = staged(placed, "placed")
    apart = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    live = placed.join(apart, "key", "left_semi")
    # A pair is compared under the first key that both have, and under no other.
    keys_of = live.groupBy("sid").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    live = staged(live.join(keys_of, "sid"), "live")
    x, y = [live.select("key", *[F.col(c).alias(f"{side}_{c}") for c in ("sid", "n", *PARITY, "component", "keys")]) for side in "ab"]
    first = F.element_at(F.array_intersect("a_keys", "b_keys"), 1) == x["key"]
    across = x.join(y, (x["key"] == y["key"]) & (F.col("a_component") < F.col("b_component"))
                    & may_link(columns_of("a_"), columns_of("b_")) & first)
    rest = staged(verified(across.select(F.col("a_sid").alias("a"), F.col("b_sid").alias("b")), sets), "rest")
    return components(links.unionAll(rest))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (its least doc_id)."""
    profile = staged(meet(sketch_rows(docs)), "profile")
    rows = profile.where(F.col("kind") >= DOCUMENT).select(
        F.when(F.col("kind") == DOCUMENT, F.col("key")).alias("doc_id"), "sid", F.col("val").alias("n_shingles"))
    is_set = F.col("kind") == SET
    hits = F.when(is_set, F.col("val").bitwiseAND(F.lit((1 << HITS_BITS) - 1))).otherwise(1)
    alive = profile.where(F.col("kind") <= SET).groupBy("sid").agg(
        F.sum(hits).alias("hits"), F.max(F.when(is_set, F.shiftright("val", HITS_BITS))).alias("needed")).where("hits >= needed").select("sid")
    # One document per set that stays: its text gives the set.
    named = rows.where("doc_id is not null and sid is not null").join(alive, "sid", "left_semi")
    chosen = named.groupBy("sid").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
    texts = docs.select("doc_id", "text").join(chosen, "doc_id", "left_semi")
    sets = staged(sets_of(texts).dropDuplicates(["sid"]), "sets")
    placed = rows.join(linked_sets(sets), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    least = placed.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    joined = placed.join(least, "component", "left")
    return joined.select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, the one with the least id, all columns kept.

    Rows without an id stay, and so do rows that repeat an id that stays.
    """
    found = near_duplicates(docs)
    gone = found.where("component_id < doc_id").select("doc_id").distinct()
    (name,) = fresh(docs, "gone_id")
    return docs.join(gone.withColumnRenamed("doc_id", name), F.col("doc_id") == F.col(name), "left_anti")


def op9_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read_table(spark, folder, "documents"))


SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                                    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                      WHEN len(w) < {WORDS} THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - {WORDS} + 2), lambda i: array_to_string(w[i:i + {WORDS} - 1], ' ')))
                 END AS s
  FROM words),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS token FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS an, b.n AS bn, count(*) AS common
  FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * common >= {PER_CENT} * (an + bn - common)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce((SELECT min(b) FROM reach WHERE a = doc_id), doc_id)) AS component_id
FROM sets
"""
