"""Quality rules: counts per text, and bands of perplexity under an n-gram model per language.

The model is a character trigram model with modified Kneser-Ney smoothing. Spark counts
the trigrams of every text of the corpus, each character as itself; discounts, continuation counts and back-off
weights are aggregates of that table. Tasks look probabilities up in sorted arrays of
hashed n-grams. A trigram of characters backs off to the trigram of their ``SYMBOLS`` classes, times the share
of its last character in its class. Languages are hashed to ``SLOTS`` models, so the trigrams of classes have
``SLOTS * SYMBOLS ** 3`` entries at most (4.2 million, 50 MB), however large the corpus. Those of characters
(20 bytes each with their contexts) are as many as the corpus has different ones. Both are broadcast.

A document fails the base rules with fewer than 20 words or with over 30 per cent of
words in repeated 8-word windows. Others are rejected when their cross entropy lies outside
the band of their language and length: quartiles over all documents that pass the base
rules, widened by ``WIDTH`` quartile ranges on either side. Copies of a text count once per language
in the trigrams and the quartiles, however many there are; texts that differ in case are no copies
here, as their entropies differ. Every row is scored.

Defined cases: a null text has no words and fails; a null language is a language of its
own; repeated rows are counted and returned as often as they stand; an empty table gives
no rows; other columns pass through ``reject`` untouched.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.llm.common import extended, fresh, map_batches, read_table, share, staged, texts_of

MIN_WORDS = 20
MAX_REPEATED = 30  # per cent of words
REPEAT_WINDOW = 8

SYMBOLS, BITS = 64, 6  # classes of characters
SLOTS = 16  # models; a language belongs to the slot of its hash
GRAMS = SYMBOLS ** 3
EDGE = 0x110000  # stands for the edge of a text among code points
POINTS = EDGE + 1
SPELLED = 1 << 18  # characters that are spelled together
COUNTED = 1 << 20  # different trigrams of characters that a task holds before it hands counts on
CACHE_BITS = 18  # logarithms that a task keeps per slot, as a power of two

RESERVED = 0.01  # probability that all classes share evenly, seen or not

WIDTH = 3.0  # quartile ranges on either side of the quartiles
LEAST_RANGE = 0.02  # nats per character; a narrower quartile range counts as this
MIN_GROUP = 100  # documents of a language and length; with fewer, the language's band holds
STEP = 0.002  # nats; width of a bin of the histogram from which quartiles are read


def symbol_table() -> np.ndarray:
    """Class of each ASCII character; 0 stands for the edge of a text."""
    table = np.full(128, 56, np.int64)
    table[[9, 11, 12, 13, 32]] = 1
    table[10] = 2
    table[97:123] = np.arange(3, 29)
    table[65:91] = 29 + np.arange(26) % 10
    table[48:58] = 39
    for k, group in enumerate((".", ",", "!", "?", "|", "#", "$", "%", "&", "*", "-", "'\"`", "()[]{}<>", "@", "/\\", ":;")):
        for c in group:
            table[ord(c)] = 40 + k
    return table


def classes_of(points: np.ndarray) -> np.ndarray:
    """Class of each code point; classes only group what a trigram backs off to."""
    classes = np.where(points < 128, symbol_table()[np.minimum(points, 127)], 57 + points % 7)
    classes[points == EDGE] = 0
    return classes


def class_sizes() -> np.ndarray:
    """Code points of each class."""
    sizes = np.bincount(symbol_table(), minlength=SYMBOLS)
    sizes += np.bincount(57 + np.arange(128, EDGE) % 7, minlength=SYMBOLS)
    sizes[0] = 1
    return sizes


def spell_characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams of the characters of texts end to end (code points as digits to base ``POINTS``), and how many each text has.

    A text of n characters has n + 1: one that ends at each character and one at its end.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    # Two marks before each text and one behind; whatever the text holds, marks go by place.
    points = np.frombuffer("".join(f"\0\0{t}\0" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    starts = np.cumsum(sizes + 3) - (sizes + 3)
    for mark in (starts, starts + 1, starts + sizes + 2):
        points[mark] = EDGE
    grams = (points[:-2] * POINTS + points[1:-1]) * POINTS + points[2:]
    last = np.zeros(len(points) - 2, bool)  # trigrams that reach over into the next text
    for over in (starts[1:] - 2, starts[1:] - 1):
        last[over] = True
    return grams[~last], sizes + 1


def classed(grams: np.ndarray) -> np.ndarray:
    """Trigrams of classes (18 bits) of trigrams of characters."""
    pairs, c = np.divmod(grams, POINTS)
    a, b = np.divmod(pairs, POINTS)
    return (classes_of(a) << (2 * BITS)) | (classes_of(b) << BITS) | classes_of(c)


def spell(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams of classes (18 bits) of texts end to end, and how many each text has."""
    grams, sizes = spell_characters(texts)
    return classed(grams), sizes


def pieces(texts: list[str], most: int = SPELLED) -> Iterator[slice]:
    """Runs of texts of at most ``most`` characters together; a longer text is a run of its own.

    Spelling takes some sixty bytes a character, so a run bounds it, whatever the texts of a batch come to.
    """
    first, held = 0, 0
    for k, text in enumerate(texts):
        if held and held + len(text) > most:
            yield slice(first, k)
            first, held = k, 0
        held += len(text)
    if first < len(texts):
        yield slice(first, len(texts))


def spelled(texts: list[str], langs: list[str | None], spell: Callable = spell) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """Trigrams of runs of texts, how many each text has, and per slot of the run which of them are its own."""
    slots = np.fromiter(map(slot_of, langs), np.int64, len(texts))
    for run in pieces(texts):
        grams, sizes = spell(texts[run])
        of = np.repeat(slots[run], sizes)
        yield grams, sizes, [(slot, of == slot) for slot in np.unique(slots[run]).tolist()]


def slot_of(lang: str | None) -> int:
    return zlib.crc32((lang or "").encode()) % SLOTS


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Different grams and their counts, from several of both."""
    grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    counts = np.zeros(len(grams), np.int64)
    np.add.at(counts, at, np.concatenate([n for _, n in parts]))
    return grams, counts


def count_trigrams(docs: DataFrame) -> DataFrame:
    """(gram, characters, n) over all texts: a trigram of characters and that of its classes, with the slot above its 18 bits."""

    def run(batches):
        held: dict[int, list] = {}  # by slot
        size = 0

        def hand_on():
            for slot, parts in held.items():
                grams, counts = summed(parts)
                for part in np.array_split(np.arange(len(grams)), len(grams) // 50_000 + 1):
                    yield {"gram": classed(grams[part]) + slot * GRAMS, "characters": grams[part], "n": counts[part]}

        for batch in batches:
            for grams, _, own in spelled(texts_of(batch["text"]), batch["lang"].to_pylist(), spell_characters):
                for slot, mine in own:
                    seen = np.unique(grams[mine], return_counts=True)
                    held.setdefault(slot, []).append(seen)
                    size += len(seen[0])
            if size > COUNTED:
                held = {slot: [summed(parts)] for slot, parts in held.items()}
                size = sum(len(parts[0][0]) for parts in held.values())
                if 2 * size > COUNTED:
                    yield from hand_on()
                    held, size = {}, 0
        yield from hand_on()

    counted = map_batches(docs.select("text", "lang"), run, "gram bigint, characters bigint, n bigint")
    return counted.groupBy("gram", "characters").agg(F.sum("n").alias("n"))


def discounted(grams: DataFrame, count: str) -> DataFrame:
    """(slot, d1, d2, d3): the three discounts of a level, from its counts of counts.

    A level without grams seen once or twice has no estimate; discounts then are 0.5, 1 and 1.5.
    """
    seen = [F.sum((F.col(count) == k).cast("double")) for k in (1, 2, 3, 4)]
    counts = grams.groupBy("slot").agg(*[s.alias(f"c{k}") for k, s in zip((1, 2, 3, 4), seen)])
    y = F.expr("c1 / (c1 + 2 * c2)")
    known = F.expr("c1 > 0 and c2 > 0 and c3 > 0")
    return counts.select("slot", *[
        F.when(known, F.greatest(F.lit(k * 0.1), F.least(F.lit(float(k)), k - (k + 1) * y * F.col(f"c{k + 1}") / F.col(f"c{k}"))))
        .otherwise(k * 0.5).alias(f"d{k}") for k in (1, 2, 3)])


def smoothed(grams: DataFrame, count: str, lower: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Probabilities of a level, and the back-off weight of each of its contexts.

    ``grams`` has (slot, context, short, count): the last symbol of ``short`` follows
    ``context``; ``lower`` has (slot, short, p) for every ``short``.
    """
    with_d = grams.join(discounted(grams, count), "slot")
    taken = F.expr(f"case when {count} = 1 then d1 when {count} = 2 then d2 else d3 end")
    contexts = with_d.groupBy("slot", "context").agg(
        F.sum(count).alias("total"), (F.sum(taken) / F.sum(count)).alias("weight"))
    rows = with_d.join(contexts, ["slot", "context"]).join(lower, ["slot", "short"])
    p = (F.col(count) - taken) / F.col("total") + F.col("weight") * F.col("p")
    return rows.select("slot", "context", "short", p.alias("p")), contexts.select("slot", "context", "weight")


def mix(keys: np.ndarray) -> np.ndarray:
    """Hash of 64 bits; different keys have different hashes."""
    x = keys.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class HashArray:
    """Values by key: hashes in order beside their values, found by binary search."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        hashes = mix(keys)
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], values[order].astype(np.float32)

    def find(self, keys: np.ndarray, default: float) -> tuple[np.ndarray, np.ndarray]:
        """Values, and which keys are there."""
        hashes = mix(keys)
        if not len(self.hashes):
            return np.full(len(keys), default, np.float32), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        there = self.hashes[at] == hashes
        return np.where(there, self.values[at], np.float32(default)), there


class Characters:
    """Trigrams of the characters of a slot: what their counts give them, and what they leave to their classes."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, discounts: np.ndarray):
        taken = discounts[np.minimum(counts, 3) - 1]
        contexts, at = np.unique(grams // POINTS, return_inverse=True)
        total = np.bincount(at, counts)
        self.share = HashArray(grams, (counts - taken) / total[at])
        self.weight = HashArray(contexts, np.bincount(at, taken) / total)
        # As for single classes, a character counts once for every one that stands before it.
        points, before = np.unique(np.unique(grams % POINTS ** 2) % POINTS, return_counts=True)
        kinds, sizes = classes_of(points), class_sizes()
        all_of = np.bincount(kinds, before, SYMBOLS)
        self.rest = np.where(all_of > 0, RESERVED, 1) / sizes  # of a character that was not seen
        self.within = HashArray(points, (1 - RESERVED) * before / all_of[kinds] + RESERVED / sizes[kinds])

    def log_p(self, grams: np.ndarray, of_classes: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of each gram, from that of its classes."""
        last = grams % POINTS
        within, known = self.within.find(last, 0)
        within = np.where(known, within, self.rest[classes_of(last)])
        share, _ = self.share.find(grams, 0)
        weight, _ = self.weight.find(grams // POINTS, 1)
        return np.log(share + weight * np.exp(of_classes) * within)


class Known:
    """Logarithms of the grams met last, at the place of their hash; of two grams of a place one is kept."""

    def __init__(self):
        self.grams, self.values = np.full(1 << CACHE_BITS, -1, np.int64), np.zeros(1 << CACHE_BITS)

    def find(self, grams: np.ndarray, compute: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        places = (mix(grams) >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
        found, new = self.values[places], self.grams[places] != grams
        if new.any():
            missing, back = np.unique(grams[new], return_inverse=True)
            made = compute(missing)
            found[new] = made[back]
            kept, first = np.unique(mix(missing) >> np.uint64(64 - CACHE_BITS), return_index=True)
            self.grams[kept], self.values[kept] = missing[first], made[first]
        return found


class Model:
    """Probabilities of trigrams with back-off to shorter n-grams."""

    def __init__(self, tri, tri_weight, bi, bi_weight, uni, characters: dict[int, Characters]):
        self.tri, self.tri_weight, self.bi, self.bi_weight, self.uni = tri, tri_weight, bi, bi_weight, uni
        self.characters = characters

    def characters_log_p(self, slot: int, grams: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of each trigram of characters in a slot."""
        return self.characters[slot].log_p(grams, self.log_p(classed(grams) + slot * GRAMS))

    def log_p(self, grams: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of each gram of classes, its slot above its 18 bits."""
        slot, abc = grams >> (3 * BITS), grams & (GRAMS - 1)
        ab, bc, b, c = abc >> BITS, abc & (SYMBOLS ** 2 - 1), (abc >> BITS) & (SYMBOLS - 1), abc & (SYMBOLS - 1)
        p, there = self.tri.find(grams, 0)
        p1, _ = self.uni.find(slot * SYMBOLS + c, RESERVED / SYMBOLS)
        p2, there2 = self.bi.find(slot * SYMBOLS ** 2 + bc, 0)
        w2, _ = self.bi_weight.find(slot * SYMBOLS + b, 1)
        p2 = np.where(there2, p2, w2 * p1)
        w3, _ = self.tri_weight.find(slot * SYMBOLS ** 2 + ab, 1)
        return np.log(np.maximum(np.where(there, p, w3 * p2), 1e-12)).astype(np.float64)


def digest(text: str) -> Column:
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def once_each(docs: DataFrame) -> DataFrame:
    """(text, lang) of ``docs`` without copies."""
    return docs.groupBy("lang", digest("text").alias("digest")).agg(F.min("text").alias("text")).select("text", "lang")


def train(docs: DataFrame) -> Model:
    """Model of the texts of ``docs``, every one of them counted."""
    counted = staged(count_trigrams(docs), "character_trigrams")
    tri = staged(counted.groupBy("gram").agg(F.sum("n").alias("n")), "trigrams").select(
        F.shiftright("gram", 18).alias("slot"), F.shiftright("gram", 6).bitwiseAND(F.lit(SYMBOLS ** 2 - 1)).alias("context"),
        F.col("gram").bitwiseAND(F.lit(SYMBOLS ** 2 - 1)).alias("short"), "n")
    bi = tri.groupBy("slot", "short").agg(F.count("*").alias("n")).select(
        "slot", F.shiftright("short", 6).alias("context"), F.col("short").alias("gram"),
        F.col("short").bitwiseAND(F.lit(SYMBOLS - 1)).alias("short"), "n")
    uni = bi.groupBy("slot", "short").agg(F.count("*").alias("n"))
    all_uni = uni.groupBy("slot").agg(F.sum("n").alias("total"))
    p1 = uni.join(all_uni, "slot").select("slot", "short", ((1 - RESERVED) * F.col("n") / F.col("total") + RESERVED / SYMBOLS).alias("p"))
    p2, w2 = smoothed(bi.drop("gram"), "n", p1)
    p2, w2 = staged(p2, "bigrams"), staged(w2, "bigram_weights")
    lower = p2.select("slot", ((F.col("context") * SYMBOLS) + F.col("short")).alias("short"), "p")
    p3, w3 = smoothed(tri, "n", lower)

    def array(df: DataFrame, key: Column, value: str) -> HashArray:
        # At most SLOTS * SYMBOLS ** 3 rows of 12 bytes, by the spelling.
        got = df.select(key.cast("bigint").alias("key"), F.col(value).cast("float").alias("value")).toArrow()
        return HashArray(got["key"].to_numpy(), got["value"].to_numpy())

    def characters() -> dict[int, Characters]:
        of_slot = counted.withColumn("slot", F.shiftright("gram", 18))
        discounts = {r["slot"]: np.array([r["d1"], r["d2"], r["d3"]]) for r in discounted(of_slot, "n").collect()}
        got = of_slot.select("slot", "characters", "n").toArrow()
        slots, grams, counts = (got[name].to_numpy() for name in ("slot", "characters", "n"))
        none = np.array([0.5, 1.0, 1.5])
        return {k: Characters(grams[slots == k], counts[slots == k], discounts.get(k, none)) for k in range(SLOTS)}

    slot, context, short = F.col("slot"), F.col("context"), F.col("short")
    p3 = p3.withColumn("last", short.bitwiseAND(F.lit(SYMBOLS - 1)))
    return Model(
        tri=array(p3, slot * GRAMS + context * SYMBOLS + F.col("last"), "p"),
        tri_weight=array(w3, slot * SYMBOLS ** 2 + context, "weight"),
        bi=array(p2, slot * SYMBOLS ** 2 + context * SYMBOLS + short, "p"),
        bi_weight=array(w2, slot * SYMBOLS + context, "weight"),
        uni=array(p1, slot * SYMBOLS + short, "p"),
        characters=characters())


def repeated_words(words: list[bytes], width: int = REPEAT_WINDOW) -> int:
    """Words in windows of ``width`` words that stand at two places or more.

    Ranks are doubled: equal pairs of equal parts get equal numbers, so no hash decides.
    """
    if len(words) <= width:
        return 0
    seen: dict[bytes, int] = {}
    ranks = np.fromiter(map(seen.setdefault, words, range(len(words))), np.int64, len(words))
    if len(seen) == len(words):
        return 0
    span = 1
    while span < width:
        pairs = ranks[:-span] * (len(words) + 1) + ranks[span:]
        values, ranks = np.unique(pairs, return_inverse=True)
        if len(values) == len(pairs):
            return 0
        span *= 2
    twice = np.bincount(ranks)[ranks] > 1
    covered = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + width, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at the six ASCII blanks and nothing else
    blanks = sum(map(raw.count, (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")))
    symbols = sum(map(raw.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(words), len(text) - blanks, symbols, len(lines) - len(set(lines)), repeated_words(words)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
ADDED = (*COUNTS, "base_failed", "entropy", "size_class")


def score(docs: DataFrame, model: Model, names: list[str]) -> DataFrame:
    """``docs`` with the columns of ``ADDED`` under the given names."""
    shared = share(docs.sparkSession, model)
    kinds = dict.fromkeys(COUNTS, "bigint") | {"base_failed": "boolean", "entropy": "double", "size_class": "int"}
    schema = extended(docs.schema, ", ".join(f"`{name}` {kind}" for name, kind in zip(names, kinds.values())))

    def run(batches):
        trained = shared()
        known: dict[int, Known] = {}  # by slot; most grams are looked up once in a task
        for batch in batches:
            texts = texts_of(batch["text"])
            entropies, all_sizes = [], []
            for grams, sizes, own in spelled(texts, batch["lang"].to_pylist(), spell_characters):
                found = np.empty(len(grams))
                for slot, mine in own:
                    if slot not in known:
                        known[slot] = Known()
                    found[mine] = known[slot].find(grams[mine], partial(trained.characters_log_p, slot))
                entropies.append(-np.add.reduceat(found, np.cumsum(sizes) - sizes) / sizes)
                all_sizes.append(sizes)
            entropy, sizes = np.concatenate(entropies), np.concatenate(all_sizes)
            counts = np.array([base_counts(t) for t in texts], np.int64).T
            failed = (counts[0] < MIN_WORDS) | (100 * counts[4] > MAX_REPEATED * counts[0])
            made = [*counts, failed, entropy, np.log2(sizes).astype(np.int32)]
            yield batch | dict(zip(names, made))

    return map_batches(docs, run, schema)


def bands(scored: DataFrame) -> DataFrame:
    """(lang, size_class, low, high) from documents that pass the base rules.

    Copies, known by ``digest``, count once.
    Quartiles are read from a histogram, so no group of documents comes together.
    """
    once = scored.where(~F.col("base_failed")).groupBy("lang", "digest", "size_class").agg(F.min("entropy").alias("entropy"))
    bins = once.select(
        F.coalesce("lang", F.lit("")).alias("lang"), F.col("lang").isNull().alias("no_lang"),
        F.explode(F.array("size_class", F.lit(-1))).alias("size_class"), F.floor(F.col("entropy") / STEP).alias("bin"))
    keys = ["lang", "no_lang", "size_class"]  # class -1 is the whole language
    counts = bins.groupBy(*keys, "bin").agg(F.count("*").alias("n"))
    upto = Window.partitionBy(*keys).orderBy("bin")
    share = counts.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(Window.partitionBy(*keys)))
    quartiles = share.groupBy(*keys).agg(
        F.max("all").alias("all"),
        F.min(F.when(F.col("upto") >= 0.25 * F.col("all"), F.col("bin"))).alias("q1"),
        F.min(F.when(F.col("upto") >= 0.75 * F.col("all"), F.col("bin") + 1)).alias("q3"))
    wide = F.greatest((F.col("q3") - F.col("q1")) * STEP, F.lit(LEAST_RANGE)) * WIDTH
    return quartiles.where((F.col("size_class") < 0) | (F.col("all") >= MIN_GROUP)).select(
        *keys, (F.col("q1") * STEP - wide).alias("low"), (F.col("q3") * STEP + wide).alias("high"))


def verdict(scored: DataFrame, limits: DataFrame, names: dict[str, str], kept: str) -> DataFrame:
    """``scored`` with a column ``kept``: base rules passed and entropy within its band."""
    n_lang, n_none, n_size, low, high, low_all, high_all = fresh(
        scored, "band_lang", "band_none", "band_size", "low", "high", "low_all", "high_all")
    own = limits.where("size_class >= 0").toDF(n_lang, n_none, n_size, low, high)
    language = limits.where("size_class < 0").drop("size_class").toDF(n_lang, n_none, low_all, high_all)
    same = [F.coalesce(scored["lang"], F.lit("")), scored["lang"].isNull()]
    joined = scored.join(own, (same[0] == own[n_lang]) & (same[1] == own[n_none]) & (scored[names["size_class"]] == own[n_size]), "left")
    joined = joined.drop(n_lang, n_none, n_size)
    joined = joined.join(language, (F.coalesce(F.col("lang"), F.lit("")) == language[n_lang])
                         & (F.col("lang").isNull() == language[n_none]), "left").drop(n_lang, n_none)
    inside = F.col(names["entropy"]).between(F.coalesce(low, low_all), F.coalesce(high, high_all))
    return joined.withColumn(kept, ~F.col(names["base_failed"]) & F.coalesce(inside, F.lit(True))).drop(low, high, low_all, high_all)


def assess(docs: DataFrame) -> DataFrame:
    """doc_id, lang, the counts, base_failed, entropy, size_class, kept for every document."""
    docs = docs.select("doc_id", "text", "lang")
    scored = score(docs, train(once_each(docs)), list(ADDED))
    scored = staged(scored.withColumn("digest", digest("text")).drop("text"), "scored")
    return verdict(scored, staged(bands(scored), "bands"), dict(zip(ADDED, ADDED)), "kept")


def reject(docs: DataFrame) -> DataFrame:
    """``docs`` without the rejected ones, all columns as they were."""
    *names, kept, same = fresh(docs, *ADDED, "kept", "digest")
    # Texts are scored once; bands and verdicts read what was written.
    scored = staged(score(docs, train(once_each(docs)), names).withColumn(same, digest("text")), "scored")
    measured = scored.select("lang", F.col(same).alias("digest"), *[F.col(n).alias(a) for n, a in zip(names, ADDED)])
    marked = verdict(scored, staged(bands(measured), "bands"), dict(zip(ADDED, names)), kept)
    return marked.where(kept).select(*docs.columns)


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = assess(read_table(spark, folder, "documents"))
    return rows.select("doc_id", *COUNTS, "base_failed", "kept", F.exp("entropy").alias("perplexity"))
