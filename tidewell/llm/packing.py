"""Packing of tokenised documents into sequences of at most ``LIMIT`` tokens.

Only lengths matter to a packing, and there are at most ``LIMIT`` of them: Spark counts the
pieces of each length, and the plan is made on the driver from that histogram, whose size
doesn't depend on the corpus. Patterns of two and three lengths that fill a sequence
exactly are enumerated; non-negative least squares fits how often each is used to the
histogram; the fit is rounded down; what is left is packed largest first, each time with
the largest length that still fits, a pattern at a time and as often as the counts allow.
The plan says, for ranges of numbers of the pieces of a length, where they go. Spark numbers the pieces
of each length, and each piece finds its place by binary search.

Defined cases: a null or empty text is one piece with the end mark alone; a special token that stands in a
text has its own id, as the tokenizer gives it; rows that repeat
an id are packed each; a null id is packed like any other; an empty table gives no rows;
other columns are not looked at.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.llm.byte_bpe import byte_characters
from tidewell.llm.common import extended, map_batches, read_table, share, staged, texts_of, worker_state

LIMIT = 4096
END = 1  # id behind each document
VOCABULARY = "word_bpe_49k.json"
KNOWN_WORDS = 600_000  # words whose ids a worker keeps; when full it starts again
LONGEST_KNOWN = 48  # bytes of a word that is kept
PARTNERS = 12  # triples enumerated for each length
STEPS = 200  # of the least-squares fit
BLOCK = 1 << 16  # rows of a file that are numbered together


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class WordIds(dict):
    """Ids of words, as bytes, under a tokenizer that drops white space and lower-cases.

    Its tokens never span ASCII white space, nor a letter and a mark behind it, and its first
    step, Unicode's normal form, changes no ASCII text. So each distinct word is encoded once, without the
    marks that end a sentence and, if it has letters alone, in lower case and as the model itself spells it. A text
    in which a special token may stand, whatever its case, is encoded as a whole.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [token.content.lower() for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.parts: dict[bytes, bytes] = {}
        self.spelling = byte_characters()

    def __missing__(self, word: bytes) -> bytes:
        core = word.rstrip(b".,;:!?")
        if core and len(core) < len(word) and ends_in_letter(core):
            ids = self.part(core) + self.part(word[len(core):])
        else:
            ids = self.part(word)
        if len(word) <= LONGEST_KNOWN:
            if len(self) >= KNOWN_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def part(self, part: bytes) -> bytes:
        word = None  # in lower case, where that is sure to be what the tokenizer makes of it
        if part.isascii():
            part = part.lower()
            if part.isalpha():
                word = part.decode()
        elif plain_letters(text := part.decode()):
            part = text.lower().encode()
            word = "".join([self.spelling[b] for b in part])
        ids = self.parts.get(part)
        if ids is None:
            if word:
                ids = array("I", [t.id for t in self.model.tokenize(word)]).tobytes()
            else:
                ids = array("I", self.tokenizer.encode(part.decode(), add_special_tokens=False).ids).tobytes()
            if len(part) <= LONGEST_KNOWN:
                if len(self.parts) >= KNOWN_WORDS:
                    self.parts.clear()
                self.parts[part] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        return [self.encode_whole(t) if self.may_hold_special(t) else b"".join(map(self.__getitem__, t.encode().split())) for t in texts]

    def may_hold_special(self, text: str) -> bool:
        lower = text.lower()
        return any(token in lower for token in self.special)

    def encode_whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


def plain_letters(word: str) -> bool:
    """Whether a word has letters of the older, stable part of Unicode alone, each with one lower-case letter
    that doesn't depend on its neighbours, and is in normal form."""
    return (word.isalpha() and max(word) < "\u0530" and unicodedata.is_normalized("NFC", word)
            and "\u0130" not in word and "\u03a3" not in word)


def ends_in_letter(word: bytes) -> bool:
    """Whether the last character is a letter of the older, stable part of Unicode."""
    if word[-1] < 128:
        return word[-1:].isalpha()
    last = word.decode()[-1]
    return last.isalpha() and last < "\u0530" and len(last.lower()) == 1


def pieces(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document."""
    path = path or vocabulary_path()
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")

    def run(batches):
        coder = worker_state("word_ids", lambda: WordIds(path))
        end = array("I", [END]).tobytes()
        for batch in batches:
            rows = [[], [], [], [], [], []]
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), coder.encode(texts_of(batch["text"]))):
                ids += end
                for k in range(0, len(ids), 4 * LIMIT):
                    part = ids[k:k + 4 * LIMIT]
                    for column, value in zip(rows, (doc_id, k // (4 * LIMIT), k // 4, len(part) // 4, zlib.crc32(part))):
                        column.append(value)
                    if with_ids:
                        rows[5].append(np.frombuffer(part, np.uint32).astype(np.int32))
            yield dict(zip(("doc_id", "piece", "start", "length", "ids_crc32", "ids"), rows))

    return map_batches(docs.select("doc_id", "text"), run, schema)


def few_document_patterns(there: np.ndarray, limit: int) -> np.ndarray:
    """Rows of three lengths (0: none) that add up to ``limit``; ``there`` marks the lengths that occur."""
    a = np.arange(1, limit // 2 + 1)
    pairs = np.stack([a, limit - a, np.zeros_like(a)], 1)
    first = np.repeat(np.arange(1, limit - 1), PARTNERS)
    nth = np.tile(np.arange(PARTNERS), limit - 2)
    # Second lengths spread evenly over what the first leaves, at another place for each first.
    second = 1 + ((nth + (first * 0.618) % 1) / PARTNERS * (limit - first - 1)).astype(np.int64)
    triples = np.stack([first, second, limit - first - second], 1)
    rows = np.unique(np.sort(np.concatenate([pairs, triples[triples[:, 2] > 0]]), 1), axis=0)
    ok = np.r_[True, there[1:]]
    return rows[ok[rows].all(1)]


def fit_counts(patterns: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Non-negative repeats whose lengths come closest, in squares, to the histogram."""
    size = len(histogram)

    def lengths(x):
        total = np.bincount(patterns.ravel(), np.repeat(x, 3), minlength=size)
        total[0] = 0
        return total

    def back(r):
        r = r.copy()
        r[0] = 0
        return r[patterns].sum(1)

    x = np.ones(len(patterns))
    for _ in range(20):  # the largest eigenvalue gives the step
        x = back(lengths(x))
        scale = np.linalg.norm(x)
        x /= scale
    step = 1 / (1.05 * scale)
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(STEPS):
        new = np.maximum(0, y - step * back(lengths(y) - histogram))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan_patterns(histogram: np.ndarray, limit: int = LIMIT) -> list[tuple[dict[int, int], int]]:
    """(lengths with their number in a sequence, repeats), together using up the histogram."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    plan: list[tuple[dict[int, int], int]] = []

    def use(pattern: dict[int, int]) -> None:
        repeats = min(int(left[k]) // n for k, n in pattern.items())
        for k, n in pattern.items():
            left[k] -= repeats * n
        plan.append((pattern, repeats))

    if left[limit]:
        use({limit: 1})
    patterns = few_document_patterns(left > 0, limit)
    if len(patterns):
        repeats = np.floor(fit_counts(patterns, left.astype(np.float64))).astype(np.int64)
        for row in np.argsort(-repeats, kind="stable")[:int((repeats > 0).sum())]:
            pattern = dict(Counter(int(k) for k in patterns[row] if k))
            most = min(int(left[k]) // n for k, n in pattern.items())
            if times := min(most, int(repeats[row])):
                for k, n in pattern.items():
                    left[k] -= times * n
                plan.append((pattern, times))
    while left.any():
        pattern, room = {}, limit
        lengths = np.flatnonzero(left)
        while room and len(lengths := lengths[:np.searchsorted(lengths, room, "right")]):
            largest = int(lengths[-1])
            n = min(room // largest, int(left[largest]))
            pattern[largest] = n
            room -= n * largest
            lengths = lengths[:-1]
        use(pattern)
    return plan


class Places:
    """Where the nth piece of a length goes."""

    def __init__(self, plan: Iterable[tuple[dict[int, int], int]]):
        rows, used, sequence = [], Counter(), 0
        for pattern, repeats in plan:
            offset = 0
            for length, n in sorted(pattern.items(), reverse=True):
                rows.append((length, used[length], n, sequence, offset))
                used[length] += n * repeats
                offset += n * length
            sequence += repeats
        self.sequences = sequence
        rows.sort()
        self.length, self.low, self.n, self.sequence, self.offset = np.array(rows, np.int64).reshape(-1, 5).T

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each piece."""
        sequence, offset = np.empty_like(rank), np.empty_like(rank)
        for k in np.unique(length):
            mine = length == k
            start, stop = np.searchsorted(self.length, [k, k + 1])
            row = start + np.searchsorted(self.low[start:stop], rank[mine], "right") - 1
            nth = rank[mine] - self.low[row]
            sequence[mine] = self.sequence[row] + nth // self.n[row]
            offset[mine] = self.offset[row] + nth % self.n[row] * k
        return sequence, offset


def pack(staged_pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Pieces read from files, with sequence_id and offset."""
    counts = {r["length"]: r["n"] for r in staged_pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # limit rows at most
    histogram = np.zeros(limit + 1, np.int64)
    histogram[list(counts)] = list(counts.values())
    shared = share(staged_pieces.sparkSession, Places(plan_patterns(histogram, limit)))

    # A piece's number among those of its length: those in earlier blocks of files, and those before it in its block.
    row = F.col("_metadata.row_index")
    at = staged_pieces.select("*", F.col("_metadata.file_path").alias("file"), F.floor(row / BLOCK).alias("block"), row.alias("row"))
    block = ["length", "file", "block"]
    before = Window.partitionBy("length").orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = at.groupBy(*block).agg(F.count("*").alias("n")).select(*block, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy(*block).orderBy("row")) - 1
    numbered = at.withColumn("nth", nth).join(blocks, block).withColumn("rank", F.col("before") + F.col("nth"))
    columns = staged_pieces.schema

    def run(batches):
        places = shared()
        for batch in batches:
            sequence, offset = places.find(batch["length"].to_numpy(), batch["rank"].to_numpy())
            yield batch | {"sequence_id": sequence, "offset": offset}

    return map_batches(numbered.select(*columns.names, "rank"), run, extended(columns, "sequence_id bigint, offset bigint"))


def pack_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece."""
    return pack(staged(pieces(docs, path), "pieces"))


def sequences(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, at most ``LIMIT`` ids each."""
    placed = pack(staged(pieces(docs, path, with_ids=True), "pieces"))
    parts = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(read_table(spark, folder, "documents"))
