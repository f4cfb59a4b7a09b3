"""Byte-level BPE with a published rank file: encoding with offsets, and decoding.

The rank file is turned into a ``tokenizers`` model. Its merges are all ways to put a token
together from two shorter ones, ordered by the token's rank. Bytes are spelled as printable
characters, as byte-level models do, so the tables of the model are text. A match of the
pattern is encoded by itself, so a worker keeps the ids of matches it has met. Decoding looks the
bytes of each id up and joins them; a character whose bytes lie in several tokens
becomes whole only then.

Defined cases: a null text counts as empty; an empty text has no tokens; rows that repeat
an id are encoded each; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import os
from collections.abc import Iterable, Iterator
from itertools import chain

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm.common import map_batches, read_table, texts_of, worker_state

RANKS = "byte_bpe_multi_50k.tiktoken"
KNOWN_MATCHES = 200_000  # matches whose ids a worker keeps; when full it starts again
LONGEST_KNOWN = 64  # characters of a match that is kept


def ranks_path(name: str = RANKS) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where Latin-1 prints it, else the next one from U+0100."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class ByteBpe:
    """Encoder and decoder of a rank file."""

    def __init__(self, path: str, split_pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import regex
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        characters = byte_characters()

        def spelled(token: bytes) -> str:
            return "".join([characters[b] for b in token])

        merges = []
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    merges.append((rank, left, right, spelled(token[:k]), spelled(token[k:])))
        merges.sort()
        model = models.BPE({spelled(t): r for t, r in ranks.items()}, [m[3:] for m in merges], ignore_merges=True)
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False, trim_offsets=False)
        self.matches = Tokenizer(model)  # of single matches
        self.matches.pre_tokenizer = level
        self.texts = Tokenizer(model)
        self.texts.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(split_pattern), "isolated"), level])
        self.split = regex.compile(split_pattern).findall
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.decimal = [str(k) for k in range(len(self.bytes))]
        self.known: dict[str, tuple[int, ...]] = {}

    def ids(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text."""
        split = [self.split(t) for t in texts]
        matches = set().union(*split)
        long = {m for m in matches if len(m) > LONGEST_KNOWN}
        new = list(matches - long - self.known.keys())
        if len(self.known) + len(new) > KNOWN_MATCHES:
            self.known.clear()
            new = list(matches - long)
        for match, found in zip(new, self.matches.encode_batch_fast(new, add_special_tokens=False)):
            self.known[match] = tuple(found.ids)
        own = {m: self.matches.encode(m, add_special_tokens=False).ids for m in long}
        look = {**self.known, **own}.__getitem__ if own else self.known.__getitem__
        for s in split:
            yield list(chain.from_iterable(map(look, s)))

    def with_offsets(self, texts: list[str]) -> list[tuple[list[int], list[tuple[int, int]]]]:
        """Ids and, for each, the characters that its bytes belong to (start, end)."""
        return [(e.ids, e.offsets) for e in self.texts.encode_batch(texts, add_special_tokens=False)]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def decode_pieces(self, ids: Iterable[int]) -> Iterator[str]:
        """Text that each id completes; bytes of an unfinished character wait for the next id."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        for k in ids:
            yield decoder.decode(self.bytes[k])
        yield decoder.decode(b"", True)


def coder(path: str, split_pattern: str) -> ByteBpe:
    return worker_state("byte_bpe", lambda: ByteBpe(path, split_pattern))


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, starts, ends): tokens of each document and the characters they stand for."""
    path, split_pattern = path or ranks_path(), pattern()

    def run(batches):
        bpe = coder(path, split_pattern)
        for batch in batches:
            found = bpe.with_offsets(texts_of(batch["text"]))
            yield {"doc_id": batch["doc_id"], "ids": [ids for ids, _ in found],
                   "starts": [[s for s, _ in o] for _, o in found], "ends": [[e for _, e in o] for _, o in found]}

    return map_batches(docs.select("doc_id", "text"), run, "doc_id bigint, ids array<int>, starts array<int>, ends array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); bytes that are no UTF-8 become U+FFFD; null ids give a null text."""
    path, split_pattern = path or ranks_path(), pattern()

    def run(batches):
        bpe = coder(path, split_pattern)
        for batch in batches:
            ids = batch["ids"].to_pylist()
            yield {"doc_id": batch["doc_id"],
                   "text": [None if k is None else bpe.decode(k).decode("utf-8", "replace") for k in ids]}

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id bigint, text string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of a round trip of each document."""
    path, split_pattern = path or ranks_path(), pattern()

    def run(batches):
        bpe = coder(path, split_pattern)
        for batch in batches:
            sizes, of_ids, of_bytes = [], [], []
            for ids in bpe.ids(texts_of(batch["text"])):
                sizes.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(bpe.decimal.__getitem__, ids)).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield {"doc_id": batch["doc_id"], "n_tokens": sizes, "ids_sha256": of_ids, "decoded_sha256": of_bytes}

    return map_batches(docs.select("doc_id", "text"), run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return digests(read_table(spark, folder, "documents"))
