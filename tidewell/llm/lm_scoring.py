"""Scores of texts under a masked language model: the pseudo-log-likelihood of their words.

A window network predicts each word from the two words on either side: a hidden layer adds
up an embedding per place and word, and softmaxes over the branches of a tree of words, level by level down to
the word, give the word's probability. A document's score is the sum of the logarithms of these over all
of its words.

The vocabulary is the ``FREQUENT`` most frequent words, from Spark's count of all words, and ``BUCKETS`` hashes
for all others, so the network has a fixed size (2.5 MB). Texts are split into words once to count them and once more
to stage them as numbers of words, two bytes each; training and scoring read the numbers. The network
is trained on all partitions at once: in each
round, every partition starts from the shared weights, passes over its documents, and the weights
are averaged by the number of windows, block by block, in a shuffle. The number of windows and what is sent grow
with the corpus. ``ROUNDS`` deal out the windows of every document: each window is visited in one round, none is left out.

Defined cases: null and empty texts have no words and the score 0; rows that repeat an id
are scored each; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from itertools import chain, compress, repeat
from operator import methodcaller

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import map_batches, read_table, share, staged, texts_of

FREQUENT, BUCKETS = 4032, 1023
VOCABULARY = 1 + FREQUENT + BUCKETS  # 0 is what lies beyond a text
UNITS = 24
PLACES = (-2, -1, 1, 2)
LEVELS = (10, 16, 32)  # outputs of the softmaxes that lead to a word; 160 branches at the last level
OUTPUTS = np.unravel_index(np.arange(VOCABULARY), LEVELS, order="F")  # of a word at each level
BRANCH = np.ravel_multi_index(OUTPUTS[:-1], LEVELS[:-1]).astype(np.uint8)  # at the last level
NO_WORD = -80.0  # logarithm of the share of a leaf without a word
ROUNDS = ((2, 0, 0.1), (2, 1, 0.05))  # every kth window, from the nth on; learning rate
LARGEST = 60.0  # exponent; beyond it the sum of a softmax would leave the range of numbers
SEEN = 1e-8  # squared gradients that count as seen at the start
BATCH = 4096  # windows of a training step
WARM = 1 << 16  # after so many windows of a task, a step has twice the windows and twice the rate
SCORED = 1 << 15  # windows that are scored together
SHORT = 4  # rows that are added one by one
COUNTED = 300_000  # distinct words that a task counts before it sends them on
BLOCKS = 64  # parts in which weights are averaged


class Words:
    """Numbers of words: frequent ones have their own, others share those of their hashes."""

    def __init__(self, frequent: list[str]):
        self.known = {w: k + 1 for k, w in enumerate(frequent)}

    def numbers(self, texts: list[str], every: int = 1, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of texts, two zeros around each text, and words per text.

        With ``every`` only the words in the windows of every kth word, from the nth on, are looked
        up; the others are left zero.
        """
        parts = [text.lower().split() for text in texts]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        words, at = list(chain.from_iterable(parts)), places_of(sizes)
        if every > 1:
            nth = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            needed = np.isin(nth % every, [(first + d) % every for d in (*PLACES, 0)])
            words, at = list(compress(words, needed)), at[needed]
        found = np.fromiter(map(self.known.get, words, repeat(0)), np.int32, len(words))
        others = np.flatnonzero(found == 0)
        spelt = map(methodcaller("encode", "utf-8", "surrogatepass"), map(words.__getitem__, others.tolist()))
        found[others] = 1 + FREQUENT + np.fromiter(map(zlib.crc32, spelt), np.uint32, len(others)) % BUCKETS
        numbers = np.zeros(sizes.sum() + 2 * len(texts) + 2, np.int32)
        numbers[at] = found
        return numbers, sizes


def places_of(sizes: np.ndarray) -> np.ndarray:
    """Places of all words in what ``Words.numbers`` gives."""
    return np.arange(sizes.sum()) + np.repeat(2 * np.arange(1, len(sizes) + 1), sizes)


def numbered(docs: DataFrame, words: Words) -> DataFrame:
    """doc_id, n_tokens and the numbers of the words of each document, two bytes each."""
    shared = share(docs.sparkSession, words)

    def run(batches):
        words = shared()
        for batch in batches:
            found, sizes = words.numbers(texts_of(batch["text"]))
            raw, ends = found[places_of(sizes)].astype(np.uint16).tobytes(), 2 * np.cumsum(sizes)
            yield {"doc_id": batch["doc_id"], "n_tokens": sizes, "numbers": [raw[e - 2 * n:e] for e, n in zip(ends, sizes)]}

    return map_batches(docs.select("doc_id", "text"), run, "doc_id bigint, n_tokens bigint, numbers binary")


def laid_out(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """What ``Words.numbers`` gave for the texts of a column of ``numbered``."""
    parts = column.to_pylist()
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 2
    numbers = np.zeros(sizes.sum() + 2 * len(parts) + 2, np.intp)
    numbers[places_of(sizes)] = np.frombuffer(b"".join(parts), np.uint16)
    return numbers, sizes


def frequent_words(docs: DataFrame) -> list[tuple[str, int]]:
    """The most frequent words of all texts, and their counts."""

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text in texts_of(batch["text"]):
                counts.update(text.lower().split())
            if len(counts) > COUNTED:
                yield {"word": list(counts), "n": list(counts.values())}
                counts.clear()
        yield {"word": list(counts), "n": list(counts.values())}

    counted = map_batches(docs.select("text"), run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    # Only words of the largest counts are sorted: those from the class of counts on that makes up the number.
    size = F.floor(F.log2("n") * 4).cast("int")
    counted = staged(counted, "words")
    classes = sorted(((r["size"], r["count"]) for r in counted.groupBy(size.alias("size")).count().collect()), reverse=True)
    total, least = 0, 0
    for least, n in classes:
        total += n
        if total >= FREQUENT:
            break
    top = counted.where(size >= least).orderBy(F.desc("n"), "word").limit(FREQUENT)
    return [(r["word"], r["n"]) for r in top.collect()]


class Network:
    """Window network with a softmax at each level of a tree of words; its leaves are the words.

    Word w is in branch w % 10, there in branch w // 10 % 16 and there the leaf w // 160: frequent words spread
    evenly over the branches. Weights of a level are by branch, output and unit; the last unit is the bias.
    """

    def __init__(self, counts: list[int], seed: int = 2):
        rng = np.random.default_rng(seed)
        self.inputs = (rng.standard_normal((len(PLACES), VOCABULARY, UNITS)) * 0.3).astype(np.float32)
        share = np.zeros(math.prod(LEVELS))
        share[:VOCABULARY] = 1
        share[1:1 + len(counts)] += counts
        share[1 + FREQUENT:VOCABULARY] += max(1.0, min(counts, default=1))
        share = share.reshape(LEVELS[::-1]).T
        self.levels = []
        for k, size in enumerate(LEVELS):
            below = share.sum(axis=tuple(range(k + 1, len(LEVELS)))).reshape(-1, size)
            weights = rng.standard_normal((*below.shape, UNITS + 1)) * 0.1
            with np.errstate(divide="ignore"):
                weights[:, :, UNITS] = np.maximum(np.log(below / below.sum(1, keepdims=True)), NO_WORD)
            self.levels.append(weights.astype(np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in (self.inputs, *self.levels)])

    def set_flat(self, values: np.ndarray) -> None:
        parts, at = [], 0
        for old in (self.inputs, *self.levels):
            parts.append(values[at:at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        self.inputs, self.levels = parts[0], parts[1:]

    @staticmethod
    def around(words: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """Rows of the inputs, all places end to end, of the words around each place."""
        return [words[at + place] + k * VOCABULARY for k, place in enumerate(PLACES)]

    def hidden(self, around: list[np.ndarray]) -> np.ndarray:
        """Values of the units, and a last one that is 1."""
        inputs = self.inputs.reshape(-1, UNITS)
        total = inputs.take(around[0], 0)
        for rows in around[1:]:
            total += inputs.take(rows, 0)
        h = np.ones((len(total), UNITS + 1), np.float32)
        h[:, :UNITS] = np.tanh(total, out=total)
        return h

    @staticmethod
    def by_branch(target: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, list[tuple[int, int, int]]]]]:
        """Order that puts words of a branch together; per level each word's output, and the branches with their ranges."""
        branch = BRANCH[target]
        order = np.argsort(branch, kind="stable")
        target = target[order]
        counts = np.bincount(branch, minlength=math.prod(LEVELS[:-1]))
        levels = []
        for k in range(len(LEVELS)):
            ends = np.cumsum(counts.reshape(math.prod(LEVELS[:k]), -1).sum(1)).tolist()
            levels.append((OUTPUTS[k][target], [(b, s, e) for b, (s, e) in enumerate(zip([0, *ends], ends)) if e > s]))
        return order, levels

    def log_p(self, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log-probability of the word at each place from the words around it."""
        order, levels = self.by_branch(words[at])
        h = self.hidden(self.around(words, at[order]))
        result, rows = np.zeros(len(at), np.float32), np.arange(len(at))
        for weights, (out, ranges) in zip(self.levels, levels):
            scores = np.empty((len(at), weights.shape[1]), np.float32)
            for branch, start, end in ranges:
                np.matmul(h[start:end], weights[branch].T, out=scores[start:end])
            result += scores[rows, out]
            np.exp(scores, out=scores)
            result -= np.log(scores @ np.ones(weights.shape[1], np.float32))
        back = np.empty_like(result)
        back[order] = result
        return back


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of runs of rows, which begin at ``first``: as ``np.add.reduceat``, quicker as most runs are short."""
    sizes = np.diff(first, append=len(values))
    sums = values.take(first, 0)
    for k in range(1, SHORT):
        some = np.flatnonzero((sizes > k) & (sizes <= SHORT))
        sums[some] += values.take(first[some] + k, 0)
    some = sizes > SHORT
    if some.any():
        long, n = values[np.repeat(some, sizes)], sizes[some]
        sums[some] = np.add.reduceat(long.view(np.complex64), np.cumsum(n) - n).view(np.float32)  # two units at a time
    return sums


class Trainer:
    """Gradient steps with a step size per row that falls with the gradients seen (Adagrad)."""

    def __init__(self, network: Network, rate: float):
        self.n, self.rate, self.windows = network, rate, 0
        self.seen_inputs = np.full(len(PLACES) * VOCABULARY, SEEN, np.float32)
        self.seen = [np.full(w.shape, SEEN, np.float32) for w in network.levels]

    def learn(self, words: np.ndarray, at: np.ndarray) -> None:
        """Steps on all places, in a random order."""
        at = np.random.default_rng(self.windows).permutation(at)
        while len(at):
            times = 1 if self.windows < WARM else 2
            some, at = at[:times * BATCH], at[times * BATCH:]
            self.step(words, some, times)
            self.windows += len(some)

    def step(self, words: np.ndarray, at: np.ndarray, times: int = 1) -> float:
        """One step on a batch of places, at so many times the rate; the mean log-probability before it."""
        n, rate = self.n, times * self.rate
        order, levels = n.by_branch(words[at])
        at = at[order]
        around = n.around(words, at)
        h = n.hidden(around)
        dh, back = np.zeros((len(at), UNITS), np.float32), np.empty((len(at), UNITS), np.float32)
        rows = np.arange(len(at))
        total = 0.0
        for weights, seen, (out, ranges) in zip(n.levels, self.seen, levels):
            # p holds probabilities times their row's sum; rows are divided by it where they are narrow.
            p = np.empty((len(at), weights.shape[1]), np.float32)
            for branch, start, end in ranges:
                np.matmul(h[start:end], weights[branch].T, out=p[start:end])
            np.exp(np.minimum(p, LARGEST, out=p), out=p)
            sums = p @ np.ones(weights.shape[1], np.float32)
            mine = p[rows, out]
            total += float(np.log(mine / sums + 1e-30).sum())
            p[rows, out] = mine - sums
            share = (1 / sums)[:, None]
            scaled = h * (share / np.float32(len(at)))
            gradient = np.zeros_like(weights)
            for branch, start, end in ranges:
                np.matmul(p[start:end], weights[branch, :, :UNITS], out=back[start:end])
                np.matmul(p[start:end].T, scaled[start:end], out=gradient[branch])
            back *= share
            dh += back
            seen += gradient * gradient
            gradient *= rate
            gradient /= np.sqrt(seen)
            weights -= gradient
        h = h[:, :UNITS]
        dh *= (1 - h * h) / np.float32(len(at))
        around = np.concatenate(around).astype(np.uint16)  # sorted by counting, as there are few numbers
        by_word = np.argsort(around, kind="stable")
        around = around[by_word]
        first = np.flatnonzero(np.r_[True, around[1:] != around[:-1]])
        gradient = row_sums(dh.take(by_word, 0, mode="wrap"), first)
        row = around[first].astype(np.intp)
        seen = self.seen_inputs[row] + np.einsum("ij,ij->i", gradient, gradient) / UNITS
        self.seen_inputs[row] = seen
        gradient *= (rate / np.sqrt(seen))[:, None]
        inputs = n.inputs.reshape(-1, UNITS)
        inputs[row] = inputs.take(row, 0) - gradient
        return total / len(at)


def train_round(coded: DataFrame, network: Network, every: int, first: int, rate: float) -> Network:
    """Weights averaged over partitions, each of which trains on its own documents."""
    shared = share(coded.sparkSession, network)

    def run(batches):
        network = shared()
        trainer = Trainer(network, rate)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def learn():
            nonlocal waiting, held
            offset, all_words, all_places = 0, [], []
            for w, at in waiting:
                all_words.append(w)
                all_places.append(at + offset)
                offset += len(w)
            trainer.learn(np.concatenate(all_words), np.concatenate(all_places))
            waiting, held = [], 0

        for batch in batches:
            numbers, sizes = laid_out(batch["numbers"])
            at = places_of(sizes)
            # Windows are chosen by their place in the text: another round takes others of every text.
            nth = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            at = at[(nth % every) == (first % every)]
            if len(at):
                waiting.append((numbers, at))
                held += len(at)
            if held >= 8 * BATCH:
                learn()
        if held:
            learn()
        if trainer.windows:
            parts = np.array_split(network.flat(), BLOCKS)
            yield {"block": np.arange(BLOCKS), "windows": np.full(BLOCKS, trainer.windows), "weights": [p.tobytes() for p in parts]}

    def add_up(batches):
        total: dict[int, list] = {}
        for batch in batches:
            for block, n, weights in zip(batch["block"].to_pylist(), batch["windows"].to_pylist(), batch["weights"].to_pylist()):
                entry = total.setdefault(block, [0, 0.0])
                entry[0] += n
                entry[1] = entry[1] + n * np.frombuffer(weights, np.float32).astype(np.float64)
        if total:
            yield {"block": list(total), "windows": [n for n, _ in total.values()], "weights": [s.astype(np.float64).tobytes() for _, s in total.values()]}

    schema = "block int, windows bigint, weights binary"
    trained = map_batches(coded.select("numbers"), run, schema)
    summed = map_batches(trained.repartition(BLOCKS, "block"), add_up, schema).collect()  # the network's size
    if summed:
        by_block = {r["block"]: np.frombuffer(r["weights"], np.float64) / r["windows"] for r in summed}
        network.set_flat(np.concatenate([by_block[k] for k in range(BLOCKS)]))
    return network


def number(docs: DataFrame) -> tuple[DataFrame, Words, Network]:
    """The documents as numbers, staged for all that follows, their words, and a network not yet trained."""
    counted = frequent_words(docs)
    words = Words([w for w, _ in counted])
    return staged(numbered(docs, words), "numbers"), words, Network([n for _, n in counted])


def learn(coded: DataFrame, network: Network) -> Network:
    for every, first, rate in ROUNDS:
        network = train_round(coded, network, every, first, rate)
    return network


def train(docs: DataFrame) -> tuple[Words, Network]:
    coded, words, network = number(docs)
    return words, learn(coded, network)


def score(docs: DataFrame, model: tuple[Words, Network] | None = None) -> DataFrame:
    """doc_id, n_tokens, log_likelihood and mean_log_p (0 without words) of each document."""
    if model:
        words, network = model
        coded = numbered(docs, words)
    else:
        coded, _, network = number(docs)
        network = learn(coded, network)
    shared = share(docs.sparkSession, network)

    def run(batches):
        network = shared()
        for batch in batches:
            numbers, sizes = laid_out(batch["numbers"])
            at = places_of(sizes)
            log_p = np.concatenate([np.zeros(0, np.float32), *[network.log_p(numbers, at[k:k + SCORED]) for k in range(0, len(at), SCORED)]])
            sums = np.bincount(np.repeat(np.arange(len(sizes)), sizes), log_p.astype(np.float64), minlength=len(sizes))
            yield {"doc_id": batch["doc_id"], "n_tokens": sizes, "log_likelihood": sums, "mean_log_p": sums / np.maximum(sizes, 1)}

    return map_batches(coded.select("doc_id", "numbers"), run, "doc_id bigint, n_tokens bigint, log_likelihood double, mean_log_p double")


def op2_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return score(read_table(spark, folder, "documents"))
