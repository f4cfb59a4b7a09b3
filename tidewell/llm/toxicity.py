"""Toxicity of texts after a noisy channel is undone.

The channel writes letters as digits and signs (1d10t), repeats them (idiooot), puts marks or
blanks between them (i.d.i.o.t, i d i o t). A disguised word is a lattice of the letters that each of its
characters may stand for, at a cost; a blank between single letters may be dropped or part two words, and a letter that is
repeated, once or forty times, may stand for one or for two. Words of any length are read. Viterbi's algorithm finds its best path under a character
trigram model, counted by Spark over all texts and mixed with the lexicon's own. The lexicon is learnt
from labelled rows: Spark counts in how many toxic and other rows each word and each beginning of words
stands, and those that mark toxic rows enter. A ridged logistic model of the lexicon's entries in the restored
text gives the score.

Learning takes at most ``SAMPLE`` rows of either class, least hashes first, none held out; the character
counts cover every text.

Defined cases: a null text counts as empty; texts without lexicon words share one low
score; rows that repeat an id are scored each; a row without id is scored and counts as held
out; null labels are not learnt from; with no labels all scores are 0; an empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import held_out, least_hashes, map_batches, read_table, share, staged, texts_of

SAMPLE = 10_000  # labelled rows of either class that are learnt from
LEXICON = 2000  # entries of the lexicon at most
BEGINNINGS = (4, 5, 6)  # letters of the beginnings of words that may be entries
LEAST_ROWS = 3  # toxic rows in which an entry must stand, and
LEAST_SHARE = 0.004  # the share of all toxic rows
LEAST_ODDS = 2.0  # log-odds of an entry in toxic rows, against others
RIDGE, STEPS = 0.15, 600  # of the logistic model
MIX = 0.25  # weight of the lexicon in the character model
KNOWN_TOKENS = 300_000  # tokens that a task remembers; when full it starts again
CUT = 0.5

LETTERS = 28  # edge of a word, a to z, other letters
EDGE_MARKS = ".,!?*$%&#|()[]{}\"'`;:~<>=/\\-_+^@…«»„“”‘’"
# What the channel writes for letters, and at what cost: fixed, by shape.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
SWAP, HIDDEN, DROP, REPEAT = 1.0, 3.0, 0.5, 0.5  # costs: a sign for a letter, * for any, a mark between, a run of a letter
BREAK = 0.5  # cost of a blank between single letters that parts two words
DOUBLE = 2.0  # cost of a letter written twice that stands for one
SPACED = re.compile(r"(?<!\S)[a-z0-9@$!](?:[ .\-_*]{1,2}[a-z0-9@$!]){2,}(?!\S)")
SIGNS = re.compile(r"[0-9@$!|+(€£*.\-_]")  # that may be letters, or stand between them, behind a letter
SHAPES = re.compile(r"[0-9@$!|+(€£]")  # that may be letters before one
LETTER, RUN = re.compile("[a-z]"), re.compile(r"([a-z])\1")


def may_be_disguised(token: str) -> bool:
    """Whether a token has letters with signs behind or before them, or a letter twice in a row; in one pass."""
    if RUN.search(token):
        return True
    letter = LETTER.search(token)
    if letter is None:
        return False
    if SIGNS.search(token, letter.end()):
        return True
    shape = SHAPES.search(token, 0, letter.start())
    return shape is not None


def letter_classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.where((points >= 97) & (points <= 122), points - 96, np.where(points >= 192, 27, 0))


def count_letters(docs: DataFrame) -> np.ndarray:
    """Trigrams of letter classes over all texts: 28 to the third numbers, whatever the corpus."""

    def run(batches):
        total = np.zeros(LETTERS ** 3, np.int64)
        for batch in batches:
            c = letter_classes("  " + "  ".join([t.lower() for t in texts_of(batch["text"])]) + "  ")
            total += np.bincount((c[:-2] * LETTERS + c[1:-1]) * LETTERS + c[2:], minlength=LETTERS ** 3)
        seen = np.flatnonzero(total)
        yield {"gram": seen, "n": total[seen]}

    counts = np.zeros(LETTERS ** 3)
    for r in map_batches(docs.select("text"), run, "gram int, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        counts[r["gram"]] = r["n"]
    return counts


def conditional(counts: np.ndarray) -> np.ndarray:
    """Probability of a letter after two, each order smoothed by the one below."""
    tri = counts.reshape(LETTERS, LETTERS, LETTERS)
    uni = tri.sum((0, 1)) + 1.0
    uni /= uni.sum()
    bi = tri.sum(0) + 5 * uni
    bi /= bi.sum(1, keepdims=True)
    both = tri + 5 * bi[None]
    return both / both.sum(2, keepdims=True)


def marks_of(word: str) -> list[str]:
    """The word as an entry, and its beginnings."""
    return [word, *[word[:k] + "~" for k in BEGINNINGS if k < len(word)]]


class Restorer:
    """Character model, lexicon, and the decoder of disguised words."""

    def __init__(self, counts: np.ndarray, entries: list[str]):
        words = [w for w in entries if not w.endswith("~")]
        own = np.zeros(LETTERS ** 3)
        for w in words:
            c = letter_classes(f"  {w} ")
            np.add.at(own, (c[:-2] * LETTERS + c[1:-1]) * LETTERS + c[2:], 1)
        mix = MIX if words else 0.0
        p = (1 - mix) * conditional(counts) + mix * conditional(own)
        self.log_p = np.log(p).tolist()
        self.numbers = {w: k for k, w in enumerate(entries)}
        self.known: dict[str, tuple[int, ...]] = {}

    def lattice(self, token: str) -> list[list[tuple[str, float]]]:
        """Per character, or run of a letter, what it may stand for; a blank is the edge of a word."""
        steps = []
        for c, run in groupby(token):
            n = len(list(run))
            if "a" <= c <= "z":
                steps.append([(c, 0.0)] if n == 1 else [(c * 2, 0.0), (c, DOUBLE)] if n == 2 else [(c, REPEAT), (c * 2, REPEAT)])
            elif c == " ":
                steps.append([("", DROP), (" ", BREAK)])
            elif c.isalpha():
                steps.append([(c * min(n, 2), 0.0)])
            elif c in STANDS_FOR:
                options = [(x, SWAP) for x in STANDS_FOR[c]]
                steps += [options] * n if n < 3 else [options]
            elif c == "*":
                steps += [[("", HIDDEN), *[(chr(97 + k), HIDDEN) for k in range(26)]]] * min(n, 2)
            else:
                steps.append([("", DROP)])
        return steps

    def decode(self, token: str) -> str:
        """Best reading of a token, by states of the last two letters; words in it are parted by blanks."""
        log_p = self.log_p
        states = {(0, 0): (0.0, None)}  # score, and the letters read so far as a chain
        for options in self.lattice(token):
            reached: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (a, b), (score, chain) in states.items():
                for letters, cost in options:
                    x, y, s = a, b, score - cost
                    if letters == " ":
                        s += log_p[x][y][0]
                        x = y = 0
                    else:
                        for c in letters:
                            k = ord(c) - 96 if "a" <= c <= "z" else 27
                            s += log_p[x][y][k]
                            x, y = y, k
                    if (x, y) not in reached or s > reached[x, y][0]:
                        reached[x, y] = (s, (chain, letters))
            states = reached
        _, chain = max(((score + log_p[a][b][0], chain) for (a, b), (score, chain) in states.items()), key=lambda x: x[0])
        letters = []
        while chain is not None:
            chain, part = chain
            letters.append(part)
        return "".join(reversed(letters))

    def restored(self, token: str) -> list[str]:
        """Words that a token of lower-case text may be: itself, and what it disguises."""
        word = token.strip(EDGE_MARKS)
        words = [word]
        # A sign at an end may be a letter of the word, or a mark behind it.
        for core in dict.fromkeys((word, token.strip(EDGE_MARKS.replace("$", "").replace("@", "").replace("!", "")),
                                   token.rstrip(EDGE_MARKS).lstrip(".,?*%&#\"'`;:~<>=/\\-_^"))):
            if len(core) > 2 and may_be_disguised(core):
                words.append(self.decode(core))
        return words

    def entry(self, token: str) -> tuple[int, ...]:
        """Numbers of the lexicon entries that a token holds."""
        found = self.known.get(token)
        if found is None:
            if len(self.known) >= KNOWN_TOKENS:
                self.known.clear()
            marks = {m for w in self.restored(token) for m in marks_of(w)}
            found = self.known[token] = tuple(self.numbers[m] for m in marks if m in self.numbers)
        return found

    def entries(self, text: str) -> list[int]:
        """Lexicon entries of a text, in order."""
        text = text.lower()
        found = set().union(*map(self.entry, set(text.split())))
        for m in SPACED.finditer(text):
            found.update(self.entry(re.sub(r"[ .\-_*]", "", m[0])))  # one word
            read = self.decode(re.sub(r"[ .\-_*]{1,2}", lambda gap: " " if " " in gap[0] else "", m[0]))  # or several
            found.update(self.numbers[mark] for word in read.split() for mark in marks_of(word) if mark in self.numbers)
        return sorted(found)


def learnt_rows(labels: DataFrame) -> tuple[DataFrame, dict[int, float]]:
    """(doc_id, label) of at most ``SAMPLE`` rows of either class, and how many rows each of them stands for."""
    usable = labels.where("toxic in (0, 1)").where(~held_out()).select("doc_id", F.col("toxic").cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    least = [least_hashes(usable.where(F.col("label") == k), ["doc_id"], SAMPLE, counts.get(k, 0)) for k in (0, 1)]
    weights = {k: max(1.0, n / SAMPLE) for k, n in counts.items()}
    return staged(least[0].unionAll(least[1]), "learnt"), weights


def telling_marks(texts: DataFrame) -> list[str]:
    """Words and beginnings that stand in toxic rows far more often than in others."""

    def run(batches):
        for batch in batches:
            counts = {0: Counter(), 1: Counter()}
            for label, text in zip(batch["label"].to_pylist(), texts_of(batch["text"])):
                words = {w for t in set(text.lower().split()) if len(w := t.strip(EDGE_MARKS)) > 1 and w.isalpha()}
                counts[label].update({m for w in words for m in marks_of(w)})
                counts[label][""] += 1  # the empty mark counts rows
            marks = list(counts[0].keys() | counts[1].keys())
            yield {"mark": marks, "toxic": [counts[1][m] for m in marks], "other": [counts[0][m] for m in marks]}

    counts = map_batches(texts, run, "mark string, toxic bigint, other bigint").groupBy("mark").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    counts = staged(counts, "marks")
    rows = counts.where("mark = ''").first()
    if rows is None or not rows["toxic"]:
        return []
    odds = F.log((F.col("toxic") + 0.5) / (rows["toxic"] + 1.0)) - F.log((F.col("other") + 0.5) / (rows["other"] + 1.0))
    least = max(LEAST_ROWS, math.ceil(LEAST_SHARE * rows["toxic"]))
    chosen = counts.where((F.col("mark") != "") & (F.col("toxic") >= least)).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
    return [r["mark"] for r in chosen.orderBy(F.desc(F.col("toxic") * F.col("odds")), "mark").limit(LEXICON).collect()]


def rows_with(texts: DataFrame, restorer: Restorer) -> list[tuple[int, tuple[int, ...], int]]:
    """(label, lexicon entries, rows) over the sample."""
    shared = share(texts.sparkSession, restorer)

    def run(batches):
        own = shared()
        for batch in batches:
            yield {"label": batch["label"], "entries": [own.entries(t) for t in texts_of(batch["text"])]}

    # Not more rows than the sample has.
    grouped = map_batches(texts, run, "label int, entries array<int>").groupBy("label", "entries").count()
    return [(r["label"], tuple(r["entries"]), r["count"]) for r in grouped.orderBy("label", "entries").collect()]


def fitted(size: int, rows: list[tuple[int, tuple[int, ...], int]], weights: dict[int, float]) -> np.ndarray:
    """Weight of each of ``size`` marks, and behind them the constant: a ridged logistic model,
    by accelerated gradient steps."""
    n = np.array([count * weights.get(label, 1.0) for label, _, count in rows])
    y = np.array([label for label, _, _ in rows], np.float64)
    w = np.zeros(size + 1)
    if not len(y) or not y.any():
        w[-1] = -30.0
        return w
    share = (n * y).sum() / n.sum()
    w[-1] = math.log((share + 1e-6) / (1 - share + 1e-6))
    mark = np.array([m for _, marks, _ in rows for m in marks], np.int64)
    row = np.repeat(np.arange(len(rows)), [len(marks) for _, marks, _ in rows])
    most = max((len(marks) for _, marks, _ in rows), default=0) + 1
    heaviest = max(np.bincount(mark, n[row], minlength=size).max() if len(mark) else 0, n.sum())
    # A mark's step follows its own weight of rows, so that rare marks learn as fast as frequent ones.
    scale = np.r_[np.bincount(mark, n[row], minlength=size), heaviest] * most / 4 + RIDGE
    ahead, t = w.copy(), 1.0
    ridge = np.r_[np.full(size, RIDGE), 0.0]
    for _ in range(STEPS):
        z = ahead[-1] + np.bincount(row, ahead[mark], minlength=len(rows))
        error = n * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        gradient = np.r_[np.bincount(mark, error[row], minlength=size), error.sum()] + ridge * ahead
        new = ahead - gradient / scale
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return w


def train(docs: DataFrame, labels: DataFrame) -> tuple[Restorer, np.ndarray]:
    """Restorer and logistic weights."""
    sample, weights = learnt_rows(labels)
    # The sample has 2 * SAMPLE rows of two numbers at most: a bounded broadcast, and no text is moved.
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "label")
    texts = staged(texts, "sample")
    restorer = Restorer(count_letters(docs), telling_marks(texts))
    return restorer, fitted(len(restorer.numbers), rows_with(texts, restorer), weights)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of each document; ``labels`` has (doc_id, toxic)."""
    shared = share(docs.sparkSession, train(docs, labels))

    def run(batches):
        restorer, w = shared()
        for batch in batches:
            z = np.array([w[-1] + w[restorer.entries(t)].sum() for t in texts_of(batch["text"])])
            yield {"doc_id": batch["doc_id"], "score": 1 / (1 + np.exp(-np.clip(z, -30, 30)))}

    scored = map_batches(docs.select("doc_id", "text"), run, "doc_id bigint, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))
