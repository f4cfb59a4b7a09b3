"""Quality by regularised quadratic discriminant analysis of document statistics.

Statistics of each text are transformed to be roughly normal. Spark sums, per class, the
statistics and their products over all labelled rows that are not held out; a covariance of
each class is shrunk towards the pooled one and towards its own diagonal. The score is the difference of the
classes' Gaussian log-densities, by Mahalanobis distances that a Cholesky factor per class, computed
once, gives, with the share of labels as prior; a line fitted to the log-odds of
the training rows (two numbers, from a histogram) makes it a probability.

Defined cases: a null text counts as empty, and an empty text has all statistics 0 and a score; rows that repeat an id
are scored each; a row without id is scored and counts as held out; labels that are null are not
learnt from; with no labels of a class the score is the share of good labels, or 0.5; an
empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import held_out, lists_of, map_batches, read_table, share, staged, texts_of

TO_POOLED, TO_DIAGONAL = 0.1, 0.1  # shrinkage of a class covariance
RIDGE = 1e-3  # added to each variance
CUT = 0.3  # scores from here on are predicted good
BINS, SPAN = 400, 40.0  # histogram of log-odds for the calibration, from -SPAN to SPAN

FEATURES = ("log_words", "word_length", "letters", "upper", "digits", "symbols", "pipes", "marks", "distinct", "commonest",
            "line_words", "same_lines", "ended_lines", "long_words")
SYMBOL = b"#*$%&<>{}[]=\\^~_@"


def logit(share: float, n: int) -> float:
    """Log-odds of a share of n, half a case added on either side."""
    return math.log((share * n + 0.5) / (n - share * n + 0.5))


def statistics(text: str) -> list[float]:
    """Transformed statistics of a text, in the order of ``FEATURES``."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size = max(1, len(text) - raw.count(b" ") - raw.count(b"\n"))
    upper = sum(map(str.isupper, text)) if not text.isascii() else len(text) - len(re.sub("[A-Z]+", "", text))
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    symbols = sum(raw.count(SYMBOL[k:k + 1]) for k in range(len(SYMBOL)))
    digits = len(raw) - len(raw.translate(None, b"0123456789"))
    marks = raw.count(b"!") + raw.count(b"?")
    other = digits + symbols + marks + raw.count(b"|") + raw.count(b".") + raw.count(b",")
    return [
        math.log1p(n), math.log(size / n), logit(min(1.0, max(0, size - other) / size), size), logit(min(1.0, upper / size), size),
        logit(min(1.0, digits / size), size), logit(min(1.0, symbols / size), size), logit(min(1.0, raw.count(b"|") / n), n),
        logit(min(1.0, marks / size), size), math.log(len(counts) / n) / math.log(n + 2), math.log(max(counts.values()) / n),
        math.log(n / max(1, len(lines))), logit(1 - len(set(lines)) / max(1, len(lines)), max(1, len(lines))),
        logit(sum(x.rstrip()[-1:] in b".!?:" for x in lines) / max(1, len(lines)), max(1, len(lines))),
        logit(sum(map((20).__lt__, map(len, words))) / n, n)]


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, x): statistics of each document."""

    def run(batches):
        for batch in batches:
            x = [statistics(t) for t in texts_of(batch["text"])]
            yield {"doc_id": batch["doc_id"], "x": lists_of(np.array(x, np.float64).ravel(), [len(FEATURES)] * len(x))}

    return map_batches(docs.select("doc_id", "text"), run, "doc_id bigint, x array<double>")


class Discriminant:
    """Two Gaussian classes and the calibration of their log-odds."""

    def __init__(self, moments: dict[int, np.ndarray]):
        """``moments``: per class, sums of (1, x) (1, x)'."""
        d = len(FEATURES)
        n = {k: moments[k][0, 0] if k in moments else 0.0 for k in (0, 1)}
        self.slope, self.shift = 1.0, 0.0
        self.classes = []
        total = n[0] + n[1]
        self.share = n[1] / total if total else 0.5
        if min(n.values()) < 2:
            return
        mean = {k: moments[k][0, 1:] / n[k] for k in (0, 1)}
        own = {k: moments[k][1:, 1:] / n[k] - np.outer(mean[k], mean[k]) for k in (0, 1)}
        pooled = (n[0] * own[0] + n[1] * own[1]) / total
        for k in (0, 1):
            cov = (1 - TO_POOLED) * own[k] + TO_POOLED * pooled
            cov = (1 - TO_DIAGONAL) * cov + TO_DIAGONAL * np.diag(np.diag(cov)) + RIDGE * np.eye(d)
            factor = np.linalg.cholesky(cov)
            whitening = np.linalg.inv(factor)
            self.classes.append((mean[k], whitening, -np.log(np.diag(factor)).sum() + math.log(n[k] / total)))

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        if not self.classes:
            return np.full(len(x), math.log((self.share + 1e-3) / (1 - self.share + 1e-3)))
        density = [c - 0.5 * (((x - mean) @ white.T) ** 2).sum(1) for mean, white, c in self.classes]
        return density[1] - density[0]

    def calibrate(self, odds: np.ndarray, good: np.ndarray, bad: np.ndarray) -> None:
        """Fit slope and shift to counts of good and bad rows by log-odds (Newton's method)."""
        if not self.classes or not good.sum() or not bad.sum():
            return
        # Beyond the ends of the histogram odds say nothing more.
        w = np.array([0.1, 0.0])
        design = np.stack([odds, np.ones_like(odds)], 1)
        n = good + bad
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
            gradient = design.T @ (good - n * p) - 1e-3 * w
            hessian = (design * (n * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
            step = np.linalg.solve(hessian, gradient)
            w += step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
            if np.abs(step).max() < 1e-8:
                break
        self.slope, self.shift = float(w[0]), float(w[1])

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.log_odds(x), -SPAN, SPAN) * self.slope + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(rows: DataFrame) -> Discriminant:
    """Model from (x, label) rows. What comes to the driver is two small matrices and a histogram."""
    d = len(FEATURES) + 1

    def add_up(batches):
        sums = {0: np.zeros((d, d)), 1: np.zeros((d, d))}
        for batch in batches:
            x = batch["x"].flatten().to_numpy().reshape(-1, d - 1)
            x = np.concatenate([np.ones((len(x), 1)), x], 1)
            label = batch["label"].to_numpy()
            for k in sums:
                sums[k] += x[label == k].T @ x[label == k]
        for k, s in sums.items():
            if s[0, 0]:
                i, j = np.indices((d, d))
                yield {"label": np.full(d * d, k), "i": i.ravel(), "j": j.ravel(), "v": s.ravel()}

    sums = map_batches(rows.select("x", "label"), add_up, "label int, i int, j int, v double")
    moments: dict[int, np.ndarray] = {}
    for r in sums.groupBy("label", "i", "j").agg(F.sum("v").alias("v")).collect():
        moments.setdefault(r["label"], np.zeros((d, d)))[r["i"], r["j"]] = r["v"]
    model = Discriminant(moments)

    def bins(batches):
        for batch in batches:
            odds = np.clip(model.log_odds(batch["x"].flatten().to_numpy().reshape(-1, d - 1)), -SPAN, SPAN - 1e-9)
            yield {"label": batch["label"], "bin": np.floor((odds + SPAN) / (2 * SPAN) * BINS).astype(np.int64)}

    counts = {0: np.zeros(BINS), 1: np.zeros(BINS)}
    for r in map_batches(rows.select("x", "label"), bins, "label int, bin int").groupBy("label", "bin").count().collect():
        counts[r["label"]][r["bin"]] = r["count"]
    model.calibrate((np.arange(BINS) + 0.5) / BINS * 2 * SPAN - SPAN, counts[1], counts[0])
    return model


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of each document; ``labels`` has (doc_id, quality)."""
    found = staged(measured(docs), "statistics")
    learn = labels.where("quality in (0, 1)").where(~held_out()).select("doc_id", F.col("quality").cast("int").alias("label"))
    shared = share(docs.sparkSession, fit(staged(found.join(learn, "doc_id").drop("doc_id"), "learn")))

    def run(batches):
        model = shared()
        for batch in batches:
            x = batch["x"].flatten().to_numpy().reshape(-1, len(FEATURES))
            yield {"doc_id": batch["doc_id"], "score": model.scores(x)}

    scored = map_batches(found, run, "doc_id bigint, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return classify(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))
