"""Personal data by fixed patterns and by a character-level bidirectional LSTM with CRF.

Four patterns give base spans. A network reads windows of ``WIDTH`` characters, which overlap by
half, around everything that may belong to such data: digits, @ and words such as (at). It is
trained in numpy, on the driver, from a bounded sample of windows whose labels are the base spans, mostly
rewritten to forms that the patterns miss (no country code, dots for hyphens, (at) for @), with other digits and names.
Numbers that only a check digit tells from cards are labelled as cards, since that check follows. How sure the network
must be is set on windows kept out of the training: as low as no false span there allows.
Each character takes its tag from the window in whose middle it lies best, so tags of a text
form one sequence, and runs of tags are spans. A span of the network is added where it overlaps no base
span, its tags are sure (by CRF marginals) and its digits are plausible; base spans always stay.

Positions are code points, the end exclusive.

Defined cases: a null text counts as empty and has no spans; rows that repeat an id are
returned each; an empty table gives no rows; other columns are not looked at (``redact`` passes
them through); without any labelled window no span is added.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import least_hashes, map_batches, read_table, share, staged, texts_of

KINDS = ("email", "ip", "card", "phone")
WIDTH, STRIDE = 64, 32
SAMPLE = 1500  # training windows of each kind, and as many without spans: the bound of the sample
VARIANTS = 4  # windows made of each picked one; more where a kind has few
STEPS, BATCH, RATE = 600, 96, 0.02
UNITS, EMBEDDING = 16, 12
SURE = (0.6, 0.7, 0.8, 0.9, 0.95, 0.97)  # mean marginal probability of the tags of an added span: the choices
KEPT_OUT = 10  # one window of so many is not trained on but sets that probability
SEED = 20

# Base patterns, fixed by the contract of the query. A possessive quantifier gives the same
# match as a greedy one where what follows can't be part of the run.
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]|[\[({]\s?(?:at|dot)\s?[\])}]", re.I)

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail pattern, from each @ outwards: time in proportion to the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        m = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
            at = text.find("@", done)
        else:
            done = at + 1
            at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    spans = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    if not re.search("[0-9]", text):
        return spans
    for m in IP.finditer(text):
        if all(map(small, m[0].split("."))):
            spans.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def written(spans: list[Span]) -> str:
    return ",".join([f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans])


# Characters as the network sees them: letters without case, digits as one, marks by themselves.
MARKS = "@.-+() \n_%/:#,;[]{}='\"*|!?&$<>"
CLASSES = 3 + 26 + len(MARKS) + 2  # 0 is what lies beyond a text


def class_table() -> np.ndarray:
    table = np.full(128, CLASSES - 2, np.int64)
    for k in range(26):
        table[97 + k] = table[65 + k] = 3 + k
    table[48:58] = 1
    table[[9, 11, 12, 13]] = 2
    for k, c in enumerate(MARKS):
        table[ord(c)] = 29 + k
    return table


def classes_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, class_table()[np.minimum(points, 127)], CLASSES - 1)


def windows_of(text: str) -> list[tuple[int, int]]:
    """(start of a region, start of a window in it): regions reach half a window beyond each trigger."""
    regions: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        if regions and m.start() - STRIDE <= regions[-1][1]:
            regions[-1][1] = min(len(text), m.end() + STRIDE)
        else:
            regions.append([max(0, m.start() - STRIDE), min(len(text), m.end() + STRIDE)])
    return [(a, w) for a, b in regions for w in range(a, max(a + 1, b - STRIDE), STRIDE)]


TAGS = 1 + 2 * len(KINDS)  # O, then beginning and inside of each kind


def tags_of(spans: list[Span], start: int, width: int = WIDTH) -> np.ndarray:
    tags = np.zeros(width, np.int64)
    for s, kind, e in spans:
        a, b = max(s - start, 0), min(e - start, width)
        if a < b:
            tags[a:b] = 2 + 2 * kind
            if s >= start:
                tags[a] = 1 + 2 * kind
    return tags


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


class Tagger:
    """Embedding, LSTM in both directions, scores of tags, and transitions between tags."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)

        def draw(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.w = {"embedding": draw(CLASSES, EMBEDDING) * 3}
        for d in ("f", "b"):
            self.w[f"in_{d}"] = draw(EMBEDDING, 4 * UNITS)
            self.w[f"rec_{d}"] = draw(UNITS, 4 * UNITS)
            self.w[f"bias_{d}"] = np.zeros(4 * UNITS, np.float32)
            self.w[f"bias_{d}"][UNITS:2 * UNITS] = 1  # remember at first
        self.w["out"] = draw(2 * UNITS, TAGS)
        self.w["out_bias"] = np.zeros(TAGS, np.float32)
        self.w["transitions"] = np.zeros((TAGS, TAGS), np.float32)
        self.trained, self.sure = False, SURE[-1]

    def lstm(self, x: np.ndarray, d: str, keep: bool):
        """States of one direction for x (time, batch, embedding)."""
        steps, n, _ = x.shape
        gates_in = x @ self.w[f"in_{d}"] + self.w[f"bias_{d}"]
        h = c = np.zeros((n, UNITS), np.float32)
        states, kept = np.empty((steps, n, UNITS), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = gates_in[t] + h @ self.w[f"rec_{d}"]
            s = 1 / (1 + np.exp(-z[:, :3 * UNITS]))
            i, f, o, g = s[:, :UNITS], s[:, UNITS:2 * UNITS], s[:, 2 * UNITS:], np.tanh(z[:, 3 * UNITS:])
            before, c_before = h, c
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            states[t] = h
            if keep:
                kept.append((t, i, f, o, g, tc, before, c_before))
        return states, kept

    def emissions(self, windows: np.ndarray, keep: bool = False):
        """Scores (time, batch, tag) of windows (batch, time)."""
        x = self.w["embedding"][windows.T]
        (hf, kf), (hb, kb) = self.lstm(x, "f", keep), self.lstm(x, "b", keep)
        h = np.concatenate([hf, hb], 2)
        return h @ self.w["out"] + self.w["out_bias"], (x, h, kf, kb)

    def marginals(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log partition, tag marginals, and expected transitions summed over time and batch."""
        steps, n, _ = scores.shape
        tr = self.w["transitions"]
        alpha, beta = np.empty_like(scores), np.zeros_like(scores)
        alpha[0] = scores[0]
        for t in range(1, steps):
            alpha[t] = log_sum(alpha[t - 1][:, :, None] + tr, 1) + scores[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = log_sum(tr + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
        total = log_sum(alpha[-1], 1)
        tags = np.exp(alpha + beta - total[None, :, None])
        pairs = np.exp(alpha[:-1, :, :, None] + tr + (scores[1:] + beta[1:])[:, :, None, :] - total[None, :, None, None])
        return total, tags, pairs.sum((0, 1))

    def gradients(self, windows: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss per window and its gradients."""
        n = len(windows)
        scores, (x, h, kf, kb) = self.emissions(windows, True)
        total, marginal, pairs = self.marginals(scores)
        gold = tags.T
        at = np.take_along_axis(scores, gold[:, :, None], 2)[:, :, 0].sum(0)
        at = at + self.w["transitions"][gold[:-1], gold[1:]].sum(0)
        d_scores = marginal.astype(np.float32)
        np.put_along_axis(d_scores, gold[:, :, None], np.take_along_axis(d_scores, gold[:, :, None], 2) - 1, 2)
        d_scores /= n
        seen = np.zeros((TAGS, TAGS), np.float32)
        np.add.at(seen, (gold[:-1].ravel(), gold[1:].ravel()), 1)
        g = {"transitions": (pairs - seen).astype(np.float32) / n, "out_bias": d_scores.sum((0, 1)),
             "out": h.reshape(-1, 2 * UNITS).T @ d_scores.reshape(-1, TAGS)}
        d_h = d_scores @ self.w["out"].T
        d_x = np.zeros_like(x)
        for d, kept, part in (("f", kf, slice(0, UNITS)), ("b", kb, slice(UNITS, None))):
            rec = self.w[f"rec_{d}"]
            g_rec, d_gates = np.zeros_like(rec), np.empty((len(x), n, 4 * UNITS), np.float32)
            dh_next = dc_next = np.zeros((n, UNITS), np.float32)
            for t, i, f, o, c_in, tc, before, c_before in reversed(kept):
                dh = d_h[t][:, part] + dh_next
                dc = dh * o * (1 - tc * tc) + dc_next
                dz = np.concatenate([dc * c_in * i * (1 - i), dc * c_before * f * (1 - f), dh * tc * o * (1 - o),
                                     dc * i * (1 - c_in * c_in)], 1)
                d_gates[t] = dz
                g_rec += before.T @ dz
                dh_next, dc_next = dz @ rec.T, dc * f
            g[f"rec_{d}"] = g_rec
            g[f"in_{d}"] = x.reshape(-1, EMBEDDING).T @ d_gates.reshape(-1, 4 * UNITS)
            g[f"bias_{d}"] = d_gates.sum((0, 1))
            d_x += d_gates @ self.w[f"in_{d}"].T
        g["embedding"] = np.zeros_like(self.w["embedding"])
        np.add.at(g["embedding"], windows.T.ravel(), d_x.reshape(-1, EMBEDDING))
        return float((total - at).mean()), g

    def train(self, windows: np.ndarray, tags: np.ndarray, steps: int = STEPS, seed: int = SEED) -> list[float]:
        """Adam on batches drawn at random; the losses."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(x) for k, x in self.w.items()}
        losses = []
        for step in range(1, steps + 1):
            pick = rng.integers(0, len(windows), BATCH)
            loss, g = self.gradients(windows[pick], tags[pick])
            losses.append(loss)
            rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            for k, x in g.items():
                x = x * min(1.0, 5 / max(norm, 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * x
                v[k] = 0.99 * v[k] + 0.01 * x * x
                self.w[k] = (self.w[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
        self.trained = True
        return losses

    def decode(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags (batch, time), and the probability of each of them."""
        scores, _ = self.emissions(windows)
        steps, n, _ = scores.shape
        tr, best = self.w["transitions"], scores[0]
        back = np.empty((steps, n, TAGS), np.int8)
        for t in range(1, steps):
            paths = best[:, :, None] + tr
            back[t] = paths.argmax(1)
            best = paths.max(1) + scores[t]
        tags = np.empty((steps, n), np.int64)
        tags[-1] = best.argmax(1)
        for t in range(steps - 1, 0, -1):
            tags[t - 1] = back[t][np.arange(n), tags[t]]
        sure = np.ones((steps, n), np.float32)
        some = np.flatnonzero(tags.any(0))  # marginals only where there is something to be sure of
        if len(some):
            _, marginal, _ = self.marginals(scores[:, some])
            sure[:, some] = np.take_along_axis(marginal, tags[:, some, None], 2)[:, :, 0]
        return tags.T, sure.T


def plausible(kind: int, text: str, start: int, end: int) -> bool:
    """Whether a span of the network has the digits of its kind and stands by itself."""
    if start and text[start - 1].isalnum() or end < len(text) and text[end].isalnum():
        return False
    part = text[start:end]
    digits = re.sub("[^0-9]", "", part)
    if kind == 0:
        return bool(re.search(r"@|[\[({]\s?at\s?[\])}]", part, re.I) and re.search(r"[A-Za-z0-9](?:\.|\s?[\[({]\s?dot\s?[\])}]\s?)[A-Za-z]{2}", part))
    if kind == 1:
        parts = re.findall("[0-9]+", part)
        return len(parts) == 4 and all(map(small, parts))
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15 and len(digits) >= 0.6 * len(part) and bool(re.search(r"[\x20().-]", part))


def decoded_spans(texts: list[str], tagger: Tagger) -> list[list[Span]]:
    """Spans of the network in each text, with all windows reconciled."""
    found: list[list[Span]] = [[] for _ in texts]
    if not tagger.trained:
        return found
    where, rows = [], []
    for k, text in enumerate(texts):
        spots = windows_of(text)
        if not spots:
            continue
        classes = np.concatenate([classes_of(text), np.zeros(WIDTH, np.int64)])
        for region, start in spots:
            where.append((k, region, start))
            rows.append(classes[start:start + WIDTH])
    middle = WIDTH / 2 - np.abs(np.arange(WIDTH) - (WIDTH - 1) / 2)
    merged: dict[tuple[int, int], list] = {}

    def finish(key, tags, sure):
        k, region = key
        text = texts[k]
        edges = np.flatnonzero((tags[1:] != tags[:-1]) | (tags[1:] % 2 == 1))
        bounds = [0, *(edges + 1).tolist(), len(tags)]
        runs: list[list[int]] = []
        for a, b in zip(bounds, bounds[1:]):
            if tags[a]:
                kind = (int(tags[a]) - 1) // 2
                if runs and runs[-1][2] == a and runs[-1][1] == kind and tags[a] % 2 == 0:
                    runs[-1][2] = b
                else:
                    runs.append([a, kind, b])
        for a, kind, b in runs:
            if sure[a:b].mean() >= tagger.sure and plausible(kind, text, region + a, min(region + b, len(text))):
                found[k].append((region + a, kind, min(region + b, len(text))))

    open_key, tags, sure, best = None, None, None, None
    for at in range(0, len(rows), 512):
        got, certain = tagger.decode(np.stack(rows[at:at + 512]))
        for (k, region, start), t, c in zip(where[at:at + 512], got, certain):
            if (k, region) != open_key:
                if open_key is not None:
                    finish(open_key, tags, sure)
                open_key = (k, region)
                tags, sure, best = np.empty(0, np.int64), np.empty(0, np.float32), np.empty(0)
            offset = start - region
            grow = offset + WIDTH - len(tags)
            tags, sure, best = np.r_[tags, np.zeros(grow, np.int64)], np.r_[sure, np.ones(grow, np.float32)], np.r_[best, np.full(grow, -1.0)]
            part = slice(offset, offset + WIDTH)
            better = middle > best[part]
            tags[part] = np.where(better, t, tags[part])
            sure[part] = np.where(better, c, sure[part])
            best[part] = np.maximum(best[part], middle)
    if open_key is not None:
        finish(open_key, tags, sure)
    return found


def all_spans(texts: list[str], tagger: Tagger) -> list[tuple[list[Span], list[Span]]]:
    """Base spans, and base and added spans together, of each text."""
    result = []
    for text, more in zip(texts, decoded_spans(texts, tagger)):
        base = base_spans(text)
        added = [s for s in more if not any(s[0] < b[2] and b[0] < s[2] for b in base)]
        result.append((base, sorted(base + added)))
    return result


LETTERS = "abcdefghijklmnopqrstuvwxyz"


def made_up(kind: int, part: str, rng: np.random.Generator) -> str:
    """Data of a kind in a form of its own: with other digits and names, and mostly not as the patterns have it."""

    def digits(n: int) -> str:
        return "".join(map(str, rng.integers(0, 10, n)))

    def word(low: int, high: int) -> str:
        return "".join(LETTERS[k] for k in rng.integers(0, 26, rng.integers(low, high)))

    def pick(*forms):
        return forms[rng.integers(len(forms))]

    if kind == 0:
        name = pick(word(3, 10), f"{word(3, 8)}{pick('.', '_', '-', '')}{word(2, 8)}", f"{word(3, 8)}{pick('.', '')}{digits(2)}")
        domain = [pick(word(3, 10), f"{word(3, 7)}{digits(1)}"), *([word(3, 9)] if rng.random() < 0.5 else []), pick("com", "org", "de", "net", "example", word(2, 5))]
        a = pick("@", " (at) ", "[at]", " [at] ", "(at)", " {at} ", " (AT) ")
        return name + a + pick(".", " (dot) ", "[dot]", "(dot)", " [dot] ").join(domain) if a != "@" else f"{name}@{'.'.join(domain)}"
    if kind == 1:
        return pick(".", "[.]", "(.)", " . ").join(str(k) for k in rng.integers(0, 256, 4))
    if kind == 2:
        n = int(pick(13, 15, 16, 16, 16, 16, 19))
        number = digits(n)
        return pick("", " ", "-", ".", "/", "_").join(number[k:k + 4] for k in range(0, n, 4))
    a, b, c = digits(3), digits(3), digits(4)
    form = pick("({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}", "({}){}-{}", "({}) {} {}", "{}/{}-{}")
    return pick("", "", "", "1-", "+1 ", "001 ") + form.format(a, b, c)


def rewritten(text: str, spans: list[Span], rng: np.random.Generator) -> tuple[str, list[Span]]:
    """A window with most of its spans replaced by other data of the same kind."""
    out, made, at = [], [], 0
    size = 0
    for s, kind, e in spans:
        if s < at:
            continue
        part = text[s:e] if rng.random() < 0.2 else made_up(kind, text[s:e], rng)
        before = text[at:s]
        out += [before, part]
        size += len(before)
        made.append((size, kind, size + len(part)))
        size += len(part)
        at = e
    out.append(text[at:])
    return "".join(out), made


def like_base(text: str) -> list[Span]:
    """Base spans, and numbers that fail only the check of a card's digits or of the parts of an address."""
    spans = base_spans(text)
    more = [(m.start(), 1, m.end()) for m in IP.finditer(text)]
    more += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 13 <= len(re.sub("[^0-9]", "", m[0])) <= 19]
    return sorted(spans + [s for s in more if not any(s[0] < b[2] and b[0] < s[2] for b in spans)])


def labelled_windows(docs: DataFrame) -> DataFrame:
    """(kind, text, spans): text around each place that may hold personal data, with its base spans;
    kind is that of the first span, or -1."""

    def run(batches):
        for batch in batches:
            kinds, parts, marks = [], [], []
            for text in texts_of(batch["text"]):
                base = like_base(text)
                for _, start in windows_of(text):
                    # A margin on either side leaves room for rewriting and for moving the window.
                    a, b = max(0, start - STRIDE), start + WIDTH + STRIDE
                    inside = [s for s in base if a <= s[0] and s[2] <= b]
                    kinds.append(inside[0][1] if inside else -1)
                    parts.append(text[a:b])
                    marks.append([[s - a, k, e - a] for s, k, e in inside])
            yield {"kind": kinds, "text": parts, "spans": marks}

    return map_batches(docs.select("text"), run, "kind int, text string, spans array<array<int>>")


def cut_window(text: str, spans: list[Span], rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Classes and tags of ``WIDTH`` characters of a text, mostly with the first span in view."""
    start = int(rng.integers(0, max(1, len(text) - WIDTH + 1)))
    if spans and rng.random() < 0.8:
        start = max(0, min(spans[0][0] - int(rng.integers(0, WIDTH // 2)), len(text) - 8))
    return np.concatenate([classes_of(text[start:start + WIDTH]), np.zeros(WIDTH, np.int64)])[:WIDTH], tags_of(spans, start)


def set_sure(tagger: Tagger, kept_out: list[tuple[str, list[Span]]]) -> None:
    """The least of ``SURE`` at which no span found in the texts lies beside their data.

    The margins of a text do not count: what stands there may be the rest of something that was cut.
    """
    def astray(text: str, spans: list[Span], s: Span) -> bool:
        return STRIDE <= s[0] and s[2] <= len(text) - STRIDE and all(s[2] <= b[0] or b[2] <= s[0] for b in spans)

    for sure in SURE:
        tagger.sure = sure
        found = decoded_spans([text for text, _ in kept_out], tagger)
        if not any(astray(text, spans, s) for (text, spans), got in zip(kept_out, found) for s in got):
            break


def trained_tagger(docs: DataFrame) -> Tagger:
    """Tagger from at most ``SAMPLE`` windows of each kind and as many without spans, least hashes first."""
    rows = staged(labelled_windows(docs).groupBy("kind", "text").agg(F.min("spans").alias("spans")), "windows")
    counts = {r["kind"]: r["count"] for r in rows.groupBy("kind").count().collect()}
    picked = []
    for kind in range(-1, len(KINDS)):
        found = least_hashes(rows.where(F.col("kind") == kind), ["text"], SAMPLE, counts.get(kind, 0)).collect()
        picked += [(r["text"], [tuple(s) for s in r["spans"]]) for r in found]
    return learnt(picked)


def learnt(picked: list[tuple[str, list[Span]]]) -> Tagger:
    """Tagger from texts with their spans."""
    tagger, rng = Tagger(), np.random.default_rng(SEED)
    windows, tags, kept_out = [], [], []
    kinds = Counter(spans[0][1] if spans else -1 for _, spans in picked)
    for k, (text, spans) in enumerate(picked):
        if k % KEPT_OUT == 0:
            kept_out.append(rewritten(text, spans, rng))
            continue
        for _ in range(max(VARIANTS, SAMPLE // kinds[spans[0][1] if spans else -1])):
            row = cut_window(*rewritten(text, spans, rng), rng)
            windows.append(row[0])
            tags.append(row[1])
    if any(t.any() for t in tags):
        tagger.train(np.stack(windows), np.stack(tags))
        set_sure(tagger, kept_out)
    return tagger


def find(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """doc_id, counts by kind and digest of the base spans, and all spans, of every document."""
    shared = share(docs.sparkSession, tagger or trained_tagger(docs))

    def run(batches):
        model = shared()
        for batch in batches:
            found = all_spans(texts_of(batch["text"]), model)
            counts = {f"n_{name}": [sum(s[1] == k for s in base) for base, _ in found] for k, name in enumerate(KINDS)}
            yield {"doc_id": batch["doc_id"], **counts, "spans": [written(spans) for _, spans in found],
                   "base_sha256": [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found]}

    return map_batches(docs.select("doc_id", "text"), run,
                       "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, or group of spans that overlap, replaced by the name of its first kind."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """``docs`` with personal data in ``text`` masked and ``n_chars``, where there is one, set anew; null texts stay null."""
    shared = share(docs.sparkSession, tagger or trained_tagger(docs))

    def run(batches):
        model = shared()
        for batch in batches:
            texts = batch["text"].to_pylist()
            found = all_spans([t or "" for t in texts], model)
            new = [t and masked(t, spans) for t, (_, spans) in zip(texts, found)]
            made = {"text": new}
            if "n_chars" in batch:
                old = batch["n_chars"].to_pylist()
                made["n_chars"] = [len(n) if n != t else c for n, t, c in zip(new, texts, old)]
            yield batch | made

    return map_batches(docs, run, docs.schema)


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    return find(read_table(spark, folder, "documents"))
