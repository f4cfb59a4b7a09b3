"""Learnt operators: gradients, held-out accuracy, and rows of every kind."""

import math
import random
import zlib

import numpy as np
import pytest

from samples import ODD
from tidewell.llm import lm_scoring, pii, quality_classifier, toxicity


def bucket(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5


@pytest.fixture
def labels(spark):
    def make(*rows):
        return spark.createDataFrame([(*r, "clash") for r in rows], "doc_id bigint, quality int, toxic int, score string")
    return make


# ---- masked language model

def test_lm_gradient():
    """A step against the gradient raises the log-probability that the network itself states."""
    words = lm_scoring.Words([f"w{k}" for k in range(50)])
    network = lm_scoring.Network([10] * 50)
    rng = np.random.default_rng(1)
    numbers, sizes = words.numbers([" ".join(f"w{k}" for k in rng.integers(0, 50, 300))])
    at = lm_scoring.places_of(sizes)
    before = network.log_p(numbers, at).mean()
    trainer = lm_scoring.Trainer(network, 0.01)
    assert trainer.step(numbers, at) == pytest.approx(before, abs=1e-3)
    assert network.log_p(numbers, at).mean() > before


def test_lm_probabilities_add_up():
    words = lm_scoring.Words(["a", "b"])
    network = lm_scoring.Network([5, 3])
    around = np.zeros((lm_scoring.VOCABULARY, 5), np.int32)
    around[:, [0, 1, 3, 4]] = words.numbers(["a b a b"])[0][2:6]
    around[:, 2] = np.arange(lm_scoring.VOCABULARY)
    flat = around.ravel()
    total = np.exp(network.log_p(flat, np.arange(2, len(flat), 5)).astype(np.float64)).sum()
    assert total == pytest.approx(1, abs=1e-3)


def test_lm_windows_of_a_round():
    """What a round looks up is what it needs, at the same places."""
    words = lm_scoring.Words(["a", "b", "c"])
    texts = ["", "a b c d e f g h i j k l m n o p q r s t u v w x y z", "a", "b a", "c " * 40]
    whole, sizes = words.numbers(texts)
    at = lm_scoring.places_of(sizes)
    assert (np.flatnonzero(whole) == at).all()
    nth = np.concatenate([np.arange(n) for n in sizes])
    for every, first in ((16, 1), (6, 3), (3, 0), (1, 0)):
        some, again = words.numbers(texts, every, first)
        assert (again == sizes).all()
        centres = at[nth % every == first % every]
        for place in (*lm_scoring.PLACES, 0):
            assert (some[centres + place] == whole[centres + place]).all()


def test_lm_learns_every_place_once(documents):
    visits = np.zeros(240, int)
    for every, first, _ in lm_scoring.ROUNDS:
        visits[first % every::every] += 1
    assert (visits == 1).all()
    # The first word of a text is learnt too, also where it has no other.
    words, network = lm_scoring.train(documents(*["alpha", "beta", "alpha"] * 100))
    numbers, sizes = words.numbers(["alpha"])
    at = lm_scoring.places_of(sizes)
    assert network.log_p(numbers, at)[0] > lm_scoring.Network([200, 100]).log_p(numbers, at)[0]


def lm_by_hand(inputs, levels, windows):
    """Mean log-probability of the middle words of windows of five, in plain steps and doubles."""
    total = 0.0
    for a, b, target, c, d in windows:
        h = np.tanh(inputs[0, a] + inputs[1, b] + inputs[2, c] + inputs[3, d])
        branch, rest = 0, target
        for weights in levels:
            size = weights.shape[1]
            scores = [sum(x * y for x, y in zip(row, [*h, 1.0])) for row in weights[branch]]
            total += scores[rest % size] - math.log(sum(map(math.exp, scores)))
            branch, rest = branch * size + rest % size, rest // size
    return total / len(windows)


def lm_windows():
    rng = np.random.default_rng(4)
    windows = rng.integers(0, lm_scoring.VOCABULARY, (40, 5)).astype(np.intp)
    windows[:20, 2] = 7  # words of one branch, and the same word in many windows
    windows[:20, 3] = 9
    windows[20:30, 2] = 7 + 160
    network = lm_scoring.Network([50, 40, 30, 20, 10])
    return network, windows, windows.ravel(), np.arange(2, windows.size, 5)


def test_lm_log_p_by_hand():
    network, windows, words, at = lm_windows()
    expected = [lm_by_hand(network.inputs.astype(float), [w.astype(float) for w in network.levels], [w]) for w in windows]
    assert network.log_p(words, at) == pytest.approx(expected, abs=1e-4)


def test_lm_gradient_by_hand():
    """Each kind of weight moves by what differences of the probability by hand give, as Adagrad scales it."""
    network, windows, words, at = lm_windows()
    inputs, levels = network.inputs.astype(float), [w.astype(float) for w in network.levels]
    trainer = lm_scoring.Trainer(network, 0.01)
    assert trainer.step(words, at) == pytest.approx(lm_by_hand(inputs, levels, windows), abs=1e-4)

    def slope(array, place, by=1e-4):
        was, found = array[place], []
        for sign in (1, -1):
            array[place] = was + sign * by
            found.append(lm_by_hand(inputs, levels, windows))
        array[place] = was
        return (found[0] - found[1]) / (2 * by)

    branch = (7 % 10) * 16 + 7 // 10 % 16
    for level, place in ((0, (0, 7, 3)), (0, (0, 2, 24)), (1, (7, 0, 5)), (1, (7, 3, 24)), (2, (branch, 0, 11)), (2, (branch, 1, 24))):
        g = slope(levels[level], place)
        moved = network.levels[level][place] - levels[level][place]
        assert moved == pytest.approx(0.01 * g / math.sqrt(lm_scoring.SEEN + g * g), rel=0.02, abs=1e-5)
    for k, word in ((2, 9), (0, windows[3, 0])):  # a word in many windows, and one of a single window
        g = np.array([slope(inputs, (k, word, u)) for u in range(lm_scoring.UNITS)])
        moved = network.inputs[k, word] - inputs[k, word]
        assert moved == pytest.approx(0.01 * g / math.sqrt(lm_scoring.SEEN + (g * g).mean()), rel=0.05, abs=1e-4)


def test_lm_row_sums():
    rng = np.random.default_rng(3)
    sizes = np.array([1, 1, 2, 3, 4, 5, 1, 40, 9, 4, 1])
    values = rng.standard_normal((sizes.sum(), lm_scoring.UNITS)).astype(np.float32)
    first = np.cumsum(sizes) - sizes
    for n in (len(first), 5):  # with and without long runs
        end = sizes[:n].sum()
        assert lm_scoring.row_sums(values[:end], first[:n]) == pytest.approx(np.add.reduceat(values[:end], first[:n]), abs=1e-5)


def test_lm_numbers_are_staged(documents, monkeypatch):
    """Both rounds and the scores read numbers of words, staged once; every word of every text is among them."""
    rounds, stages = [], []
    train_round, staged = lm_scoring.train_round, lm_scoring.staged
    monkeypatch.setattr(lm_scoring, "train_round", lambda df, *rest: rounds.append(df) or train_round(df, *rest))
    monkeypatch.setattr(lm_scoring, "staged", lambda df, name: stages.append(name) or staged(df, name))
    texts = ["A b\u00a0c \u0130\u03a3 b", None, "", "\x1c z", "b " * 700]
    got = {r.doc_id: r.n_tokens for r in lm_scoring.score(documents(*texts)).collect()}
    assert got == {0: 5, 1: 0, 2: 0, 3: 1, 4: 700}
    assert len(rounds) == len(lm_scoring.ROUNDS) and all("text" not in df.columns for df in rounds)
    assert stages == ["words", "numbers"]
    words = lm_scoring.Words(["b", "c"])
    coded = {r.doc_id: np.frombuffer(r.numbers, np.uint16).tolist() for r in lm_scoring.numbered(documents(*texts), words).collect()}
    other = [1 + lm_scoring.FREQUENT + zlib.crc32(w.encode()) % lm_scoring.BUCKETS for w in ("a", texts[0].split()[3].lower(), "z")]
    assert coded == {0: [other[0], 1, 2, other[1], 1], 1: [], 2: [], 3: [other[2]], 4: [1] * 700}


def test_lm_later_steps(monkeypatch):
    """Steps of a task grow once, with their rate, and every window is in one of them."""
    monkeypatch.setattr(lm_scoring, "BATCH", 50)
    monkeypatch.setattr(lm_scoring, "WARM", 400)
    steps, seen = [], []
    monkeypatch.setattr(lm_scoring.Trainer, "step", lambda self, words, at, times: steps.append((len(at), times)) or seen.extend(at))
    trainer = lm_scoring.Trainer(lm_scoring.Network([5]), 0.1)
    for k in range(3):
        trainer.learn(np.zeros(700, np.intp), np.arange(225 * k, 225 * k + 225))
    assert steps == [*[(50, 1)] * 4, (25, 1), *[(50, 1)] * 4, (25, 2), (100, 2), (100, 2), (25, 2)]
    assert sorted(seen) == list(range(675)) and trainer.windows == 675


def test_lm_prefers_order(documents):
    rng = random.Random(1)
    subjects, verbs, ends = ["cat", "dog", "fox"], ["sees", "likes"], ["red", "blue"]
    texts = [" ".join(f"the {rng.choice(subjects)} {rng.choice(verbs)} the {rng.choice(ends)} thing ." for _ in range(60)) for _ in range(120)]
    probe = texts[0].split()
    rng.shuffle(probe)
    model = lm_scoring.train(documents(*texts))
    got = {r.doc_id: r for r in lm_scoring.score(documents(texts[0], " ".join(probe), None, ""), model).collect()}
    assert got[0].log_likelihood > got[1].log_likelihood + 100
    assert (got[2].n_tokens, got[2].log_likelihood, got[3].mean_log_p) == (0, 0.0, 0.0)
    assert got[0].mean_log_p == pytest.approx(got[0].log_likelihood / 420)


def test_lm_odd(odd, nothing):
    got = lm_scoring.score(odd).collect()
    assert sorted((r.n_tokens for r in got)) == sorted(len((t or "").lower().split()) for _, t in ODD)
    assert all(np.isfinite(r.log_likelihood) for r in got)
    assert lm_scoring.score(nothing).count() == 0


# ---- toxicity

WORDS = "lorem ipsum dolor amet garden window river letter stone paper cloud winter summer morning bread".split()
BAD = ("blorgh", "snarfle", "quizzle")


def toxic_rows(n=500, seed=5):
    rng = random.Random(seed)
    rows, marks = [], []
    for k in range(n):
        words = [rng.choice(WORDS) for _ in range(30)]
        bad = rng.random() < 0.3
        if bad:
            for _ in range(2):
                words.insert(rng.randrange(30), rng.choice(BAD))
        rows.append((k, " ".join(words)))
        marks.append((k, 1, int(bad)))
    return rows, marks


def test_toxicity_learns_and_restores(documents, labels):
    rows, marks = toxic_rows()
    probes = ["a garden bl0rgh qu1zzle river", "window b l o r g h snaaaarfle", "s.n.a.r.f.l.e $narfle stone", "garden window river letter", "", None]
    hidden = [(1000 + k, p) for k, p in enumerate(probes)]
    got = {r.doc_id: r for r in toxicity.score(documents(*rows, *hidden), labels(*marks)).collect()}
    held = [k for k, _, _ in marks if bucket(k) == 0]
    assert len(held) > 50 and all(got[k].held_out for k in held)
    assert all(got[k].predicted == toxic for k, _, toxic in marks if k in set(held))
    assert [got[1000 + k].predicted for k in range(6)] == [1, 1, 1, 0, 0, 0]
    assert all(0 <= r.score <= 1 for r in got.values())


def restorer_of(words):
    text = " ".join(["a", "garden", "window", "a", "river", "letter", "stone", "such", "morning", *words] * 20)
    c = toxicity.letter_classes("  " + text + "  ")
    counts = np.bincount((c[:-2] * toxicity.LETTERS + c[1:-1]) * toxicity.LETTERS + c[2:], minlength=toxicity.LETTERS ** 3).astype(float)
    return toxicity.Restorer(counts, list(words))


def test_disguises_of_one_word():
    """Spacing between other words, a doubled letter, long runs: all are read as the word."""
    restorer = restorer_of(["blorgh", "snarfle"])
    for text in ("b1orgh", "such a b l o r g h", "bblorgh", "b" + "l" * 40 + "orgh", "b.l.o.r.g.h", "b l o r g h s n a r f l e", "BLLORGH!",
                 "a b l 0 r g h", "x" * 40 + "-b1orgh blorgh"):
        assert 0 in restorer.entries(text), text
    assert restorer.entries("b l o r g h s n a r f l e") == [0, 1]
    for text in ("such a letter", "a b c d e f", "", "g a r d e n", "3.5 of 20-30", "z" * 100_000, "ab" * 50_000 + "1", "a" + "1a" * 2000):
        assert restorer.entries(text) == [], text[:20]


def test_decoding_equals_all_readings_of_a_lattice():
    import itertools
    restorer, rng = restorer_of(["blorgh", "moron"]), random.Random(4)
    for _ in range(150):
        token = "".join(rng.choice("bloragh016@$ -.é") for _ in range(rng.randrange(1, 7)))
        best = None
        for path in itertools.product(*restorer.lattice(token)):
            score, x, y = 0.0, 0, 0
            for letters, cost in path:
                score -= cost
                if letters == " ":
                    score, x, y = score + restorer.log_p[x][y][0], 0, 0
                    continue
                for c in letters:
                    k = ord(c) - 96 if "a" <= c <= "z" else 27
                    score += restorer.log_p[x][y][k]
                    x, y = y, k
            score += restorer.log_p[x][y][0]
            if best is None or score > best[0] + 1e-9:
                best = (score, {"".join(p for p, _ in path)})
            elif abs(score - best[0]) <= 1e-9:
                best[1].add("".join(p for p, _ in path))
        assert restorer.decode(token) in best[1], token


def test_toxicity_uses_no_held_out_label(documents, labels):
    rows, marks = toxic_rows(200)
    flipped = [(k, q, 1 - t if bucket(k) == 0 else t) for k, q, t in marks]
    a, b = (sorted((r.doc_id, round(r.score, 9)) for r in toxicity.score(documents(*rows), labels(*m)).collect()) for m in (marks, flipped))
    assert a == b


def test_toxicity_odd(odd, nothing, labels):
    none = labels((1, None, None)).where("false")
    assert len(toxicity.score(odd, none).collect()) == len(ODD)
    got = toxicity.score(odd, labels((1, 1, 1), (4, 0, 0), (5, 1, 1), (6, None, None), (None, 1, 1))).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out for r in got if r.doc_id is None)
    assert toxicity.score(nothing, none).count() == 0


# ---- quality classifier

def test_quality_learns(documents, labels):
    rng = random.Random(3)
    rows, marks = [], []
    for k in range(500):
        words = [rng.choice(WORDS) for _ in range(rng.randrange(25, 60))]
        bad = rng.random() < 0.25
        text = " ".join(f"{w}{'#$%' if bad else ''}" for w in words) + "."
        rows.append((k, text))
        marks.append((k, int(not bad), 0))
    got = {r.doc_id: r for r in quality_classifier.classify(documents(*rows), labels(*marks)).collect()}
    held = [(k, q) for k, q, _ in marks if bucket(k) == 0]
    assert np.mean([got[k].predicted == q for k, q in held]) > 0.98
    flipped = [(k, 1 - q if bucket(k) == 0 else q, 0) for k, q, _ in marks]
    again = {r.doc_id: r.score for r in quality_classifier.classify(documents(*rows), labels(*flipped)).collect()}
    assert all(again[k] == pytest.approx(got[k].score, abs=1e-9) for k in again)


def test_discriminant_is_gaussian():
    """Log-odds are those of two normal densities with the shrunk covariances."""
    rng = np.random.default_rng(0)
    d = len(quality_classifier.FEATURES)
    x = {0: rng.standard_normal((300, d)), 1: rng.standard_normal((500, d)) * 2 + 1}
    moments = {}
    for k, v in x.items():
        one = np.concatenate([np.ones((len(v), 1)), v], 1)
        moments[k] = one.T @ one
    model = quality_classifier.Discriminant(moments)
    q, r = quality_classifier, rng.standard_normal((5, d))
    own = {k: np.cov(v.T, bias=True) for k, v in x.items()}
    pooled = (300 * own[0] + 500 * own[1]) / 800
    density = []
    for k in (0, 1):
        cov = (1 - q.TO_POOLED) * own[k] + q.TO_POOLED * pooled
        cov = (1 - q.TO_DIAGONAL) * cov + q.TO_DIAGONAL * np.diag(np.diag(cov)) + q.RIDGE * np.eye(d)
        gap = r - x[k].mean(0)
        density.append(-0.5 * np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap) - 0.5 * np.linalg.slogdet(cov)[1] + np.log(len(x[k]) / 800))
    np.testing.assert_allclose(model.log_odds(r), density[1] - density[0], rtol=1e-6)


def test_quality_odd(odd, nothing, labels):
    none = labels((1, 1, 1)).where("false")
    for given in (none, labels((1, 1, 0), (4, 0, 0), (5, None, 0), (None, 1, 0)), labels(*[(k, k % 2, 0) for k in range(1, 12)])):
        got = quality_classifier.classify(odd, given).collect()
        assert len(got) == len(ODD) and all(0 <= r.score <= 1 and np.isfinite(r.score) for r in got)
    assert quality_classifier.classify(nothing, none).count() == 0


# ---- personal data

def plain_spans(text):
    import re
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 12 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(3)
    for _ in range(30_000):
        text = "".join(rng.choice("12.@a-+ ()b5é\n.@1") for _ in range(rng.randrange(40)))
        assert pii.base_spans(text) == plain_spans(text), repr(text)


def test_tagger_gradients():
    tagger = pii.Tagger(1)
    rng = np.random.default_rng(2)
    windows, tags = rng.integers(0, pii.CLASSES, (3, 7)), rng.integers(0, pii.TAGS, (3, 7))
    tagger.w = {k: v.astype(np.float64) for k, v in tagger.w.items()}
    tagger.w["transitions"] += rng.standard_normal((pii.TAGS, pii.TAGS)) * 0.3
    _, gradients = tagger.gradients(windows, tags)
    for name in tagger.w:
        where = tuple(rng.integers(0, s) for s in tagger.w[name].shape)
        if name == "embedding":
            where = (int(windows[0, 0]), 3)
        old = tagger.w[name][where]
        losses = []
        for step in (1e-3, -1e-3):
            tagger.w[name][where] = old + step
            losses.append(tagger.gradients(windows, tags)[0])
        tagger.w[name][where] = old
        assert gradients[name][where] == pytest.approx((losses[0] - losses[1]) / 2e-3, abs=2e-3), name


def personal_text(rng):
    words = [rng.choice(WORDS) for _ in range(40)]
    digits = [str(rng.randrange(10)) for _ in range(10)]
    for part in (f"user{rng.randrange(99)}@mail{rng.randrange(9)}.example.com", ".".join(str(rng.randrange(256)) for _ in range(4)),
                 f"+1 ({''.join(digits[:3])}) {''.join(digits[3:6])}-{''.join(digits[6:])}", "".join(str(rng.randrange(10)) for _ in range(16))):
        if rng.random() < 0.7:
            words.insert(rng.randrange(len(words)), part)
    return " ".join(words)


def test_tagger_adds_what_the_patterns_miss(documents):
    """Forms that no pattern has, in texts it was not trained on; and nothing in clean ones."""
    rng = random.Random(9)
    tagger = pii.trained_tagger(documents(*[personal_text(rng) for _ in range(300)]))

    def number(n):
        return "".join(str(rng.randrange(10)) for _ in range(n))

    def card():
        head = number(15)
        full = next(head + c for c in "0123456789" if pii.luhn(head + c))
        return [full[k:k + 4] for k in range(0, 16, 4)]

    forms = {"phone": ("({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}"), "card": (".", "/"),
             "email": ("{} (at) {} (dot) com", "{} [at] {}.org", "{}[at]{}[dot]net")}
    for kind, shapes in forms.items():
        hits = total = 0
        for shape in shapes:
            for _ in range(20):
                if kind == "phone":
                    data = shape.format(str(rng.randrange(200, 999)), number(3), number(4))
                elif kind == "card":
                    data = shape.join(card())
                else:
                    data = shape.format(rng.choice(("joe", "anna.k", "max_m", "lee99")), rng.choice(("mailbox", "web", "post-1")))
                before = " ".join(rng.choice(WORDS) for _ in range(6)) + " "
                text = before + data + " " + " ".join(rng.choice(WORDS) for _ in range(6))
                want = (len(before), pii.KINDS.index(kind), len(before) + len(data))
                assert not pii.base_spans(text)
                hits += want in pii.all_spans([text], tagger)[0][1]
                total += 1
        assert hits >= 0.9 * total, (kind, hits, total)
    clean = [" ".join(rng.choice(WORDS) for _ in range(60)) + f" in {rng.randrange(1900, 2020)} there were {rng.randrange(99)} of 3.5" for _ in range(60)]
    assert not any(spans for _, spans in pii.all_spans(clean, tagger))


def test_decoding_is_the_best_path_and_marginals_add_up():
    """Against all sequences of tags of short windows."""
    import itertools
    tagger, rng = pii.Tagger(4), np.random.default_rng(7)
    tagger.w["transitions"] = (rng.standard_normal((pii.TAGS, pii.TAGS)) * 0.5).astype(np.float32)
    windows = rng.integers(0, pii.CLASSES, (3, 4))
    scores, _ = tagger.emissions(windows)
    tags, sure = tagger.decode(windows)
    total, marginal, _ = tagger.marginals(scores)
    for n in range(len(windows)):
        value = {}
        for path in itertools.product(range(pii.TAGS), repeat=4):
            value[path] = sum(scores[t, n, k] for t, k in enumerate(path)) + sum(tagger.w["transitions"][a, b] for a, b in zip(path, path[1:]))
        assert tuple(tags[n]) == max(value, key=value.get)
        weights = {p: math.exp(v) for p, v in value.items()}
        z = sum(weights.values())
        assert total[n] == pytest.approx(math.log(z), rel=1e-4)
        for t in range(4):
            for k in range(pii.TAGS):
                assert marginal[t, n, k] == pytest.approx(sum(w for p, w in weights.items() if p[t] == k) / z, abs=1e-4)
            if tags[n].any():
                assert sure[n, t] == pytest.approx(marginal[t, n, tags[n][t]], abs=1e-4)


def test_pii_odd(odd, nothing):
    got = pii.find(odd).collect()
    assert len(got) == len(ODD) and all(r.spans == "" for r in got)
    assert pii.find(nothing).count() == 0
    masked = pii.redact(odd)
    assert masked.columns == odd.columns
    assert sorted(((r.doc_id, r.text) for r in masked.select("doc_id", "text").collect()), key=str) == sorted(ODD, key=str)


def test_redaction_replaces_and_counts(documents):
    df = documents("mail a.b@c.example.org, host 10.0.0.1!", None)
    rows = {r.doc_id: r for r in pii.redact(df, pii.Tagger()).collect()}
    assert rows[0].text == "mail [EMAIL], host [IP]!" and rows[0].n_chars == len(rows[0].text)
    assert rows[1].text is None and rows[1].n_chars is None


def test_windows_cover_every_trigger():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("ab  @1") if rng.random() < 0.1 else "x" for _ in range(rng.randrange(400)))
        covered = set()
        for _, start in pii.windows_of(text):
            covered.update(range(start, start + pii.WIDTH))
        assert all(k in covered for k, c in enumerate(text) if c in "@1")
