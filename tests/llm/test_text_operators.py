"""Extraction, quality rules, byte-level BPE and packing against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from samples import ODD
from tidewell.llm import byte_bpe, html_extraction, packing, quality_rules

# ---- HTML

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a = "</p>";</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href="/a">Home</a><li><a>News</a></ul></nav>
<!-- <p>commented out</p> --><div class="cookie-notice"><p>We use cookies, as you know.</p></div>
{article}
<aside><p>Read also, of course, this long text, please.</p></aside>
<form><label>Mail</label><input value="x"></form>
<section id="comments"><article class="comment"><p>Great post, thank you, really.</p></article></section>
<footer>&copy; 2020 All, rights.</footer></body></html>"""


def test_article_is_found():
    article = "<article><h1>Head&amp;line</h1><p><b>First  paragraph,\n with a <a href=x>link</a>. It&#39;s long.<p>Second &lt;one&gt;, too.<br>Line two.</article>"
    want = "Head&line\nFirst paragraph, with a link. It's long.\nSecond <one>, too. Line two."
    assert html_extraction.main_text(PAGE.format(article=article)) == want
    # Without marks, the paths decide.
    plain = article.replace("article>", "div>")
    assert html_extraction.main_text(PAGE.format(article=plain)) == want


def test_lists_and_quotes_of_an_article_stay():
    long = "A sentence of some length, with commas, and with stops. " * 80
    article = f"<article><h1>Head</h1><p>{long}</p><ul><li>one thing<li>other</ul><blockquote><p>Said so.</p></blockquote><ul class=share><li>Post</ul></article>"
    assert html_extraction.main_text(PAGE.format(article=article)).split("\n") == ["Head", long.strip(), "one thing", "other", "Said so."]


SENTENCES = "Thirty characters, or so, here. " * 9
ROWS = "".join(f"<tr><td>{k}<td>{k + 1}" for k in range(30))
CELLS = [str(k + j) for k in range(30) for j in (0, 1)]


@pytest.mark.parametrize("mark", ["article", "div"])
@pytest.mark.parametrize("inner, lines", [
    ("<h1><a href=/t>Title</a></h1>{p}<ul><li><a href=/s>Source one</a><li><a href=/r>Source two</a></ul>", ["Title", "{p}", "Source one", "Source two"]),
    ("{p}{p}<ul><li>An entry of the list with forty letters<li>Short</ul>", ["{p}", "{p}", "An entry of the list with forty letters", "Short"]),
    ("{p}<table>" + ROWS + "</table>", ["{p}", *CELLS])])
def test_all_blocks_of_the_content_stay(mark, inner, lines):
    article = f"<div><ul><li><a href=/x>Elsewhere</a></ul></div><{mark}>{inner.replace('{p}', f'<p>{SENTENCES * 20}</p>')}</{mark}>"
    want = [(SENTENCES * 20).strip() if x == "{p}" else x for x in lines]
    assert html_extraction.main_text(PAGE.format(article=article)).split("\n") == want


def test_content_in_sections_and_cells():
    p = f"<p>{SENTENCES}</p>"
    page = f"<body><table><tr><td><a href=/>Menu</a><td><div><h2><a>One</a></h2>{p}</div><div>{p}<ol><li>x</ol></div></table></body>"
    assert html_extraction.main_text(page).split("\n") == ["One", SENTENCES.strip(), SENTENCES.strip(), "x"]


STORY = "<h1>Head</h1>" + f"<p>{SENTENCES}</p>" * 4


@pytest.mark.parametrize("page", [
    # Words of a class or id count as a whole, and a name hides no region that holds the story.
    "<body><div class='layout has-sidebar'><article>{s}</article></div>", "<div class='page no-footer'><article>{s}</article></div>",
    "<div id='article-ad-free'><article>{s}</article></div>", "<article class='post shareable share'>{s}</article>",
    "<div class='widget'><div>{s}</div></div>", "<form><div>{s}</div><fieldset><p>Your name, please.</p></fieldset></form>",
    # A marked teaser does not win against an unmarked story.
    "<article><a>Other story</a></article><div>{s}</div>", "<article><p>Other, short story.</p></article><div>{s}</div>",
    # Without marks: headers, side columns and imprints.
    "<div class='header'><p>Some site, of the best.</p></div><div>{s}</div>", "<div id='header'><h1>Site</h1></div><div>{s}</div>",
    "<div><div><p>Short note, here.</p><p>Other note.</p></div><div>{s}</div></div>",
    "<div class=topbar><p>Call us, today.</p></div><div>{s}</div><div id='bottom'><p>Imprint, of the firm, in the town.</p></div>",
    "<div class=site-header><p>Site, of sites.</p></div><div>{s}<div class='comment-list'><p>" + SENTENCES + "</p></div></div>",
    "<main><div class=header><h1>Head</h1></div>" + STORY.removeprefix("<h1>Head</h1>") + "</main>"])
def test_ratios_decide_with_and_without_marks(page):
    want = "\n".join(["Head", *[SENTENCES.strip()] * 4])
    assert html_extraction.main_text(page.replace("{s}", STORY)) == want


def test_unmarked_article_of_many_regions():
    parts = "".join(f"<div class=part><div><p>{SENTENCES}</p></div></div>" for _ in range(6))
    page = f"<body><div><p>Aside, short.</p></div><div class=story>{parts}</div></body>"
    assert html_extraction.main_text(page) == "\n".join([SENTENCES.strip()] * 6)


def test_smoothing_over_the_tree_is_that_of_all_pairs():
    rng = random.Random(5)
    paths = [html_extraction.Path(None, None, 1.0)]
    for _ in range(60):
        path = html_extraction.Path(rng.choice(paths), None, 1.0)
        path.length, path.marks, path.count = rng.randrange(500), rng.randrange(9), rng.randrange(1, 4)
        paths.append(path)

    def line(path):
        return [path, *line(path.parent)] if path is not None else []

    def apart(a, b):
        shared = {id(p) for p in line(a)} & {id(p) for p in line(b)}
        return len(line(a)) + len(line(b)) - 2 * len(shared)

    html_extraction.smoothed(paths)
    for a in paths:
        want = sum(html_extraction.DECAY ** apart(a, b) * b.ratio() for b in paths)
        assert a.smooth == pytest.approx(want)


@pytest.mark.parametrize("page", ["<div>text, so. " * 20_000, "<div class=a><p>x" * 20_000, "<ul><li>" * 20_000 + "text, so.", "<p>" * 20_000,
                                  "<div>" * 20_000 + "x" + "</span></div>" * 20_000])
def test_deep_pages_take_linear_time(page):
    import time
    started = time.perf_counter()
    assert html_extraction.main_text(page) != "" or page.startswith("<p>")
    assert time.perf_counter() - started < 3


@pytest.mark.parametrize("page, want", [
    ("", ""), ("<p>x", "x"), ("no tags at all, just text.", "no tags at all, just text."), ("a < b and c > d", "a < b and c > d"),
    ("<p>one<script>never closed <p>two", "one"), ("<!-- open", ""), ("<div a='>' b=\">\">text</div>", "text"),
    ("<p>a&nbsp;b</p><p>&amp;lt;</p>", "a b\n&lt;"), ("<ul><li><a>x</a><li><a>y</a></ul>", ""), ("<p " + "'" * 2000, ""),
    ("<" * 5000, "<" * 5000)])
def test_odd_pages(page, want):
    assert html_extraction.main_text(page) == want


def test_pages_on_spark(spark):
    rows = [(1, "u", "<p>Text, here.</p>"), (2, None, None), (2, None, None), (None, "v", "<article><p>" + "long. " * 50_000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, html string, text string")
    got = sorted(((r.page_id, r.url, r.n_chars, r.text[:11]) for r in html_extraction.extract(df).collect()), key=str)
    assert got == sorted([(1, "u", 11, "Text, here."), (2, None, 0, ""), (2, None, 0, ""), (None, "v", 299_999, "long. long.")], key=str)
    assert html_extraction.extract(df.where("false")).count() == 0


# ---- quality rules

BLANK = " \t\n\x0b\x0c\r"


def brute_counts(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines, dup, seen = text.split("\n"), 0, set()
    for line in lines:
        if line.strip(BLANK):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[k:k + 8]) for k in range(len(words) - 7))
    covered = {k + j for k in range(len(words) - 7) if windows[tuple(words[k:k + 8])] > 1 for j in range(8)}
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), dup, len(covered)


def test_base_counts():
    rng = random.Random(4)
    texts = [t or "" for _, t in ODD[:9]] + ["".join(rng.choice("ab \n#|é\x85") for _ in range(rng.randrange(200))) for _ in range(300)]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(300)]
    for text in texts:
        assert quality_rules.base_counts(text) == brute_counts(text)


def brute_model(texts):
    """Modified Kneser-Ney over the classes of characters, in dictionaries."""
    grams = Counter()
    for t in texts:
        g, _ = quality_rules.spell([t])
        grams.update((int(x) >> 12, (int(x) >> 6) & 63, int(x) & 63) for x in g)
    bi = Counter((b, c) for _, b, c in grams)
    uni = Counter(c for _, c in bi)
    p1 = {c: 0.99 * n / sum(uni.values()) + 0.01 / 64 for c, n in uni.items()}

    def level(counts, split, lower):
        c = Counter(counts.values())
        d = [0.5, 1.0, 1.5]
        if c[1] and c[2] and c[3]:
            y = c[1] / (c[1] + 2 * c[2])
            d = [max(k * 0.1, min(k, k - (k + 1) * y * c[k + 1] / c[k])) for k in (1, 2, 3)]
        total, taken = Counter(), Counter()
        for g, n in counts.items():
            total[split(g)] += n
            taken[split(g)] += d[min(n, 3) - 1]
        p = {g: (n - d[min(n, 3) - 1]) / total[split(g)] + taken[split(g)] / total[split(g)] * lower(g) for g, n in counts.items()}
        return p, {k: taken[k] / total[k] for k in total}

    p2, w2 = level(bi, lambda g: g[0], lambda g: p1[g[1]])
    p3, w3 = level(grams, lambda g: g[:2], lambda g: p2[g[1:]])

    def log_p(g):
        two = p2.get(g[1:], w2.get(g[1], 1) * p1.get(g[2], 0.01 / 64))
        return np.log(max(1e-12, p3.get(g, w3.get(g[:2], 1) * two)))
    return log_p


def test_texts_are_spelled_in_bounded_runs():
    texts = ["a" * 100, "", "b" * 250, "c" * 100, "d" * 90, "", "e" * 20]
    runs = [texts[k] for k in quality_rules.pieces(texts, 200)]
    assert [t for run in runs for t in run] == texts
    assert all(sum(map(len, run)) <= 200 or sum(map(bool, run)) == 1 for run in runs)
    assert list(quality_rules.pieces([])) == []
    langs = ["en", None, "de", "es", "en", "fr", "en"]
    got = sorted(g + slot * quality_rules.GRAMS for grams, _, own in quality_rules.spelled(texts, langs)
                 for slot, mine in own for g in grams[mine].tolist())
    assert got == sorted(g + quality_rules.slot_of(lang) * quality_rules.GRAMS
                         for t, lang in zip(texts, langs) for g in quality_rules.spell([t])[0].tolist())


def test_model_against_dictionaries(documents):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["the", "cat", "sat", "Mat!", "été", "x9"]) for _ in range(rng.randrange(1, 40))) for _ in range(60)]
    model = quality_rules.train(documents(*texts))
    log_p = brute_model(texts)
    slot = quality_rules.slot_of("en")
    for text in [*texts[:10], "dog #7 unseen zzz", ""]:
        grams, sizes = quality_rules.spell([text])
        got = model.log_p(grams + slot * quality_rules.GRAMS)
        want = [log_p((int(g) >> 12, (int(g) >> 6) & 63, int(g) & 63)) for g in grams]
        assert sizes[0] == len(text) + 1 == len(grams)
        np.testing.assert_allclose(got, want, rtol=1e-4)


def test_probabilities_add_up(documents):
    model = quality_rules.train(documents(*["the cat sat on the mat"] * 3, "a cat ran"))
    slot = quality_rules.slot_of("en") * quality_rules.GRAMS
    grams, _ = quality_rules.spell(["the ca"])
    for context in {int(g) >> 6 for g in grams}:
        total = np.exp(model.log_p(slot + context * 64 + np.arange(64))).sum()
        assert total == pytest.approx(1, abs=1e-4)


def test_characters_against_dictionaries(documents):
    """Every character counts as itself: letters of either case, digits, marks, letters beyond ASCII."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["The", "JOT", "TDN", "mat,", "été", "x91", "Ж", "\0.", "山水"]) for _ in range(rng.randrange(1, 30))) for _ in range(60)]
    model, of_classes, slot = quality_rules.train(documents(*texts)), brute_model(texts), quality_rules.slot_of("en")
    edge, marked = chr(0x10FFFF), []  # no text has it
    for t in texts:
        marked.append(edge * 2 + t + edge)
    grams = Counter(t[k:k + 3] for t in marked for k in range(len(t) - 2))
    c = Counter(grams.values())
    d = [0.5, 1.0, 1.5]
    if c[1] and c[2] and c[3]:
        y = c[1] / (c[1] + 2 * c[2])
        d = [max(k * 0.1, min(k, k - (k + 1) * y * c[k + 1] / c[k])) for k in (1, 2, 3)]
    total, taken = Counter(), Counter()
    for g, n in grams.items():
        total[g[:2]] += n
        taken[g[:2]] += d[min(n, 3) - 1]

    def kind(x):
        return 0 if x == edge else int(quality_rules.symbol_table()[ord(x)]) if ord(x) < 128 else 57 + ord(x) % 7

    before = Counter(x for _, x in {(g[1], g[2]) for g in grams})
    size = Counter(kind(chr(x)) for x in range(0x110000) if chr(x) != edge)
    size[0], size[kind(chr(0x10FFFE))] = 1, size[kind(chr(0x10FFFE))]
    size[57 + 0x10FFFF % 7] += 1

    def p(g):
        alike = sum(n for x, n in before.items() if kind(x) == kind(g[2]))
        within = (0.99 * before[g[2]] / alike + 0.01 / size[kind(g[2])]) if alike else 1 / size[kind(g[2])]
        lower = np.exp(of_classes(tuple(map(kind, g)))) * within
        if g[:2] not in total:
            return lower
        n = grams[g]
        return (n - d[min(n, 3) - 1] if n else 0) / total[g[:2]] + taken[g[:2]] / total[g[:2]] * lower

    for text in [*texts[:10], "Dog #7 JNT unseen Öß 中 x", ""]:
        marks = edge * 2 + text + edge
        keys, sizes = quality_rules.spell_characters([text])
        want = [np.log(p(marks[k:k + 3])) for k in range(len(marks) - 2)]
        assert sizes[0] == len(text) + 1 == len(keys)
        np.testing.assert_allclose(model.characters_log_p(slot, keys), want, rtol=1e-4, atol=1e-6)


def test_probabilities_of_characters_add_up(documents):
    model = quality_rules.train(documents(*["The cat, é 91 sat on Ж"] * 3, "A cat ran 5 été"))
    slot, n = quality_rules.slot_of("en"), quality_rules.POINTS
    points = np.arange(n)
    for context in ("at", "e ", " é", "Zz", " Ж"):
        grams = (ord(context[0]) * n + ord(context[1])) * n + points
        assert np.exp(model.characters_log_p(slot, grams)).sum() == pytest.approx(1, abs=1e-3)


def test_counts_and_logarithms_within_bounds(documents, monkeypatch):
    """Small bounds of what a task holds change nothing."""
    rng = random.Random(6)
    texts = ["".join(chr(rng.choice([97, 98, 65, 75, 233, 240, 0x4E00, 0x4E07]) + rng.randrange(3)) for _ in range(rng.randrange(400))) for _ in range(50)]

    def counted():
        return sorted(tuple(r) for r in quality_rules.count_trigrams(documents(*texts)).collect())

    whole = counted()
    assert sum(n for *_, n in whole) == sum(len(t) + 1 for t in texts)
    monkeypatch.setattr(quality_rules, "COUNTED", 50)
    assert counted() == whole
    monkeypatch.setattr(quality_rules, "CACHE_BITS", 3)
    known, asked = quality_rules.Known(), []
    for _ in range(3):
        grams = np.array([rng.randrange(40) for _ in range(200)], np.int64)
        np.testing.assert_array_equal(known.find(grams, lambda g: asked.append(len(g)) or g * 0.5), grams * 0.5)
    assert len(asked) == 3


def test_texts_that_differ_in_one_character_are_scored_apart(documents):
    """A, K and U, all digits, and letters beyond ASCII seven code points apart had one class."""
    usual = "Anna read the story of the 11 children and the old man at the river for a very long time, été"
    texts = [usual + " " + word for word in "the of and reason letter window garden table morning winter paper stone".split()]
    odd = [usual.replace("A", "K"), usual.replace("11", "99"), usual.replace("é", chr(ord("é") + 7)), usual]
    rows = {r.doc_id: r for r in quality_rules.assess(documents(*texts, *odd)).collect()}
    first = len(texts)
    apart = [rows[first + k].entropy - rows[first + 3].entropy for k in range(3)]
    assert min(apart) > 0.01, apart


def test_quality_odd(odd, nothing):
    got = quality_rules.assess(odd).collect()
    assert len(got) == len(ODD)
    by_id = {r.doc_id: r for r in got if r.doc_id}
    for doc_id, text in ODD:
        if doc_id:
            r = by_id[doc_id]
            n, chars, symbols, dup, repeated = brute_counts(text or "")
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeated)
            assert r.base_failed == (n < 20 or 100 * repeated > 30 * n) and not (r.base_failed and r.kept)
    assert quality_rules.assess(nothing).count() == 0
    assert quality_rules.reject(nothing).count() == 0


def test_bands_reject_what_is_odd(spark, documents):
    rng = random.Random(8)
    good = [" ".join(rng.choice(["the", "of", "and", "reason", "letter", "window", "garden", "table"]) for _ in range(120)) for _ in range(150)]
    noise = ["".join(rng.choice("qxzjk#%&") + rng.choice(" wvy") for _ in range(400)) for _ in range(5)]
    df = documents(*good, *noise).withColumn("lang", __import__("pyspark").sql.functions.expr("if(doc_id % 2 = 0, 'en', null)"))
    kept = quality_rules.reject(df)
    assert kept.columns == df.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert not ids & set(range(150, 155))
    assert len(ids) >= 145


def test_copies_do_not_narrow_the_bands(documents):
    """A third of all rows are copies of one text, most of its language and length."""
    rng = random.Random(9)
    words = "the of and reason letter window garden table morning winter paper stone".split()
    rare = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9))) for _ in range(3000)]

    def text(share, n):
        return " ".join(rng.choice(rare if rng.random() < share else words) for _ in range(n))

    # Texts of one length class whose shares of rare words differ, and so their entropies.
    clean = [text(0.2 + 0.6 * k / 150, 130)[:600] for k in range(150)]
    long = [text(0.5, 400) for _ in range(850)]
    copies = [(10_000 + k, clean[0]) for k in range(500)]
    df = documents(*clean, *copies, *long)
    rows = {r.doc_id: r for r in quality_rules.assess(df).collect()}
    assert sum(rows[k].kept for k in range(150)) >= 145
    assert len(rows) == 1500
    kept = {r.doc_id for r in quality_rules.reject(df).select("doc_id").collect()}
    assert kept == {k for k, r in rows.items() if r.kept}


# ---- byte-level BPE

def reference_encoding():
    import base64

    import public_tokenizers
    import tiktoken
    with open(byte_bpe.ranks_path(), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_round_trip(odd, nothing):
    reference = reference_encoding()
    got = byte_bpe.digests(odd).collect()
    want = []
    for doc_id, text in ODD:
        ids = reference.encode_ordinary(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert byte_bpe.digests(nothing).count() == 0


def test_bpe_offsets_and_split_characters(documents):
    texts = ["Grüße aus 三十 🙂🙃 — don't  stop\n\n now", "é" * 7 + "🙂", "\U0001f9ff" * 3]
    encoded = byte_bpe.encode(documents(*texts))
    coder = byte_bpe.ByteBpe(byte_bpe.ranks_path(), byte_bpe.pattern())
    for r in encoded.collect():
        text = texts[r.doc_id]
        assert "".join(coder.decode_pieces(r.ids)) == text == coder.decode(r.ids).decode()
        assert r.starts[0] == 0 and r.ends[-1] == len(text)
        for k, s, e in zip(r.ids, r.starts, r.ends):
            assert coder.bytes[k] in text[s:e].encode()  # a token of part of a character lies in that character
    decoded = {r.doc_id: r.text for r in byte_bpe.decode(encoded).collect()}
    assert decoded == dict(enumerate(texts))


# ---- packing

def brute_pieces(rows):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    out = []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = ids[k:k + 4096]
            out.append((doc_id, k // 4096, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


def check_places(rows, limit=4096):
    filled = {}
    for r in rows:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    return len(filled)


def test_packing_of_special_tokens(documents):
    words = ("hello", "<|endoftext|>", "<|startoftext|>", "a<|endoftext|>b", "<|ENDOFTEXT|>", "<|endoftext", "|>", "<|", "\u212A<|endoftext|>", "İ", ".")
    rng = np.random.default_rng(6)
    rows = [(0, "hello <|endoftext|> world"), (1, "<|endoftext|>"), (2, "x" * 5000 + "<|startoftext|>")]
    rows += [(k, " ".join(rng.choice(words, 12)) + "".join(rng.choice(words, 3))) for k in range(3, 60)]
    got = packing.pack_documents(documents(*rows)).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(brute_pieces(rows))
    ids = packing.pieces(documents(*rows[:1]), with_ids=True).first().ids
    assert ids == [3306, 49407, 1002, 1]


def test_packing_odd(odd, nothing):
    got = packing.pack_documents(odd).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(brute_pieces(ODD), key=str)
    assert check_places(got) == -(-sum(r.length for r in got) // 4096)
    assert packing.pack_documents(nothing).count() == 0


def test_sequences_hold_the_ids(documents):
    texts = ["One two, three.", "one  TWO", "été " * 3000, ""]
    sequences = packing.sequences(documents(*texts)).collect()
    ids = sorted(k for r in sequences for k in r.ids)
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    assert ids == sorted(k for t in texts for k in [*tokenizer.encode(t, add_special_tokens=False).ids, 1])
    assert all(len(r.ids) <= 4096 for r in sequences)


def test_words_are_encoded_as_in_the_text():
    coder = packing.WordIds(packing.vocabulary_path())
    rng = random.Random(6)
    letters = "aAzZéÉßıİΣσςŒ́̈'st,.!?;:-… \t\n\x0b\x1c\x85\xa012½三ǅWẘ"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(14)))
        want = coder.tokenizer.encode(text, add_special_tokens=False).ids
        assert coder.encode([text])[0] == np.array(want, np.uint32).tobytes(), repr(text)


@pytest.mark.parametrize("shape", ["small", "large", "mixed", "one", "full"])
def test_plan_uses_the_histogram_up(shape):
    rng = np.random.default_rng(3)
    limit = 256
    lengths = {"small": rng.integers(1, 60, 5000), "large": rng.integers(129, 257, 800), "mixed": np.minimum(256, rng.geometric(0.02, 20000)),
               "one": np.array([7]), "full": np.array([256] * 9)}[shape]
    histogram = np.bincount(lengths, minlength=limit + 1)
    plan = packing.plan_patterns(histogram, limit)
    used = np.zeros(limit + 1, np.int64)
    sequences = 0
    for pattern, repeats in plan:
        assert sum(k * n for k, n in pattern.items()) <= limit and repeats > 0
        for k, n in pattern.items():
            used[k] += n * repeats
        sequences += repeats
    assert (used == histogram).all()
    least = max(-(-int(lengths.sum()) // limit), int((lengths > limit // 2).sum()))
    assert sequences <= least * 1.01 + 1
