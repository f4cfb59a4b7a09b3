"""Exact and near duplicates against plain Python."""

import hashlib
import random
from collections import defaultdict

import pytest

from tidewell.llm import exact_dedup, ngram_join
from tidewell.llm.exact_dedup import DigestIndex

from samples import ODD

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def least(x):
    return (x is not None, x)


def test_exact_groups(odd):
    got = exact_dedup.deduplicate(odd).collect()
    groups = defaultdict(list)
    for doc_id, text in ODD:
        groups[hashlib.sha256((text or "").translate(LOWER).encode()).hexdigest()].append(doc_id)
    assert sorted(((r.doc_id, r.text_sha256, r.group_size) for r in got), key=str) == sorted(
        ((i, h, len(ids)) for h, ids in groups.items() for i in ids), key=str)
    for r in got:
        assert r.keep_id == max(groups[r.text_sha256], key=least)
    assert sum(r.kept for r in got) == len(groups)  # of rows that repeat id and text, one


def test_exact_of_nothing(nothing):
    assert exact_dedup.deduplicate(nothing).count() == 0
    assert exact_dedup.keep_one(nothing).count() == 0


def test_keep_one_keeps_columns(odd):
    got = exact_dedup.keep_one(odd)
    assert got.columns == odd.columns
    rows = got.select("doc_id", "text").collect()
    assert len(rows) == len({(r.text or "").translate(LOWER) for r in rows}) == len({(t or "").translate(LOWER) for _, t in ODD})
    assert 11 in {r.doc_id for r in rows} and 5 not in {r.doc_id for r in rows}


def test_index_outlives_a_batch(spark, documents, tmp_path):
    folder = str(tmp_path / "index")
    index = DigestIndex(spark, folder, 4)
    first = documents("one", "two", extra=False)
    exact_dedup.deduplicate(first, index)
    again = DigestIndex(spark, folder, 4)
    second = documents((10, "ONE"), (11, "three"), extra=False)
    got = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.deduplicate(second, again).collect()}
    assert got == {10: (0, False), 11: (11, True)}
    exact_dedup.deduplicate(second, again)  # a batch that is added twice changes nothing
    assert again.read().count() == 3


# ---- near duplicates

def shingles(text):
    words = (text or "").translate(LOWER)
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4)))


def brute_components(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                i, j = find(i), find(j)
                parent[max(i, j)] = min(i, j)
    return {i: find(i) for i, _ in sets}


def check_near(df, rows):
    got = ngram_join.near_duplicates(df).collect()
    assert len(got) == len(rows)
    want = brute_components(rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert all(r.component_id is None for r in got if r.doc_id is None)
    sizes = defaultdict(set)
    for i, t in rows:
        sizes[i].add(len(shingles(t)))
    assert all(r.n_shingles in sizes[r.doc_id] for r in got)


def test_near_odd(odd):
    check_near(odd, ODD)


def test_near_of_nothing(nothing):
    assert ngram_join.near_duplicates(nothing).count() == 0
    assert ngram_join.keep_first(nothing).count() == 0


@pytest.mark.parametrize("frequent", [2, 64])
def test_near_against_brute_force(documents, monkeypatch, frequent):
    """Edited copies around the threshold, shared passages, chains; with frequent tokens from 3 sets on, combinations
    carry most of the work."""
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    rng = random.Random(frequent)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = [f"p{k}" for k in range(60)]
    rows = []
    for base in range(40):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 8, 12, 16, 18, 21, 30, 60, 150, 400]))]
        if base % 3 == 0:
            words[5:5] = passage
        for copy in range(rng.choice([1, 2, 5, 12])):
            text = list(words)
            for _ in range(rng.choice([0, 1, 2, 4, max(1, len(words) // 30)]) if copy else 0):
                at = rng.randrange(len(text))
                kind = rng.random()
                text[at:at + 1] = [] if kind < 0.3 and len(text) > 1 else [rng.choice(vocabulary)] * (1 if kind < 0.8 else 2)
            rows.append((len(rows), " ".join(text).upper() if copy % 4 == 3 else " ".join(text)))
    rng.shuffle(rows)
    want = brute_components(rows)
    assert len(set(want.values())) < len(want)
    check_near(documents(*rows), rows)


def test_combinations_lose_no_pair():
    """Prefix keys of any two linked sets meet, whatever tokens are frequent."""
    import numpy as np
    rng = np.random.default_rng(1)
    for trial in range(400):
        n = int(rng.choice([2, 5, 9, 14, 15, 16, 17, 20, 22, 40, 90, 200]))
        universe = rng.permutation(2 ** 20)[:2 * n + 50].astype(np.uint64) * np.uint64(2654435761)
        x = set(universe[:n].tolist())
        drop = int(rng.integers(0, max(1, n // 4) + 1))
        y = set(list(x)[drop:]) | set(universe[n:n + int(rng.integers(0, max(1, n // 4) + 1))].tolist())
        linked = 100 * len(x & y) >= 75 * len(x | y)
        often = rng.random() < 0.8
        counts = {t: int(rng.integers(65, 200)) if often and rng.random() < 0.9 else 2 for t in x | y}
        keys = []
        for s in (x, y):
            shared = np.array(sorted(s, key=lambda t: (counts[t], t)), np.uint64)
            keys.append(set(ngram_join.prefix_keys(len(s), np.array([counts[int(t)] for t in shared]), shared).tolist()))
        if linked:
            assert keys[0] & keys[1], (trial, n)


def test_keep_first(odd):
    got = ngram_join.keep_first(odd)
    assert got.columns == odd.columns
    ids = [r.doc_id for r in got.select("doc_id").collect()]
    want = brute_components(ODD)
    assert sorted(ids, key=str) == sorted([i for i, _ in ODD if i is None or want[i] == i], key=str)
