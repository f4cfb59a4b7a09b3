"""Embedding near-duplicates and code compression against brute force."""

import hashlib
import math

import numpy as np
import pytest

from tidewell.llm import product_quantisation
from tidewell.llm.code_compression import Books, compress, nearest
from tidewell.llm.product_quantisation import COSINE, Index, dealt, near_duplicates, unit

VECTORS = "vec_id bigint, embedding array<float>, label int, code string, links int, vid string"


def frame(spark, rows):
    """Vectors with extra columns of clashing names."""
    return spark.createDataFrame([(i, v, label, "x", 1, "y") for i, v, label in rows], VECTORS)


def clouds(rng, n, groups, spread, dim=32):
    """Unit vectors, the last ones near copies of a few centres."""
    base = rng.normal(size=(n, dim))
    for size in groups:
        centre = rng.normal(size=dim)
        centre /= np.linalg.norm(centre)
        noise = rng.normal(size=(size, dim)) * spread / math.sqrt(dim)
        base = np.concatenate([base, centre + noise])
    return (base / np.linalg.norm(base, axis=1, keepdims=True)).astype(np.float32)


def brute_links(ids, vectors):
    """{row: (n_links, component)} by all pairs."""
    rows = [None if v is None or not len(v) or any(x is None or not math.isfinite(x) for x in v) or not any(v) else
            np.array(v, float) / np.linalg.norm(np.array(v, float) / max(map(abs, v))) / max(map(abs, v)) for v in vectors]
    n = len(rows)
    near = [[j for j in range(n) if j != i and rows[i] is not None and rows[j] is not None and len(rows[i]) == len(rows[j])
             and float(rows[i] @ rows[j]) >= COSINE] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        named = [ids[j] for j in seen if ids[j] is not None]
        component = min(named) if named and ids[i] is not None else None
        out.append((ids[i], len(near[i]), component, ids[i] is not None and ids[i] == component))
    return sorted(out, key=str)


def got_links(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


def test_links_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    # Tight groups, wide ones of which only some pairs link, and chains along a turning direction.
    v = clouds(rng, 300, [150, 40, 3], 0.12)
    v = np.concatenate([v, clouds(rng, 0, [120, 60], 0.31)])
    turn = np.zeros((40, 32), np.float32)
    turn[:, 0], turn[:, 1] = np.cos(np.arange(40) * 0.25), np.sin(np.arange(40) * 0.25)
    v = np.concatenate([v, turn])
    ids = rng.permutation(len(v)).tolist()
    rows = [(i, x.tolist(), i % 3) for i, x in zip(ids, v)]
    got = got_links(near_duplicates(frame(spark, rows)))
    want = brute_links(ids, [x for _, x, _ in rows])
    assert got == want
    assert {c for _, _, c, kept in want if kept} and max(n for _, n, _, _ in want) > 100


def test_hidden_rows_of_links(spark):
    a, b = [1.0, 0.0, 0.0], [0.99, 0.05, 0.0]
    rows = [(5, a, 1), (3, b, None), (None, a, 2), (7, None, 1), (7, [0.0, 0.0, 0.0], 1), (8, [1.0, None, 0.0], 1), (9, [float("nan"), 1.0, 0.0], 1),
            (10, [float("inf"), 1.0, 0.0], 1), (11, [], 1), (12, [1.0, 0.0], 1), (13, [2.0, 0.0], 1), (5, a, 1), (20, [0.0, 0.0, 1e30], 1), (21, [0.0, 0.0, 1e-30], 1),
            (22, [0.0, -1.0, 0.0], 1), (None, [0.0, 1.0, 0.0], 1)]
    want = brute_links([r[0] for r in rows], [r[1] for r in rows])
    assert got_links(near_duplicates(frame(spark, rows))) == want
    assert near_duplicates(frame(spark, rows).where("false")).count() == 0
    assert got_links(near_duplicates(frame(spark, [(1, None, 1)]))) == [(1, 0, 1, True)]


def test_blocks_meet_once(spark, monkeypatch):
    """Small blocks: every two members of a cell, and every member and query, meet in one comparison."""
    for a, v in ((1, 0), (1, 1), (1, 3), (3, 0), (3, 1), (4, 3)):
        for shell in (True, False):
            entries = [(True, i) for i in range(a)] + [(False, b) for b in range(v)]
            k = len(entries)
            cell = np.full(k, 10 if shell else 11)
            member, block = np.array([m for m, _ in entries]), np.array([b for _, b in entries])
            entry, first, second, side = dealt(cell, member, block, np.full(k, a), np.full(k, v))
            met = []
            for task in set(zip(first.tolist(), second.tolist())):
                at = (first == task[0]) & (second == task[1])
                left, right = entry[at & side].tolist(), entry[at & ~side].tolist()
                met += [(x, y) for x in left for y in right]
                if shell and task[0] == task[1]:
                    met += [(x, x) for x in left]
            want = [(i, a + b) for i in range(a) for b in range(v)]
            if shell:
                want += [(i, j) for i in range(a) for j in range(i, a)]
            assert sorted(met) == sorted(want), (a, v, shell)


def test_many_small_blocks_change_nothing(spark, monkeypatch):
    v = clouds(np.random.default_rng(5), 150, [90], 0.2, dim=16)
    rows = [(i, x.tolist(), 0) for i, x in enumerate(v)]
    monkeypatch.setattr(product_quantisation, "BLOCK", 16)
    assert got_links(near_duplicates(frame(spark, rows))) == brute_links([r[0] for r in rows], [r[1] for r in rows])


def test_estimates_never_rule_out_a_link():
    rng = np.random.default_rng(1)
    v = unit(clouds(rng, 400, [100], 0.3))
    index = Index.fit(v, 5000)
    at = index.place(v)
    codes, left = index.encode(v, at["home"])
    for list_ in range(len(index.centres)):
        far = np.sqrt(np.maximum(index.estimates(v, list_, codes), 0))
        mine = at["home"] == list_
        true = np.sqrt(np.maximum(2 - 2 * v @ v.T, 0))
        assert (far[:, mine] - left[mine] <= true[:, mine] + 1e-4).all()


def test_reach_of_half_a_chord_loses_no_list():
    rng = np.random.default_rng(2)
    v = unit(clouds(rng, 2000, [300, 200], 0.3, dim=24))
    index = Index.fit(v, len(v), deviations=1e9)
    at = index.place(v)
    lists = [{int(h)} for h in at["home"]]
    for r, x in zip(at["row"].tolist(), at["visited"].tolist()):
        lists[r].add(x)
    for i, j in zip(*np.nonzero(np.triu(v @ v.T >= COSINE, 1))):
        assert int(at["home"][j]) in lists[i] or int(at["home"][i]) in lists[j]


@pytest.mark.parametrize("folder", ["/root/testdata/check_s"])
def test_recall_on_the_tables(spark, folder):
    import os
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    table = spark.read.parquet(f"{folder}/embeddings.parquet").toArrow()
    v = unit(np.array(table["embedding"].to_pylist()))
    links = sum(int((v[k:k + 2000] @ v.T >= COSINE).sum()) for k in range(0, len(v), 2000)) - len(v)
    got = product_quantisation.op11_embedding_near_dedup(spark, folder).selectExpr("sum(n_links)").first()[0]
    assert got <= links and got >= 0.999 * links and links > 0


# ---- code compression

def plain_codes(rows, rounds=4):
    """The contract in plain Python integers."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    cut = [[v[k * len(v) // 4:(k + 1) * len(v) // 4] for k in range(4)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:256]] for p in range(4)]

    def near(p, x):
        return min(((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p])))

    for _ in range(rounds):
        for p in range(4):
            held = {}
            for c in cut:
                held.setdefault(near(p, c[p])[1], []).append(c[p])
            for k, xs in held.items():
                books[p][k] = [sum(col) // len(xs) for col in zip(*xs)]
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    out = []
    for (i, _, label), c in zip(kept, cut):
        found = [near(p, c[p]) for p in range(4)]
        out.append([i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label])
    total = {}
    for _, _, e, label in out:
        total[label] = total.get(label, 0) + e
    return sorted(((i, code, e, total[label], digest) for i, code, e, label in out), key=str)


def got_codes(df):
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed, n, dim", [(0, 600, 8), (1, 40, 12), (2, 400, 4)])
def test_codes_equal_plain_rounds(spark, seed, n, dim):
    rng = np.random.default_rng(seed)
    # Coarse values make many ties; repeated rows and ids too.
    v = np.round(rng.normal(size=(n, dim)) * 3) / (2048 if seed == 2 else 4)
    rows = [(int(i) if i % 11 else None, x.tolist(), [None, 1, 2][i % 3]) for i, x in zip(rng.integers(0, n, n), v)]
    rows += rows[:20] + [(1, None, 1), (2, [None] * dim, 1), (3, [float("nan")] * dim, 1), (4, [float("-inf")] * dim, None), (5, [], 2)]
    assert got_codes(compress(frame(spark, rows))) == plain_codes(rows)


def test_codes_of_nothing(spark):
    assert compress(frame(spark, [(1, None, 1)])).count() == 0
    assert compress(frame(spark, [(1, None, 1)]).where("false")).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_codes_of_lengths_and_large_components(spark):
    rows = [(1, [1.0, 2.0, 3.0, 4.0, 5.0], 1), (2, [-1.0, 2.0, 3.0, 4.0, 5.0], 1), (3, [1.0] * 4, 1), (4, [1e30, 0.0, 0.0, 0.0, 0.0], 1)]
    assert [r[0] for r in got_codes(compress(frame(spark, rows)))] == [1, 2]
    assert got_codes(compress(frame(spark, rows[:2]))) == plain_codes(rows[:2])


def test_bounds_hold_and_spare_distances():
    """After each round every bound is below the distances it stands for, and few distances are computed."""
    rng = np.random.default_rng(4)
    centres = rng.integers(-4000, 4000, (40, 4))
    x = np.repeat(centres[rng.integers(0, 40, 3000)], 1, axis=0) + rng.integers(-60, 60, (3000, 4))
    books = Books(np.tile(x[:64], (1, 4)))
    groups = books.groups[0]
    own, bounds, stamps = np.full(len(x), -1), np.zeros((len(x), len(groups))), np.zeros((len(x), len(groups)), np.int64)
    looked = []
    for t in range(5):
        before = own
        own, far, count = nearest(books, 0, x, own, bounds, stamps)
        all_far = ((x[:, None, :] - books.now[0][None]) ** 2).sum(2)
        assert (own == all_far.argmin(1)).all() and (far == all_far.min(1)).all()
        moved = books.displacement(0)
        for g, members in enumerate(groups):
            others = all_far[:, members].astype(float)
            others[members[None, :] == own[:, None]] = np.inf
            low = bounds[:, g] - moved[stamps[:, g], g]
            assert (low <= np.sqrt(others.min(1)) + 1e-9).all()
        looked.append(count / all_far.size)
        sums = {(0, int(k)): (int((own == k).sum()), x[own == k].sum(0)) for k in np.unique(own)}
        books.add(sums)
    assert looked[0] == 1 or looked[0] > 0.2
    assert max(looked[2:]) < 0.3


def test_net_displacement_is_below_the_drifts():
    books = Books(np.zeros((4, 4), np.int64) + np.arange(4)[:, None] * 100)
    for step in (7, -5, 3):
        books.add({(0, k): (1, books.now[0][k] + step) for k in range(4)})
    way = books.displacement(0)
    assert np.allclose(way[0], 5) and np.allclose(way[1], 2) and np.allclose(way[3], 0)  # 7, 2, 5: 15 in drifts
