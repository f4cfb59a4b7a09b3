"""Prefix trie against a plain one."""

import hashlib
import random
import zlib

import pytest

from tidewell.llm import prefix_trie

TURNS = "conv_id bigint, turn bigint, role string, text string, name string, depth int, n int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], TURNS)


def token(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def words(text):
    return len((text or "").encode().split())


def plain(rows):
    """Nodes by dictionaries."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), token(role, text), (role or "", text or "")))
    own = {c: [t for _, _, t in sorted(turns)] for c, turns in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        head = own.get(c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20)), [])
        made[c] = head[:h] + turns[h:]
    members, ends = {}, {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    out = []
    for node, cs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = sum(not any(len(m) == len(n) + 1 and m[:len(n)] == n for m in below) for n in below)
        saved = sum((len(members[n]) - 1) * words(n[-1][1]) for n in below if n)
        ids = ",".join(map(str, sorted(ends.get(node, []))))
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(children), leaves, saved,
                    hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                   for r in df.collect()), key=str)


def trie_of(table):
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.turns_of(table)))


@pytest.mark.parametrize("seed", range(3))
def test_equals_a_plain_trie(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-60, 400), 150):
        # Few texts, so that many prefixes are shared; some conversations are long, some have gaps in turns.
        for t in range(rng.choice([1, 2, 3, 5, 8, 9, 17, 40 if seed else 3])):
            rows.append((c, t * 2, rng.choice(["user", "assistant"]) if t > 4 else "user", "w " * (t % 3) + rng.choice(["a", "b b", "c"][: 1 + t % 3])))
    assert got(trie_of(frame(spark, rows))) == plain(rows)


def test_odd_rows(spark):
    long = "long " * 60_000
    rows = [(1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (1, 0, "user", "b"), (1, 0, "a", None), (None, 0, "user", "x"),
            (2, 5, "user", long), (3, 5, "user", long), (22, 1, "üser", "Ünïcödé … 三十 🙂"), (20, None, "user", "head"), (20, -3, "user", "second"),
            (40, 0, "u", "only"), (41, 0, "u", "one"), (-5, 0, "u", "one"), (0, 0, "u", "zero"), (17, 3, "x", "\0\x1c\x85 y")]
    assert got(trie_of(frame(spark, rows))) == plain(rows)


def test_turnless_conversations_end_in_the_root(spark):
    # crc32("24") % 4 is 1 or more turns from an absent head, so nothing is left of them.
    rows = [(c, 0, "u", "x") for c in range(21, 40)]
    want = plain(rows)
    assert got(trie_of(frame(spark, rows))) == want
    root = next(r for r in want if r[1] == 0)
    assert root[7] != hashlib.sha256(b"").hexdigest()


def test_no_turns_at_all(spark):
    taken = [c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4]
    rows = [(c, 0, "u", "x") for c in taken]
    assert got(trie_of(frame(spark, rows))) == plain(rows) and len(plain(rows)) == 1
    assert trie_of(frame(spark, [(None, 1, "u", "x")])).count() == 0


def test_one_conversation_for_a_third_of_all(spark):
    """A hot sequence: its ids span several slices and are hashed in order."""
    rows = [(c * 20, 0, "u", "same") for c in range(3000)] + [(c * 20, 1, "u", f"t{c % 7}") for c in range(1500)]
    nodes = got(trie_of(frame(spark, rows)))
    ids = ",".join(str(c * 20) for c in range(1500, 3000))
    top = next(r for r in nodes if r[1] == 1)
    assert len(nodes) == 9 and top == (0, 1, 0, 3000, 7, 7, 2999 + sum(len(range(k, 1500, 7)) - 1 for k in range(7)),
                                       hashlib.sha256(ids.encode()).hexdigest())
