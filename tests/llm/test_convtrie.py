import hashlib
import random
import zlib

import numpy as np
import pytest

from tickloom.llm import convtrie

COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]
SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """Every node by listing every prefix of every rebuilt conversation."""
    own = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).hexdigest()
            own.setdefault(conv_id, []).append((turn is not None, turn or 0, key, (role, text)))
    own = {c: [t[3] for t in sorted(turns)] for c, turns in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = own.get(c - int(np.fmod(c, 100)), [])
        seq = tuple(base[:h] + turns[h:])
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
        ends.setdefault(seq, []).append(c)
    out = []
    for node, convs in members.items():
        inside = [n for n in members if n[: len(node)] == node]
        children = [n for n in inside if len(n) == len(node) + 1]
        has_child = {n[:-1] for n in inside if n}
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children),
            sum(n not in has_child for n in inside),
            sum((len(members[n]) - 1) * len(n[-1][1]) for n in inside if n),
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def made(seed, n=60):
    """Few texts and lengths, so that prefixes, whole copies and prefixes of others all occur."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.choice([1, 2, 3, 6, 7, 9])):
            rows.append((c * rng.choice([1, 1, 3]), turn, rng.choice("ua"), rng.choice(["x", "yy", "é" * 3])))
    return rows


EDGE = [
    (0, 0, "user", "hello"), (0, 1, "assistant", None), (0, None, None, "first"), (0, 1, "a", "tie"), (0, 1, "a", "tie"),
    (7, 0, "user", "漢字" * 40_000), (None, 0, "user", "nobody"), (-5, 3, "user", "below zero"), (-105, 0, "user", "z"),
    (100, 0, "", ""), (100, None, None, None), (150, 0, "", ""), (151, 0, "", ""), (2**62, 1, "u", "far"),
]


@pytest.mark.parametrize("range_turns", [1, 40, 1 << 17])
def test_random(spark, range_turns):
    rows = made(range_turns)
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(convtrie.conversation_trie(df, range_turns=range_turns)) == plain(rows)


def test_edge_rows(spark):
    df = spark.createDataFrame([(*r, b"x", 1, 0) for r in EDGE], f"{SCHEMA}, ids binary, n int, range int")
    assert got(convtrie.conversation_trie(df, range_turns=2)) == plain(EDGE)


def test_copies_spread_over_ranges(spark):
    """A hundred copies of one conversation, one of them going on, and a common first turn."""
    rows = [(c, t, "u", str(t)) for c in range(1000, 1100) for t in range(4 if c != 1050 else 9)]
    rows += [(c, 0, "u", "0") for c in range(2000, 2100)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(convtrie.conversation_trie(df, range_turns=16)) == plain(rows)


def test_empty_table(spark):
    assert got(convtrie.conversation_trie(spark.createDataFrame([], SCHEMA))) == []


def test_query(spark, sf_dir):
    from tickloom.llm.queries import load, op11_conversations

    rows = [tuple(r) for r in load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert got(op11_conversations(spark, sf_dir)) == plain(rows)


@pytest.mark.parametrize("n", [3, 5, 17, 49, 256])
def test_layouts_keep_their_children(n):
    rng = random.Random(n)
    root = convtrie.Node(b"", 0, 0)
    keys = [bytes([b]) + bytes(7) for b in rng.sample(range(256), n)]
    keys += [k + bytes([i]) + bytes(7) for k in keys[:3] for i in range(2)] + keys[:2]
    for i, key in enumerate(keys):
        convtrie.insert(root, key, i)
    assert root.size == next(s for s in (4, 16, 48, 256) if n <= s)
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        found += [(node.key[: node.end], i) for i in node.ends]
        below = node.children()
        assert [c.key[node.end] for c in below] == sorted(c.key[node.end] for c in below)
        todo += below
    assert sorted(found) == sorted((k, i) for i, k in enumerate(keys))
