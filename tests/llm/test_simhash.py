import numpy as np
import pytest
import xxhash
from rows import EDGE, by_id, edge, empty

from tickloom.llm import simhash
from tickloom.llm.queries import load, op5_simhash


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows):
    """(id, fingerprint, smallest reachable id) by comparing all with all."""
    marks = [plain_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    values = np.array(marks, np.uint64)
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 4):
            a, b = group[i], group[j]
            group = [min(a, b) if g in (a, b) else g for g in group]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        out.append((doc_id, f"{marks[i]:016x}", min(ids, default=None)))
    return sorted(out, key=str)


def test_edge_rows(spark):
    got = by_id(simhash.near_duplicates(edge(spark)), "doc_id", "fingerprint", "component_id")
    assert got == plain_groups([r[:2] for r in EDGE])


def test_query_equals_all_pairs(spark, sf_dir):
    got = by_id(op5_simhash(spark, sf_dir), "doc_id", "fingerprint", "component_id")
    rows = [(r["doc_id"], r["text"]) for r in load(spark, sf_dir, "documents").collect()]
    assert got == plain_groups(rows)


def clusters(seed, centres, copies, flips):
    rng = np.random.default_rng(seed)
    out = set()
    for c in rng.integers(0, 1 << 63, centres, dtype=np.int64).tolist():
        for _ in range(copies):
            out.add(c ^ sum(1 << int(b) for b in set(rng.integers(0, 64, rng.integers(0, flips + 1)).tolist())))
    return np.array(sorted(out), np.uint64)


def roots(values):
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    label = np.arange(len(values))
    while True:
        new = np.where(near, label, len(values)).min(axis=1)
        if (new == label).all():
            return label
        label = new


@pytest.mark.parametrize("shape", [(30, 40, 7), (1, 900, 5), (1, 1, 0), (500, 1, 0)])
def test_index_equals_all_pairs(shape):
    index = simhash.GrayIndex(clusters(3, *shape))
    assert (index.groups(4) == roots(index.values)).all()


@pytest.mark.parametrize("group_rows", [45, 100_000])
def test_groups_dealt_again_lose_no_link(spark, group_rows):
    values = clusters(5, 4, 60, 5)
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    links = simhash.near_links(df, 4, group_rows).collect()
    place = {int(v): i for i, v in enumerate(values.view(np.int64))}
    label = np.arange(len(values))
    pairs = np.array([(place[a], place[b]) for a, b in links])
    label = simhash._unite(label, pairs[:, 0], pairs[:, 1])
    assert (label == roots(values)).all()


def kept_of(rows):
    """Places in the input of the rows that stay."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    found = plain_groups([(rank, rows[i][1]) for rank, i in enumerate(order)])
    return sorted(order[rank] for rank, _, c in found if rank == c)


def test_one_of_each_group_stays(spark):
    kept = simhash.keep_first(edge(spark))
    assert kept.columns == ["doc_id", "text", "ids", "score"]
    want = [EDGE[i] for i in kept_of(EDGE)]
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(want, key=str)


def test_only_the_copy_goes_where_an_id_occurs_twice(spark):
    x, y = "one two three four five six seven", "completely other words stand here for once"
    rows = [(1, x, 0), (5, x, 1), (5, y, 2), (5, y, 3), (None, x, 4), (None, "last words of nobody in here", 5)]
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string, row int").coalesce(1))
    assert kept.columns == ["doc_id", "text", "row"]
    assert sorted(r["row"] for r in kept.collect()) == [0, 2, 5]
    assert kept_of(rows) == [0, 2, 5]


def test_empty_table(spark):
    assert simhash.near_duplicates(empty(spark)).collect() == []
