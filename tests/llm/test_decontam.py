import hashlib
import random
import re
import tracemalloc

import numpy as np
import pytest
from rows import EDGE, PASSAGE, by_id, edge, empty

from tickloom.llm import decontam
from tickloom.llm.queries import load, op8_decontamination

ITEMS = [
    (1, PASSAGE.upper()),
    (2, None),
    (3, ""),
    (4, "漢字 the"),
    (4, "漢字 the"),
    (10, "nine old owls watch from a quiet oak tree and then some more words"),
    (5, "never seen"),
]
COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def plain_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(docs, items, window=10):
    wanted = {}
    for item_id, text in items:
        w = plain_words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wanted.setdefault(tuple(w[i : i + window]), set()).add(item_id)
    sizes = {len(w) for w in wanted}
    out = []
    for doc_id, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in wanted:
                    hit.update(range(i, i + n))
                    found |= wanted[tuple(w[i : i + n])]
        names = ",".join(sorted(map(str, found)))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def items(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("block_bytes", [decontam.BLOCK_BYTES, 100])
def test_edge_rows(spark, block_bytes):
    got = decontam.contamination(edge(spark), items(spark), block_bytes=block_bytes)
    assert by_id(got, *COLUMNS) == plain([r[:2] for r in EDGE], ITEMS)


def test_query_equals_plain_search(spark, sf_dir):
    got = by_id(op8_decontamination(spark, sf_dir), *COLUMNS)
    docs = [(r["doc_id"], r["text"]) for r in load(spark, sf_dir, "documents").collect()]
    bench = [(r["item_id"], r["text"]) for r in load(spark, sf_dir, "benchmark").collect()]
    assert got == plain(docs, bench)


def test_longest_match_and_its_place(spark):
    docs = spark.createDataFrame([(1, "well " + PASSAGE + " and then")], "doc_id long, text string")
    found = decontam.contamination(docs, items(spark)).first()["matches"]
    size = len(PASSAGE.split())
    assert {(m["item_id"], m["word"], m["length"]) for m in found} == {("1", 1, size), ("10", 1 + size - 9, 11)}


def test_clean_rows_stay_whole(spark):
    kept = decontam.remove_contaminated(edge(spark), items(spark))
    assert kept.columns == ["doc_id", "text", "ids", "score"]
    dirty = {r[0] for r in plain([r[:2] for r in EDGE], ITEMS) if r[-1]}
    assert by_id(kept, "doc_id", "text") == sorted([r[:2] for r in EDGE if r[0] not in dirty], key=str)


def test_empty_tables(spark):
    assert decontam.contamination(empty(spark), items(spark)).collect() == []
    assert {r["n_hit"] for r in decontam.contamination(edge(spark), items(spark, [])).collect()} == {0}


def test_an_item_of_any_length_takes_memory_by_its_words():
    """Distinct words, a copy of the whole in a document, and a part of it in another."""
    text = " ".join(f"w{i}" for i in range(200_000))
    tracemalloc.start()
    index = decontam.Items([("long", text), ("same", text)], 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 * 200_000
    docs = [decontam.words(t.encode()) for t in (text, "x " + " ".join(f"w{i}" for i in range(500, 540)) + " y", "w3 w4")]
    covered, begins, longest = decontam.shard_matches(docs, index, 10)
    assert [int(covered[b : b + len(d)].sum()) for b, d in zip(begins, docs)] == [200_000, 40, 0]
    assert longest == [dict.fromkeys(("long", "same"), (200_000, 0)), dict.fromkeys(("long", "same"), (40, -1)), {}]


@pytest.mark.parametrize("seed", range(4))
def test_shards_equal_a_plain_search(seed, monkeypatch):
    """Few different words, so that matches overlap, repeat and go on from one another."""
    monkeypatch.setattr(decontam, "_LOOKUPS", 7)
    rng = random.Random(seed)
    row = lambda n: [f"w{rng.randrange(3)}" for _ in range(n)]
    tests = [(str(i), " ".join(row(rng.randrange(1, 40)))) for i in range(12)]
    docs = [row(rng.randrange(0, 60)) for _ in range(20)]
    raw = [[w.encode() for w in d] for d in docs]
    covered, begins, longest = decontam.shard_matches(raw, decontam.Items(tests, 5), 5)
    for d, begin, found in zip(docs, begins, longest):
        want, hit = {}, set()
        for name, text in tests:
            w = text.split()
            for p in range(max(1, len(w) - 5 + 1)):
                for q in range(len(d)):
                    n = 0
                    while p + n < len(w) and q + n < len(d) and w[p + n] == d[q + n]:
                        n += 1
                    if n >= min(5, len(w)):
                        want[name] = max(want.get(name, (0, 0)), (n, -q))
                        hit |= set(range(q, q + min(5, len(w))))
        assert found == want
        assert np.flatnonzero(covered[begin : begin + len(d)]).tolist() == sorted(hit)
