import hashlib
import os
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from rows import EDGE, PASSAGE, by_id, edge, empty

from tickloom.llm import suffix
from tickloom.llm.queries import load, op7_suffix

COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def plain(rows, length=50):
    """Every string of the length against the smallest id that has it."""
    rows = [(i, (t or "").encode()) for i, t in rows]
    order = lambda i: (i is None, i or 0)
    first = {}
    for i, data in rows:
        for k in range(len(data) - length + 1):
            s = data[k : k + length]
            first[s] = min(first.get(s, order(i)), order(i))
    out = []
    for i, data in rows:
        gone = np.zeros(len(data) + 1, bool)
        for k in range(len(data) - length + 1):
            if first[data[k : k + length]] < order(i):
                gone[k : k + length] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((np.diff(gone[:-1].astype(int), prepend=0) == 1).sum())
        out.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def made_up(seed, n, shared):
    """Texts that share whole passages, parts of them, and long runs of one letter or period."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    text = lambda k: " ".join(word() for _ in range(k))
    passages = [text(25) for _ in range(shared)] + ["z" * 400, "xy" * 150]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            parts += [text(rng.randint(0, 9)), p[a : a + rng.randint(20, 400)]]
        rows.append((i, " ".join(parts)))
    return rows + [(rng.randint(0, n), rng.choice(rows)[1]) for _ in range(n // 4)]


def test_edge_rows(spark):
    assert by_id(suffix.repeat_digests(edge(spark)), *COLUMNS) == plain([r[:2] for r in EDGE])


@pytest.mark.parametrize("group_fragments", [suffix.GROUP_FRAGMENTS, 3])
def test_made_up_texts(spark, group_fragments):
    rows = made_up(group_fragments, 60, 4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_id(suffix.repeat_digests(df, group_fragments=group_fragments), *COLUMNS) == plain(rows)


def test_query_equals_all_strings(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in load(spark, sf_dir, "documents").collect()]
    assert by_id(op7_suffix(spark, sf_dir), *COLUMNS) == plain(rows)


def test_cut_texts_keep_other_columns(spark):
    got = suffix.without_repeats(edge(spark))
    assert got.columns == ["doc_id", "text", "ids", "score"]
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert texts[1] == PASSAGE and texts[4] == "" and texts[2] is None and PASSAGE not in texts[7]


@pytest.mark.parametrize("letters", ["ab", "a", "abcdef"])
def test_transform_and_common_prefixes(letters, tmp_path):
    rng = random.Random(1)
    strings = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 90))).encode() for _ in range(25)]
    string, start, common = suffix.Collection(strings, str(tmp_path), 50).suffixes()
    rows = [(strings[s][a:], int(s)) for s, a in zip(string, start)]
    assert rows == sorted(rows)
    for (x, _), (y, _), shared in zip(rows, rows[1:], common[1:]):
        n = next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
        assert shared == min(n, 50)


def test_equal_strings_have_equal_anchors():
    text = ("lorem ipsum dolor sit amet " * 9).encode()
    anchors, starts = suffix.runs(text)
    of = np.repeat(anchors, np.diff(np.append(starts, len(text) - 49)))
    by_string = {}
    for k in range(len(text) - 49):
        assert by_string.setdefault(text[k : k + 50], of[k]) == of[k]


def test_empty_table(spark):
    assert suffix.repeat_digests(empty(spark)).collect() == []


def cut_rows(texts):
    """Fragments of the texts, a slice each, in the order that a task gets them."""
    rows = []
    for i, text in enumerate(texts):
        wanted = np.unique(suffix.runs(text)[0])
        for k, (a, begin, end, place) in enumerate(zip(*(c.tolist() for c in suffix.fragments(text, wanted)))):
            rows.append((a, text[begin:end], place, i, k, i, i))
    names = ["anchor", "data", "place", "slice", "idx", "least", "most"]
    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    columns = [pa.array(c, k) for c, k in zip(zip(*sorted(rows)), kinds)]
    return pa.RecordBatch.from_arrays(columns, names)


def test_long_fragments_take_no_rounds_of_others(monkeypatch):
    rng = random.Random(8)
    passage = bytes(rng.choice(b"abcdefgh ") for _ in range(600))
    texts = [b"<" + passage + bytes([i]) + passage[:300] + b"z" * (150 + i) for i in range(1, 7)]
    rows = cut_rows(texts)
    wholes, widths = [], []
    first_ids = suffix.first_ids

    def seen(strings, ids, length):
        widths.append({len(s) > 2 * length - suffix.ANCHOR for s in strings})
        return first_ids(strings, ids, length)

    monkeypatch.setattr(suffix, "first_ids", seen)
    for size in (rows.num_rows, 7, 1):
        batches = (rows.slice(at, size) for at in range(0, rows.num_rows, size))
        found = [r for b in suffix._sorted_collections(batches, 50, suffix.ANCHOR) for r in b.to_pylist()]
        wholes.append(sorted((r["slice"], r["idx"], r["at"] + k, r["first"]) for r in found for k in range(r["n"])))
    assert wholes[0] == wholes[1] == wholes[2]
    assert widths and all(len(w) == 1 for w in widths) and {True, False} == set().union(*widths)
    # Every string of a fragment that a text before has as well, with the first such text.
    data = {(r["slice"], r["idx"]): r["data"] for r in rows.to_pylist()}
    string = lambda s, i, at: data[s, i][at : at + 50]
    expected = []
    for (s, i), d in data.items():
        for at in range(len(d) - 49):
            first = next(k for k, t in enumerate(texts) if string(s, i, at) in t)
            if first < s:
                expected.append((s, i, at, first))
    assert wholes[0] == sorted(expected)


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in manager.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}


def test_shuffles_of_written_tables_take_no_disk(spark):
    before = shuffle_files(spark)
    df = spark.createDataFrame(made_up(1, 60, 4), "doc_id long, text string")
    found, _ = suffix.remove_repeats(df)
    until = time.time() + 5
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    assert not left and found.count() == df.count()


def test_words_that_texts_share_by_chance_are_not_written(spark, monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(6, 8))) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(90))) for i in range(400)]
    written, materialize = {}, suffix.materialize

    def spy(df, name, *args, **options):
        table = materialize(df, name, *args, **options)
        written[name] = sum(os.path.getsize(f.removeprefix("file://")) for f in table.inputFiles())
        return table

    monkeypatch.setattr(suffix, "materialize", spy)
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    assert by_id(suffix.repeat_digests(df), *COLUMNS) == plain(rows)
    assert written["fragments"] < 0.1 * sum(len(t) for _, t in rows)


def test_fragments_are_dealt_in_few_bytes():
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(3000)) for _ in range(9)]
    rows = [(i, rng.choice(texts)[a : a + 900] + f" {i}") for i, a in enumerate(rng.randint(0, 2000) for _ in range(40))]
    batch = pa.RecordBatch.from_pydict({"text": [t for _, t in rows], "key": [i for i, _ in rows]})
    options = {"buckets": 3, "length": 50, "anchor": suffix.ANCHOR, "text_col": "text"}
    packed = pa.Table.from_batches(suffix._packed_slices([batch], "text", "key"))
    requests = pa.Table.from_batches(suffix._requests(packed.to_batches(), **options)).sort_by("bucket")
    replies = list(suffix._replies(requests.to_batches()))
    assert not any(any(r["bits"]) for b in replies for r in b.to_pylist())  # no other slice is there
    struct = [{k: r[k] for k in ("bucket", "bits")} for b in replies for r in b.to_pylist()]
    columns = [packed["slice"].to_pylist(), packed["packed"].to_pylist(), [struct], [[]]]
    one = pa.RecordBatch.from_pydict(dict(zip(("slice", "packed", "replies", "copies"), columns)))
    cut = list(suffix._cut_slices([one], **options, key="key"))
    classes = suffix._class_rows(*(cut[0].column(c)[0].as_py() for c in ("slice", "classes")), suffix.ANCHOR)
    dealt = list(suffix._dealt(cut, 3, np.zeros(0, np.int64), suffix.ANCHOR))
    assert sum(len(r["rows"]) for b in dealt for r in b.to_pylist()) < 0.7 * classes.nbytes
    found = list(suffix._bucket_runs(iter(dealt), 50, suffix.ANCHOR))
    places = cut[0].column("places")[0].as_py()
    ends = np.cumsum([len(t) for _, t in rows])
    gone = suffix._gone(ends, np.arange(len(rows)), [], places, [r["found"] for b in found for r in b.to_pylist()], 50)
    assert np.add.reduceat(gone.astype(int), np.append(0, ends[:-1])).tolist() == [r[2] for r in sorted(plain(rows), key=lambda r: r[0])]


def test_anchors_of_fragments_follow_from_their_bytes():
    rng = random.Random(9)
    text = bytes(rng.choice(b"abcdefgh ") for _ in range(2000)) + b"z" * 300 + b"xyz" * 70
    anchors, begin, end, place = suffix.fragments(text, np.unique(suffix.runs(text)[0]))
    assert {True, False} == set((place < 0).tolist())
    data = np.frombuffer(b"".join(text[a:b] for a, b in zip(begin, end)), np.uint8)
    assert suffix._anchors_of(end - begin, place, data, suffix.ANCHOR).tolist() == anchors.tolist()


def test_codes_are_held_against_other_slices():
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(200))
    options = {"buckets": 5, "length": 50, "anchor": suffix.ANCHOR, "text_col": "text"}
    requests, of = [], {}
    for texts in (["a" * 60 + passage, passage], ["b" * 60 + passage], ["c" * 90]):
        batch = pa.RecordBatch.from_pydict({"text": texts, "key": list(range(len(texts)))})
        (packed,) = suffix._packed_slices([batch], "text", "key")
        requests += suffix._requests([packed], **options)
        of[packed.column("slice")[0].as_py()] = set(np.concatenate([suffix.runs(t.encode())[0] for t in texts]).tolist())
    table = pa.Table.from_batches(requests).sort_by("bucket")
    shared = dict.fromkeys(of, 0)
    for batch in suffix._replies(table.to_batches()):
        for r in batch.to_pylist():
            shared[r["slice"]] += int(np.unpackbits(np.frombuffer(r["bits"], np.uint8)).sum())
    assert shared == {k: len(v & set().union(*(o for j, o in of.items() if j != k))) for k, v in of.items()}
    assert sorted(shared.values())[0] == 0 and sorted(shared.values())[1] > 0
