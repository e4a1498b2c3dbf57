"""Benchmark passages in documents, found with suffix arrays of the training text.

Each slice of documents is a shard: its words become numbers (0 for a word that no item has, which
no match can cross), and the suffixes that start within long enough runs of known words are sorted
by prefix doubling. Every suffix of every item is looked up in each shard by binary search. A range
of suffixes that start with the item's window gives all its places; each is extended to the longest
verbatim match.

Items come in blocks of bounded size, one broadcast and one pass over the rows per block; the rows
are never shuffled. A null text has no words. An item without words has no windows; one with fewer
words than a window is a window of its own. Items with one id count once. Repeated document rows
each keep their row. Without items nothing is hit.
"""

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.text import fresh, map_texts, texts, two_columns

WINDOW = 10
BLOCK_BYTES = 32 << 20
# Item suffixes that are looked up at once.
_LOOKUPS = 1 << 16
# Fixed value: letters, digits and all bytes of other scripts are words, A-Z in lower case.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_MATCH = pa.struct([("item_id", pa.string()), ("word", pa.int32()), ("length", pa.int32())])
_MATCH_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.StringType()),
            T.StructField("word", T.IntegerType()),
            T.StructField("length", T.IntegerType()),
        ]
    )
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


class Items:
    """The suffixes of a block of test items that start a window, as places in one row of numbers.

    Items of equal words are one with several names. A suffix is where it starts (``start``) and
    how many words it has (``size``), so memory grows with the words and not with the suffixes'
    lengths; a 0 parts items.
    """

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[bytes, set[str]] = {}
        for item_id, text in items:
            number = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text.encode())]
            if number:
                found.setdefault(np.array(number, np.int64).tobytes(), set()).add(item_id)
        self.names = [sorted(ids) for ids in found.values()]
        rows = [np.frombuffer(raw, np.int64) for raw in found]
        sizes = np.array([len(r) for r in rows], np.int64)
        ahead = np.zeros(1, np.int64)  # ahead of the first item, too
        self.flat = np.concatenate([ahead, *[x for r in rows for x in (r, ahead)], np.zeros(window, np.int64)])
        begin = 1 + np.concatenate([ahead, np.cumsum(sizes + 1)])[:-1]
        windows = np.maximum(1, sizes - window + 1)
        self.owner = np.repeat(np.arange(len(rows)), windows)
        within = np.arange(len(self.owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        self.start = begin[self.owner] + within
        self.size = sizes[self.owner] - within
        self.need = np.minimum(self.size, window)
        self.shortest = int(self.need.min()) if len(rows) else 0


def suffix_array(numbers: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` in the order of the ``depth`` or more numbers from there on; 0 ends a suffix."""
    rank = np.zeros(len(numbers) + 1, np.int64)
    rank[places] = numbers[places]
    step = 1
    while step < depth:
        after = rank[np.minimum(places + step, len(numbers))]
        key = rank[places] * (int(rank.max()) + 1) + after
        rank[places] = np.unique(key, return_inverse=True)[1] + 1
        step *= 2
    return places[np.argsort(rank[places], kind="stable")]


def _bounds(
    numbers: np.ndarray, order: np.ndarray, items: Items, some: slice, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """For some of the item suffixes the range of ``order`` whose suffixes start with its window."""
    column, need = np.arange(width), items.need[some, None]
    asked = column < need
    want = np.where(asked, items.flat[items.start[some, None] + np.minimum(column, need - 1)], 0)

    def search(past_equal: bool) -> np.ndarray:
        low, high = np.zeros(len(want), np.int64), np.full(len(want), len(order), np.int64)
        while (open_ := low < high).any():
            middle = (low + high) // 2
            there = numbers[order[np.minimum(middle, len(order) - 1)][:, None] + column]
            differ = np.where(asked, there - want, 0)
            first = differ[np.arange(len(want)), (differ != 0).argmax(axis=1)]
            right = open_ & ((first <= 0) if past_equal else (first < 0))
            low = np.where(right, middle + 1, low)
            high = np.where(open_ & ~right, middle, high)
        return low

    return search(False), search(True)


def _extended(numbers: np.ndarray, where: np.ndarray, items: Items, s: int) -> np.ndarray:
    """Words from each place on that an item's suffix has as well, its window or more."""
    size = np.full(len(where), int(items.need[s]))
    start, most, growing = int(items.start[s]), int(items.size[s]), np.arange(len(where))
    while len(growing):
        growing = growing[size[growing] < most]
        there = numbers[np.minimum(where[growing] + size[growing], len(numbers) - 1)]
        growing = growing[there == items.flat[start + size[growing]]]
        size[growing] += 1
    return size


def shard_matches(docs: list[list[bytes]], items: Items, window: int):
    """Hit words per document, and per document and item the longest match (place, length)."""
    sizes = np.array([len(d) + 1 for d in docs], np.int64)  # a 0 parts documents
    ends = np.cumsum(sizes)
    get = items.vocabulary.get
    numbers = np.zeros(int(ends[-1]) + window if docs else window, np.int64)
    at = 0
    for doc in docs:
        numbers[at : at + len(doc)] = np.fromiter(map(get, doc, repeat(0)), np.int64, len(doc))
        at += len(doc) + 1
    hits, longest = np.zeros(len(numbers) + 1, np.int64), [{} for _ in docs]
    known = np.flatnonzero(np.diff(np.concatenate([[False], numbers != 0, [False]]).astype(np.int8)))
    begin, length = known[::2], known[1::2] - known[::2]
    begin, length = begin[length >= max(1, items.shortest)], length[length >= max(1, items.shortest)]
    if len(begin) and len(items.size):
        places = np.repeat(begin - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
        order = suffix_array(numbers, places, window)
        for first in range(0, len(items.size), _LOOKUPS):
            low, high = _bounds(numbers, order, items, slice(first, first + _LOOKUPS), window)
            for k in np.flatnonzero(high > low).tolist():
                s, where = first + k, order[low[k] : high[k]]
                np.add.at(hits, where, 1)
                np.add.at(hits, where + int(items.need[s]), -1)
                # A match that goes on from the word before is part of a longer one.
                ahead = items.flat[items.start[s] - 1]
                where = where[(numbers[where - 1] != ahead) | (ahead == 0)]
                owner = np.searchsorted(ends, where, "right")
                size = _extended(numbers, where, items, s)
                for d, place, n in zip(owner.tolist(), (where - (ends - sizes)[owner]).tolist(), size.tolist()):
                    for name in items.names[items.owner[s]]:
                        longest[d][name] = max(longest[d].get(name, (0, 0)), (n, -place))
    covered = np.cumsum(hits)[: int(ends[-1]) if docs else 0] > 0
    return covered, ends - sizes, longest


def _item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """Lists of (id, text) whose total size is bounded, collected one after the other."""
    rows = items.where(F.col(text_col).isNotNull()).select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item_id"), F.col(text_col).alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    count = -(-size // block_bytes) or 1
    for k in range(count):
        block = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        yield [(r["item_id"], r["text"]) for r in block.collect()]


def scan(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the number of words, the hit words' runs and the longest match per item.

    The second value names these three columns, whose names avoid those of ``docs``.
    """
    name = {c: fresh(docs, c) for c in ("n_words", "hit_runs", "matches")}
    context = docs.sparkSession.sparkContext
    out = docs.withColumns(
        {
            name["n_words"]: F.lit(0).cast("long"),
            name["hit_runs"]: F.array().cast("array<int>"),
            name["matches"]: F.array().cast(_MATCH_TYPE),
        }
    )
    for block in _item_blocks(items, item_id_col, item_text_col, block_bytes):
        broadcast = context.broadcast(block)

        def start(shared=broadcast):
            index = Items(shared.value, window)

            def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
                found = [words(t) for t in texts(batch, text_col)]
                covered, begins, longest = shard_matches(found, index, window)
                runs, matches = [], []
                earlier_runs = batch.column(name["hit_runs"]).to_pylist()
                earlier = batch.column(name["matches"]).to_pylist()
                for i, doc in enumerate(found):
                    mask = np.zeros(len(doc) + 2, np.int8)
                    mask[1:-1] = covered[begins[i] : begins[i] + len(doc)]
                    for a, b in zip(earlier_runs[i][::2], earlier_runs[i][1::2]):
                        mask[1 + a : 1 + b] = 1
                    runs.append(np.flatnonzero(np.diff(mask)).tolist())
                    new = [{"item_id": k, "word": -p, "length": n} for k, (n, p) in sorted(longest[i].items())]
                    matches.append([*earlier[i], *new])
                values = {
                    name["n_words"]: pa.array([len(d) for d in found], pa.int64()),
                    name["hit_runs"]: pa.array(runs, pa.list_(pa.int32())),
                    name["matches"]: pa.array(matches, pa.list_(_MATCH)),
                }
                columns = [values.get(c, batch.column(i)) for i, c in enumerate(batch.schema.names)]
                return pa.RecordBatch.from_arrays(columns, batch.schema.names)

            return apply

        out = map_texts(out, text_col, out.schema, start)
    return out, name


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document row its words, hit words, items with a match, and whether it is contaminated."""
    found, name = scan(two_columns(docs, id_col, text_col), items, **options)
    runs = F.col(name["hit_runs"])
    lengths = F.transform(runs, lambda end, i: F.when(i % 2 == 1, end).otherwise(-end))
    names = F.array_sort(F.array_distinct(F.transform(name["matches"], lambda m: m["item_id"])))
    return found.select(
        "doc_id",
        F.col(name["n_words"]).alias("n_words"),
        F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size(runs) > 0).alias("contaminated"),
        F.col(name["matches"]).alias("matches"),
    )


def remove_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without a hit word; nothing is shuffled."""
    found, name = scan(docs, items, **options)
    return found.where(F.size(name["hit_runs"]) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
