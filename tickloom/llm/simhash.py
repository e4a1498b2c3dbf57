"""Near-duplicate groups by SimHash fingerprints and a Gray-order hierarchical index.

Fingerprints within ``bits`` differences agree on at least one of ``bits + 1`` blocks of bits. Rows
are dealt by block and value, so that links meet in a task without any pairing of all rows; a group
that is still too large is dealt again by blocks of the bits left free, which stays exact. Within a
group the fingerprints are sorted by Gray rank, neighbours form nodes, and a node keeps the bits on
which all below agree and its parent does not. A search adds up the differences on those bits from
the top and drops a whole node once they exceed the bound, or once it is linked already.

Null and wordless texts have fingerprint zero and link like any other. Rows with one id each keep
their row. Other columns are left out.
"""

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.components import connected_components
from tickloom.llm.text import LOWER, fresh, give_back, map_texts, texts, two_columns
from tickloom.sources.stage import materialize

BITS = 4
SHINGLE = 4
# Distinct fingerprints of one group that a task takes on; larger groups are dealt again.
GROUP_ROWS = 32_768
FAN = 16
_SEARCH_CELLS = 1 << 21
_ALL = (1 << 64) - 1


def fingerprint(text: bytes, words: int = SHINGLE) -> int:
    """SimHash of one text's lower-cased word shingles, by majority over all occurrences."""
    found = text.translate(LOWER).split()
    if not found:
        return 0
    joined = b" ".join(found)
    starts = np.zeros(len(found) + 1, np.int64)
    np.cumsum([len(w) + 1 for w in found], out=starts[1:])
    n = max(1, len(found) - words + 1)
    begin, end = starts[:n].tolist(), (starts[min(words, len(found)) :][:n] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        hashes = [digest(joined[i:j], 42) for i, j in zip(begin[at : at + (1 << 16)], end[at : at + (1 << 16)])]
        rows = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batch: pa.RecordBatch, words: int) -> pa.RecordBatch:
    found = np.array([fingerprint(t, words) for t in texts(batch, "text")], np.uint64)
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE) -> DataFrame:
    """``doc_id`` and 64-bit ``fp`` (as a signed long) of every whole text."""
    rows = two_columns(df, id_col, text_col)
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long"
    return map_texts(rows, "text", schema, lambda: partial(_fingerprints, words=words))


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Place of each value in the order of the reflected Gray code."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _unite(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Give both ends of each pair, and all with their labels, the smaller label."""
    while True:
        x, y = labels[a], labels[b]
        if (x == y).all():
            return labels
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while (labels[labels] != labels).any():
            labels = labels[labels]


class GrayIndex:
    """A tree over fingerprints in Gray order; nodes hold the bits shared by all below them."""

    def __init__(self, values: np.ndarray):
        self.values = values[np.argsort(gray_rank(values), kind="stable")]
        ones, any_one = [self.values], [self.values]
        while len(ones[-1]) > 1:
            cuts = np.arange(0, len(ones[-1]), FAN)
            ones.append(np.bitwise_and.reduceat(ones[-1], cuts))
            any_one.append(np.bitwise_or.reduceat(any_one[-1], cuts))
        self.shared = ones
        agree = [~(x ^ y) for x, y in zip(ones, any_one)]
        above = [agree[i + 1][np.arange(len(agree[i])) // FAN] for i in range(len(agree) - 1)]
        self.own = [mine & ~parent for mine, parent in zip(agree, above)] + [agree[-1]]

    def search(self, queries: np.ndarray, bits: int, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of queries and of values within ``bits`` of each other and not yet in one group."""
        low, high = [labels], [labels]
        for level in range(1, len(self.shared)):
            cuts = np.arange(0, len(low[-1]), FAN)
            low.append(np.minimum.reduceat(low[-1], cuts))
            high.append(np.maximum.reduceat(high[-1], cuts))
        q, node, apart = queries, np.zeros(len(queries), np.int64), np.zeros(len(queries), np.uint8)
        for level in range(len(self.shared) - 1, -1, -1):
            if level < len(self.shared) - 1:
                node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                q, apart = np.repeat(q, FAN), np.repeat(apart, FAN)
                there = node < len(self.shared[level])
                q, node, apart = q[there], node[there], apart[there]
            differ = (self.values[q] ^ self.shared[level][node]) & self.own[level][node]
            apart = apart + np.bitwise_count(differ)
            mine = labels[q]
            keep = (apart <= bits) & ~((low[level][node] == mine) & (high[level][node] == mine))
            q, node, apart = q[keep], node[keep], apart[keep]
        return q, node

    def groups(self, bits: int) -> np.ndarray:
        """A label per value: the smallest place among all that it is linked with."""
        n = len(self.values)
        labels, step = np.arange(n), max(1, _SEARCH_CELLS // n)
        for at in range(0, n, step):
            q, node = self.search(np.arange(at, min(at + step, n)), bits, labels)
            labels = _unite(labels, q, node)
        return labels


def _links(batches, bits: int):
    """Links to one member of each linked set, for groups that arrive one after the other."""
    rest = None

    def of(group: pa.Table):
        values = np.unique(group.column("fp").to_numpy().view(np.uint64))
        if len(values) > 1:
            index = GrayIndex(values)
            labels = index.groups(bits)
            moved = labels != np.arange(len(labels))
            if moved.any():
                yield index.values[moved], index.values[labels[moved]]

    def pack(pairs):
        a = np.concatenate([p[0] for p in pairs]).view(np.int64)
        b = np.concatenate([p[1] for p in pairs]).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        mask, key = table.column("mask").to_numpy(), table.column("key").to_numpy()
        cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
        cuts = [0, *cuts.tolist()]
        pairs = [p for i, j in zip(cuts, cuts[1:]) if j - i > 1 for p in of(table.slice(i, j - i))]
        rest = table.slice(cuts[-1])
        if pairs:
            yield pack(pairs)
    if rest is not None and (pairs := list(of(rest))):
        yield pack(pairs)


def _blocks(fixed: int, count: int) -> list[int]:
    """Masks that add to the fixed bits one of ``count`` blocks of the others, as signed longs."""
    free = [i for i in range(64) if not fixed >> i & 1]
    masks = {fixed | sum(1 << i for i in part.tolist()) for part in np.array_split(free, count)}
    return sorted(m - (1 << 64) if m >> 63 else m for m in masks)


def near_links(classes: DataFrame, bits: int = BITS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links (``a``, ``b``) that connect all distinct ``fp`` within ``bits`` of each other."""

    def dealt(rows: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
        table = F.create_map(*[x for m, c in masks.items() for x in (F.lit(m), F.array(*map(F.lit, c)))])
        rows = rows.select(F.explode(F.element_at(table, F.col("mask"))).alias("mask"), "fp")
        return rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))

    masks = {0: _blocks(0, bits + 1)}
    rows = dealt(classes.select("fp", F.lit(0).cast("long").alias("mask")), masks)
    parts = []
    while True:
        sizes = rows.groupBy("mask", "key").count()
        large = materialize(sizes.where(F.col("count") > group_rows), "large-groups")
        found = [r["mask"] for r in large.select("mask").distinct().collect()]
        if not found:
            parts.append(rows)
            break
        parts.append(rows.join(large, ["mask", "key"], "left_anti"))
        masks = {m: _blocks(m & _ALL, bits + 1) for m in found}
        rows = materialize(dealt(rows.join(large, ["mask", "key"], "left_semi"), masks), "dealt-again")
    for part in parts[1:]:
        parts[0] = parts[0].unionByName(part)
    grouped = parts[0].repartition("mask", "key").sortWithinPartitions("mask", "key")
    return grouped.mapInArrow(give_back(partial(_links, bits=bits)), "a long, b long")


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits: int = BITS,
    words: int = SHINGLE,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id`` (the smallest id reachable) per row."""
    marked = materialize(fingerprints(df, id_col, text_col, words), "fingerprints")
    classes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    links = near_links(classes, bits, group_rows)
    member = materialize(connected_components(links).withColumnRenamed("node", "fp"), "members")
    first = member.join(classes, "fp").groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = member.join(first, "root").select("fp", "component_id")
    named = classes.join(linked, "fp", "left")
    named = named.select("fp", F.coalesce("component_id", "first_id").alias("component_id"))
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each near-duplicate group, that with the smallest id; all columns as they were.

    Decided row by row: of rows with one id, only those go whose own text has a near copy in a row
    ahead of them. Among equal ids the first in the input stays; rows without an id come last.
    """
    row = fresh(docs, "row")
    # Written, so that numbers are the same however often a task is run.
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    place = F.struct(F.col(id_col).isNull().alias("last"), F.col(id_col).alias("id"), F.col(row).alias("row"))
    found = near_duplicates(numbered.select(place.alias("doc_id"), F.col(text_col).alias("text")), **options)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id.row").alias(row))
    return numbered.join(gone, row, "left_anti").select(*docs.columns)
