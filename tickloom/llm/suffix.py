"""Removal of passages that repeat across documents, by column-wise suffix sorting of collections.

A byte goes if it lies in a ``LENGTH``-byte string that also starts in a document with a smaller id.
Equal strings of that length have the same smallest hash of their ``ANCHOR``-byte parts, their
anchor. So documents are cut into fragments, runs of strings with one anchor; fragments whose anchor
occurs in one document alone are dropped, and the others meet by anchor. Equal fragments are one,
with the smallest id; one that shares its anchor's surroundings with none needs no sorting.

Rows are packed into numbered slices, which are written once. What slices tell each other travels
in packed columns: the codes of a slice's anchors by bucket, a bit for each that another slice has
too, the fragments of several slices by bucket, and the spans found of each. Shuffles that a written
table has made useless are let go at once, so that they take no disk beside the next ones.

A task sorts the suffixes of its fragments column by column: each round inserts one symbol of every
fragment, from the last to the first, into the collection's Burrows-Wheeler transform and updates
the common prefixes of neighbours, reading the former files front to back and writing the next.
Neighbours that share ``LENGTH`` bytes or more are equal strings, whose smallest id then decides.
The anchors with the most fragments are left to a grouping by whole strings, which is exact as well.

Ids are integers; a null id counts as larger than all others. Documents with one id take nothing
from each other. Null and empty texts have no bytes. Of whole copies all but those with the smallest
id go entirely. Other columns stay as they are.
"""

import hashlib
import os
import tempfile
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.llm.text import fresh, give_back, map_texts, slices, texts
from tickloom.sources.stage import materialize, shuffles_let_go

LENGTH = 50
# Long enough that texts hardly share one by chance, however many they are; it changes no result.
ANCHOR = 32
FRAGMENT_STRINGS = 64
# Fragments of one anchor, and bytes of one collection, that a task sorts.
GROUP_FRAGMENTS = 20_000
COLLECTION_BYTES = 500_000
# Bytes of text for each bucket that a task holds, and of fragments that are dealt to buckets at once.
BUCKET_BYTES = 16 << 20
DEALT_BYTES = 16 << 20
_LAST = (1 << 63) - 1
_END = 0xFF  # in no UTF-8 text
_MASK = np.uint64((1 << 48) - 1)
_FACTOR = 0xBF58476D1CE4E5B9
_BLOCK = 128
_WIDE = 1 << 15  # places that are hashed at once, so that all of it stays in a cache


def _part_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """48-bit hashes of all ``size``-byte parts; ``size`` is a power of two."""
    h = _spread(data)
    step, factor = 1, _FACTOR
    while step < size:
        h = h[:-step] * np.uint64(factor) + h[step:]
        factor = (factor * factor + 2) % (1 << 64)
        step *= 2
    return _finished(h)


def _spread(data: np.ndarray) -> np.ndarray:
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ h >> np.uint64(32)


def _finished(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(29)
    return h & _MASK


def _anchors_of(sizes: np.ndarray, places: np.ndarray, data: np.ndarray, anchor: int) -> np.ndarray:
    """Anchors of fragments that stand in one buffer: the hash of the part at its place, else the least one."""
    sizes = sizes.astype(np.int64)
    begin, out = np.cumsum(sizes) - sizes, np.empty(len(sizes), np.uint64)
    at = (begin + places)[places >= 0]
    # A part's hash is a sum of its spread bytes, each times a factor of its place.
    factors, factor = [1], _FACTOR
    while len(factors) < anchor:
        factors = [f * factor % (1 << 64) for f in factors] + factors
        factor = (factor * factor + 2) % (1 << 64)
    table, h = _spread(np.arange(256, dtype=np.uint8)), np.zeros(len(at), np.uint64)
    for k, f in enumerate(factors):
        h += table[data[at + k]] * np.uint64(f)
    out[places >= 0] = _finished(h)
    rest = np.flatnonzero(places < 0)
    if len(rest):
        n = sizes[rest]
        ends = np.cumsum(n)
        offset = np.arange(ends[-1]) - np.repeat(ends - n, n)
        hashes = np.full(len(offset), _MASK)
        parts = _part_hashes(data[np.repeat(begin[rest], n) + offset], anchor)
        inside = (offset <= np.repeat(n, n) - anchor)[: len(parts)]
        hashes[: len(parts)][inside] = parts[inside]
        out[rest] = np.minimum.reduceat(hashes, ends - n)
    return out.astype(np.int64)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while 2 * step <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    more = width - step
    return np.minimum(values[: len(values) - more], values[more:]) if more else values


def runs(text: bytes, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """Anchors and first places of the runs of ``length``-byte strings with one anchor."""
    return _hashed_runs(text, np.array([len(text)]), length, anchor)[:2]


def _hashed_runs(
    flat: bytes, ends: np.ndarray, length: int, anchor: int, hashed: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same for texts that stand in one buffer, the places behind the runs, and the parts' hashes if asked for."""
    data = np.frombuffer(flat, np.uint8)
    whole = np.zeros(len(data) + 1, bool)
    for begin, end in zip([0, *ends[:-1].tolist()], ends.tolist()):
        whole[begin : max(begin, end - length + 1)] = True
    parts = np.zeros(len(data) if hashed else 0, np.uint64)
    anchors, starts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    before = np.zeros(1, np.uint64)
    for at in range(0, len(data) - length + 1, _WIDE):
        hashes = _part_hashes(data[at : at + _WIDE + length - 1], anchor)
        if hashed:
            parts[at : at + len(hashes)] = hashes
        least = _sliding_min(hashes, length - anchor + 1)
        here = whole[at : at + len(least)]
        new = here & (least != np.concatenate([before, least[:-1]]))
        # A text's first string begins a run, whatever stands before it.
        new |= here & ~np.concatenate([whole[at - 1 : at] if at else whole[-1:], here[:-1]])
        begin = np.flatnonzero(new)
        anchors.append(least[begin])
        starts.append(begin + at)
        before = least[-1:]
    anchors, starts = np.concatenate(anchors), np.concatenate(starts)
    stops = ends[np.searchsorted(ends, starts, "right")] - length + 1
    stops[:-1] = np.minimum(stops[:-1], starts[1:])
    return anchors, starts, stops, parts


def _pieces(
    anchors: np.ndarray, starts: np.ndarray, stops: np.ndarray, parts: np.ndarray, length: int, anchor: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors, starts, ends and places of the anchor of runs; long runs come in pieces.

    The place is -1 where the anchor is in the run more than once.
    """
    width = length - anchor + 1
    at = starts[:, None] + np.arange(2 * width)
    last = stops - 1 + width
    there = (parts[np.minimum(at, max(0, len(parts) - 1))] == anchors[:, None]) & (at < last[:, None])
    place = np.where((there.sum(axis=1) == 1) & (stops - starts <= width), there.argmax(axis=1), -1)
    count = -(-(stops - starts) // FRAGMENT_STRINGS)
    piece = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    begin = np.repeat(starts, count) + FRAGMENT_STRINGS * piece
    end = np.minimum(begin + FRAGMENT_STRINGS, np.repeat(stops, count)) + length - 1
    return np.repeat(anchors, count), begin, end, np.repeat(place, count)


def fragments(text: bytes, wanted: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR):
    """Anchors, starts, ends and places of the anchor of the runs with an anchor of ``wanted``."""
    anchors, starts, stops, parts = _hashed_runs(text, np.array([len(text)]), length, anchor, hashed=True)
    chosen = np.isin(anchors, wanted)
    return _pieces(anchors[chosen], starts[chosen], stops[chosen], parts, length, anchor)


def _squeezed(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes; who reads them knows their types."""
    sizes = np.array([a.nbytes for a in arrays], np.int64)
    return zstandard.ZstdCompressor(3).compress(b"".join([sizes.tobytes(), *(a.tobytes() for a in arrays)]))


def _opened(packed: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    sizes = np.frombuffer(raw, np.int64, len(kinds))
    ends = np.cumsum(sizes) + sizes.nbytes
    return [np.frombuffer(raw[e - n : e], k) for e, n, k in zip(ends.tolist(), sizes.tolist(), kinds)]


def _planes(numbers: np.ndarray) -> np.ndarray:
    """The first bytes of all numbers, then the second ones and so on, which compresses better."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T)


def _numbers(planes: np.ndarray, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).reshape(-1).view(kind)


_SLICES = "slice long, packed binary, keys array<long>, sizes array<long>, shas array<binary>"


def _batch(schema: str, columns: list, kinds: list[pa.DataType]) -> pa.RecordBatch:
    names = [f.split()[0] for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _packed_slices(batches, text_col: str, key: str):
    """Rows in numbered slices, all columns of one packed together, and what tells whole copies apart."""
    for batch in slices(batches, text_col):
        number = int.from_bytes(os.urandom(8), "little") >> 1
        raw = texts(batch, text_col)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as stream:
            stream.write_batch(batch)
        packed = zstandard.ZstdCompressor(3).compress(sink.getvalue())
        row = ([number], [packed], [batch.column(key).to_pylist()], [[len(t) for t in raw]], [[hashlib.sha256(t).digest() for t in raw]])
        yield _batch(_SLICES, row, [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary())])


def _rows(packed: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(packed)).read_next_batch()


def _each(batches, *columns: str):
    """The rows' values, of one row at a time, as they may be large."""
    for batch in batches:
        for at in range(batch.num_rows):
            yield [batch.column(c)[at].as_py() for c in columns]


def _flat(rows: pa.RecordBatch, text_col: str) -> tuple[bytes, np.ndarray]:
    """All texts of a slice, and where each ends."""
    raw = texts(rows, text_col)
    return b"".join(raw), np.cumsum([len(t) for t in raw])


def _codes(anchors: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each anchor, then 32 more bits; two that have one code are only cut for nothing."""
    rest, bucket = np.divmod(anchors, np.uint64(buckets))
    return bucket << np.uint64(32) | rest & np.uint64(0xFFFFFFFF)


_REQUESTS = "bucket long, slice long, codes binary"


def _requests(batches, buckets: int, length: int, anchor: int, text_col: str):
    """The codes of a slice's anchors by bucket, once each."""
    for number, packed in _each(batches, "slice", "packed"):
        found = _hashed_runs(*_flat(_rows(packed), text_col), length, anchor)[0]
        codes = np.unique(_codes(found, buckets))
        bucket = (codes >> np.uint64(32)).astype(np.int64)
        cuts = [*np.flatnonzero(np.diff(bucket, prepend=-1)).tolist(), len(codes)]
        low = codes.astype(np.uint32)
        packs = [_squeezed(_planes(np.diff(low[a:b], prepend=np.uint32(0)))) for a, b in zip(cuts, cuts[1:])]
        yield _batch(_REQUESTS, [bucket[cuts[:-1]], np.full(len(packs), number), packs], [pa.int64(), pa.int64(), pa.binary()])


_REPLIES = "slice long, bucket long, bits binary"


def _replies(batches):
    """For each code of a slice a bit that tells whether another slice has it as well."""
    bucket, numbers, held = None, [], []

    def close():
        if not held:
            return
        sizes = [len(h) for h in held]
        entries = np.concatenate(held).astype(np.uint64) << np.uint64(32) | np.arange(sum(sizes), dtype=np.uint64)
        entries.sort()
        same = (entries[1:] >> np.uint64(32)) == (entries[:-1] >> np.uint64(32))
        many = np.append(same, False) | np.insert(same, 0, False)
        shared = np.zeros(len(entries), bool)
        shared[(entries & np.uint64(0xFFFFFFFF))[many].astype(np.int64)] = True
        bits = [np.packbits(b).tobytes() for b in np.split(shared, np.cumsum(sizes)[:-1])]
        yield _batch(_REPLIES, [numbers, [bucket] * len(bits), bits], [pa.int64(), pa.int64(), pa.binary()])
        numbers.clear()
        held.clear()

    for at, number, codes in _each(batches, "bucket", "slice", "codes"):
        if at != bucket:
            yield from close()
            bucket = at
        numbers.append(number)
        held.append(np.cumsum(_numbers(_opened(codes, "u1")[0], "<u4"), dtype=np.uint32))
    yield from close()


_CUT = "slice long, classes binary, places binary, many array<struct<anchor:long,count:long>>"
# Size, anchor's place, smallest id, what the largest is over it, and the bytes of all fragments.
_CLASSES = ("<u2", "<i2", "u1", "u1", "u1")


def _class_columns(sizes, places, least, most, data) -> list[np.ndarray]:
    ids = (_planes(c.astype("<i8")) for c in (np.diff(least, prepend=np.int64(0)), most - least))
    return [sizes.astype("<u2"), places.astype("<i2"), *ids, data]


def _classes_from(columns: list[np.ndarray]) -> list[np.ndarray]:
    sizes, places, least, over, data = columns
    least = np.cumsum(_numbers(least, "<i8"))
    return [sizes, places, least, least + _numbers(over, "<i8"), data]


def _cut_slices(batches, buckets: int, length: int, anchor: int, text_col: str, key: str):
    """A slice's distinct fragments whose anchor other rows have too, and where it has which of them."""
    struct = pa.struct([("anchor", pa.int64()), ("count", pa.int64())])
    for number, packed, replies, copies in _each(batches, "slice", "packed", "replies", "copies"):
        rows = _rows(packed)
        flat, ends = _flat(rows, text_col)
        anchors, starts, stops, parts = _hashed_runs(flat, ends, length, anchor, hashed=True)
        if not len(anchors):
            continue
        codes = _codes(anchors, buckets)
        order = np.argsort(codes)
        codes = codes[order]
        first = np.concatenate([[True], codes[1:] != codes[:-1]])
        distinct, group = np.flatnonzero(first), np.cumsum(first) - 1
        # What other slices have.
        bits = {r["bucket"]: np.unpackbits(np.frombuffer(r["bits"], np.uint8)) for r in replies}
        bucket = (codes[distinct] >> np.uint64(32)).astype(np.int64)
        cuts = [*np.flatnonzero(np.diff(bucket, prepend=-1)).tolist(), len(bucket)]
        shared = np.concatenate([bits[bucket[a]][: b - a] for a, b in zip(cuts, cuts[1:])]).astype(bool)
        # What other rows of this slice have; whole copies neither count nor are cut.
        kept = np.ones(len(ends), bool)
        kept[copies or []] = False
        row = np.searchsorted(ends, starts, "right")
        owner = row[order]
        least = np.minimum.reduceat(np.where(kept[owner], owner, len(ends)), distinct)
        shared |= least < np.maximum.reduceat(np.where(kept[owner], owner, -1), distinct)
        chosen = np.zeros(len(anchors), bool)
        chosen[order] = shared[group]
        chosen &= kept[row]
        if not chosen.any():
            continue
        anchors, begin, end, place = _pieces(anchors[chosen], starts[chosen], stops[chosen], parts, length, anchor)
        # A fragment's bytes have its anchor, so the bytes alone tell fragments apart.
        coded = pa.array([flat[a:b] for a, b in zip(begin.tolist(), end.tolist())], pa.binary()).dictionary_encode()
        idx, n = coded.indices.to_numpy(), len(coded.dictionary)
        owner = rows.column(key).to_numpy()[np.searchsorted(ends, begin, "right")]
        anchor_of, size_of, place_of = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64)
        anchor_of[idx], size_of[idx], place_of[idx] = anchors, end - begin, place
        least, most = np.full(n, _LAST), np.full(n, -_LAST - 1)
        np.minimum.at(least, idx, owner)
        np.maximum.at(most, idx, owner)
        data = np.frombuffer(b"".join(coded.dictionary.to_pylist()), np.uint8)
        classes = _squeezed(*_class_columns(size_of, place_of, least, most, data))
        steps = (np.diff(c.astype("<i4"), prepend=np.int32(0)) for c in (idx, begin))
        # An anchor that no slice has with several fragments has one a slice at most, and is not counted.
        several, count = np.unique(anchor_of, return_counts=True)
        many = [{"anchor": a, "count": c} for a, c in zip(several[count > 1].tolist(), count[count > 1].tolist())]
        row = ([number], [classes], [_squeezed(*steps)], [many])
        yield _batch(_CUT, row, [pa.int64(), pa.binary(), pa.binary(), pa.list_(struct)])


_KINDS = {
    "anchor": pa.int64(), "data": pa.binary(), "place": pa.int32(), "slice": pa.int64(),
    "idx": pa.int32(), "least": pa.int64(), "most": pa.int64(),
}


def _binary(sizes: np.ndarray, data: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _class_rows(number: int, classes: bytes, anchor: int) -> pa.RecordBatch:
    sizes, places, least, most, data = _classes_from(_opened(classes, *_CLASSES))
    n, anchors = len(sizes), _anchors_of(sizes, places, data, anchor)
    columns = [anchors, _binary(sizes, data), places, np.full(n, number), np.arange(n), least, most]
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c.astype(k.to_pandas_dtype())) for c, k in zip(columns, _KINDS.values())],
        list(_KINDS),
    )


_DEALT = "bucket long, rows binary"


def _dealt(batches, buckets: int, large: np.ndarray, anchor: int):
    """Fragments of usual anchors, of several slices at a time, by bucket."""
    held, size = [], 0

    def close():
        rows = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        bucket = rows["anchor"].to_numpy() % buckets
        order = np.argsort(bucket, kind="stable")
        bucket, rows = bucket[order], rows.take(pa.array(order)).combine_chunks()
        cuts = [*np.flatnonzero(np.diff(bucket, prepend=-1)).tolist(), len(bucket)]
        packs = []
        for a, b in zip(cuts, cuts[1:]):
            part = rows.slice(a, b - a)
            data = part["data"].combine_chunks()
            ends = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data) + 1]
            places, numbers, idx, least, most = (part[c].to_numpy() for c in ("place", "slice", "idx", "least", "most"))
            there = np.frombuffer(data.buffers()[2], np.uint8)[ends[0] : ends[-1]]
            idx = _planes(np.diff(idx, prepend=np.int32(0)))
            packs.append(_squeezed(*_class_columns(np.diff(ends), places, least, most, there), numbers, idx))
        return _batch(_DEALT, [bucket[cuts[:-1]], packs], [pa.int64(), pa.binary()])

    for number, classes in _each(batches, "slice", "classes"):
        rows = _class_rows(number, classes, anchor)
        if len(large):
            rows = rows.filter(pa.array(~np.isin(rows.column("anchor").to_numpy(), large)))
        if rows.num_rows:
            held.append(rows)
            size += rows.nbytes
        if held and size >= DEALT_BYTES:
            yield close()
            size = 0
    if held:
        yield close()


def _large_rows(batches, large: np.ndarray, anchor: int):
    """Fragments of the anchors with the most of them."""
    for number, classes in _each(batches, "slice", "classes"):
        rows = _class_rows(number, classes, anchor)
        rows = rows.filter(pa.array(np.isin(rows.column("anchor").to_numpy(), large)))
        yield rows.select(["slice", "idx", "least", "most", "data"])


def _range_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Smallest of ``values[low..high]`` for each pair; long ranges go by blocks. The last value is in no range."""
    long = high - low >= 2 * _BLOCK
    blocks = long.any()
    out = _near_min(values, low, np.where(long, low, high) if blocks else high)
    if blocks:
        at, low, high = np.flatnonzero(long), low[long], high[long]
        first, last = -(-low // _BLOCK), (high + 1) // _BLOCK
        ends = _near_min(values, np.concatenate([low, last * _BLOCK - 1]), np.concatenate([first * _BLOCK, high]))
        least = np.minimum(ends[: len(at)], ends[len(at) :])
        table = [np.minimum.reduceat(values, np.arange(0, len(values), _BLOCK))]
        while len(table[-1]) > 1 << (len(table) - 1):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        level = np.floor(np.log2(last - first)).astype(np.int64)
        for k in np.unique(level).tolist():
            pick = level == k
            a, b = table[k][first[pick]], table[k][last[pick] - (1 << k)]
            least[pick] = np.minimum(least[pick], np.minimum(a, b))
        out[at] = least
    return out


def _near_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The same, range by range; from the last one to the first, so that nothing between them is looked at."""
    order = np.argsort(low)[::-1]
    edges = np.empty(2 * len(order), np.int64)
    edges[::2], edges[1::2] = low[order], high[order] + 1
    out = np.empty(len(order), values.dtype)
    out[order] = np.minimum.reduceat(values, edges)[::2]
    return out


class Collection:
    """Burrows-Wheeler transform and common prefixes of a collection, in files of a folder."""

    def __init__(self, strings: list[bytes], folder: str, most: int = LENGTH):
        self.folder, self.most = folder, most
        self.sizes = np.array([len(s) for s in strings], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.flat = np.frombuffer(b"".join(strings), np.uint8)
        self.count = len(strings)
        # Two generations of files, mapped so that a round reads one and writes the other in order.
        room = int(self.sizes.sum()) + self.count
        # A row is a symbol and what it has in common with the row before.
        self.files = [np.asarray(np.memmap(f"{folder}/rows{k}", np.uint8, "w+", shape=(room, 2))) for k in range(2)]
        self.now, self.rows_now = 0, self.count
        self.numbers = np.arange(room, dtype=np.int32)
        # Round 0: the ends of all strings, before which their last symbols stand.
        self.files[0][: self.count, 0] = self.flat[self.ends - 1]
        self.files[0][: self.count, 1] = 0
        self.rows = np.arange(self.count)
        for step in range(1, int(self.sizes.max()) + 1):
            self._insert(step)

    def read(self) -> tuple[np.ndarray, np.ndarray]:
        rows = self.files[self.now][: self.rows_now]
        return np.ascontiguousarray(rows[:, 0]), np.ascontiguousarray(rows[:, 1])

    def _insert(self, step: int) -> None:
        """Insert the suffixes of ``step`` symbols; ``rows`` has where those of one less stand."""
        symbols, common = self.read()
        common = np.append(common, np.uint8(0))
        active = np.flatnonzero(self.sizes >= step)
        rows = self.rows[active]
        # Rows by the symbol before them, which is the order of the longer suffixes.
        order = np.argsort(symbols, kind="stable")
        # Strings that are in already stand before no symbol.
        total = len(order) - (self.count - len(active))
        place = np.empty(len(order), np.int32)
        place[order] = self.numbers[: len(order)]
        new = place[rows].astype(np.int64)
        mine = symbols[rows]

        def shared_with(before: np.ndarray, after: np.ndarray, same: np.ndarray) -> np.ndarray:
            """One more than what the rows after the first of two occurrences have in common."""
            out = np.zeros(len(before), np.uint8)
            if same.any():
                least = _range_min(common, before[same] + 1, after[same])
                out[same] = np.minimum(least + np.uint8(1), self.most)
            return out

        before = order[np.maximum(new - 1, 0)]
        follows = np.minimum(new + 1, len(order) - 1)
        after = order[follows]
        next_same = (new + 1 < total) & (symbols[after] == mine)
        same = np.concatenate([(new > 0) & (symbols[before] == mine), next_same])
        both = shared_with(np.concatenate([before, rows]), np.concatenate([rows, after]), same)
        lcp, lcp_next = both[: len(rows)], both[len(rows) :]
        size = self.count + total
        old_rows = np.ones(size, bool)
        old_rows[self.count + new] = False
        former, self.now, self.rows_now = self.files[self.now][: len(symbols)], 1 - self.now, size
        written = self.files[self.now][:size]
        written.view(np.uint16)[:, 0][old_rows] = former.view(np.uint16)[:, 0]
        begin = self.ends[active] - self.sizes[active]
        at = self.ends[active] - step - 1
        written[self.count + new, 0] = np.where(at >= begin, self.flat[np.maximum(at, 0)], _END)
        written[self.count + new, 1] = lcp
        written[self.count + follows[next_same], 1] = lcp_next[next_same]
        self.rows[active] = self.count + new

    def suffixes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """String and start of each row's suffix (the ends first), and the common prefixes."""
        symbols, common = self.read()
        order = np.argsort(symbols, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        string, start = np.empty(len(symbols), np.int64), np.empty(len(symbols), np.int64)
        row = np.arange(self.count)
        string[row], start[row] = row, self.sizes
        for step in range(1, int(self.sizes.max()) + 1):
            active = np.flatnonzero(self.sizes >= step)
            row[active] = self.count + place[row[active]]
            string[row[active]], start[row[active]] = active, self.sizes[active] - step
        return string, start, common


def first_ids(strings: list[bytes], ids: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each ``length``-byte string of each member the smallest id of a member that has it."""
    with tempfile.TemporaryDirectory(dir=os.environ.get("TMPDIR")) as folder:
        string, start, common = Collection(strings, folder, length).suffixes()
    group = np.flatnonzero(common < length)
    least = np.minimum.reduceat(ids[string], group)
    least = np.repeat(least, np.diff(np.append(group, len(string))))
    sizes = np.array([max(0, len(s) - length + 1) for s in strings], np.int64)
    begin = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), np.int64)
    whole = start < sizes[string]
    out[begin[string[whole]] + start[whole]] = least[whole]
    return np.split(out, begin[1:])


_RUNS = "slice long, idx int, at int, n int, first long"


def _sorted_collections(batches, length: int, anchor_size: int):
    """Runs of strings of the slices' fragments and the smallest id that has them.

    Rows come by anchor and bytes. Equal fragments of several slices are one member of a collection.
    A string reaches over its anchor by two thirds of its other bytes on the left or on the right,
    or else by a third on both sides. So a fragment of whose surroundings all of these are its own
    shares no string and needs no sorting. Members with strings beyond one occurrence of their anchor
    are few but long; they have collections of their own, since each column takes a round.
    """

    def runs_of(member: tuple, least: np.ndarray, out: list[tuple]) -> None:
        cuts = [0, *(np.flatnonzero(least[1:] != least[:-1]) + 1).tolist(), len(least)]
        for a, b in zip(cuts, cuts[1:]):
            first = int(least[a])
            out += [(number, i, a, b - a, first) for number, i, most in member[2] if first < most]

    def close() -> pa.RecordBatch:
        kinds = [pa.int64(), *[pa.int32()] * 3, pa.int64()]
        columns = [pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 5, kinds)]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _RUNS.split(", ")])

    def sort(held: list[list]) -> None:
        ids = np.array([m[1] for m in held], np.int64)
        for m, least in zip(held, first_ids([m[0] for m in held], ids, length)):
            runs_of(m, least, out)
        held.clear()

    # A member: bytes, smallest id, its slices (slice, idx, largest id), whether to sort, anchor's place.
    others = length - anchor_size
    wide = 2 * others // 3 + 1
    narrow = others - wide + 1
    group: list[list] = []
    collections: dict[bool, list[list]] = {False: [], True: []}
    sizes = {False: 0, True: 0}
    out: list[tuple] = []

    def sides(data: bytes, place: int) -> list[tuple[int, bytes]]:
        """The anchor's surroundings of either size, where the fragment has so much."""
        left, right = data[:place], data[place + anchor_size :]
        found = [(0, left[-wide:])] if len(left) >= wide else []
        found += [(1, right[:wide])] if len(right) >= wide else []
        both = len(left) >= narrow and len(right) >= narrow
        return [*found, (2, left[-narrow:] + right[:narrow])] if both else found

    def leave():
        if len(group) > 1:
            if any(m[4] < 0 for m in group):
                for m in group:
                    m[3] = True
            else:
                keys = [sides(m[0], m[4]) for m in group]
                count = Counter(k for found in keys for k in found)
                for m, found in zip(group, keys):
                    m[3] = any(count[k] > 1 for k in found)
        long = any(len(m[0]) > length + others for m in group)
        for m in group:
            if m[3]:
                collections[long].append(m)
                sizes[long] += len(m[0])
            else:
                out.extend((number, i, 0, len(m[0]) - length + 1, m[1]) for number, i, most in m[2] if m[1] < most)

    def alone(rows: pa.Table, starts: np.ndarray) -> tuple[np.ndarray, pa.RecordBatch]:
        """Which rows have an anchor that different fragments have, and the runs of all others."""
        counts = np.diff(np.append(starts, rows.num_rows))
        data = rows["data"].combine_chunks()
        other = np.ones(rows.num_rows, bool)
        other[1:] = pc.not_equal(data[1:], data[:-1]).to_numpy(zero_copy_only=False)
        other[starts] = False
        several = np.repeat(np.logical_or.reduceat(other, starts), counts)
        first = np.repeat(np.minimum.reduceat(rows["least"].to_numpy(), starts), counts)
        picked = np.flatnonzero(~several & (first < rows["most"].to_numpy()))
        found = rows.select(["slice", "idx"]).take(pa.array(picked)).combine_chunks()
        n = pc.binary_length(data).to_numpy()[picked] - length + 1
        columns = [found["slice"], found["idx"], np.zeros(len(picked), np.int32), n, first[picked]]
        return several, pa.RecordBatch.from_arrays(
            [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else pa.array(c) for c in columns],
            [f.split()[0] for f in _RUNS.split(", ")],
        )

    def take(rows: pa.Table):
        """Rows of whole groups."""
        anchors = rows["anchor"].to_numpy()
        several, found = alone(rows, np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]])))
        yield found
        rows, present = rows.filter(pa.array(several)), None
        columns = (rows[c].to_pylist() for c in ("anchor", "data", "place", "slice", "idx", "least", "most"))
        for anchor, data, place, number, i, least, most in zip(*columns):
            if anchor != present:
                leave()
                group.clear()
                for held in (k for k in collections if sizes[k] >= COLLECTION_BYTES):
                    sort(collections[held])
                    sizes[held] = 0
                if len(out) > GROUP_FRAGMENTS:
                    yield close()
                present = anchor
            if group and group[-1][0] == data:
                group[-1][1] = min(group[-1][1], least)
            else:
                group.append([data, least, [], False, place])
            group[-1][2].append((number, i, most))
        leave()
        group.clear()

    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows]).combine_chunks()
        anchors = rows["anchor"].to_numpy()
        # The last anchor may go on in the next batch.
        cut = int(np.searchsorted(anchors, anchors[-1])) if len(anchors) else 0
        if cut:
            yield from take(rows.slice(0, cut))
        rest = rows.slice(cut)
    if rest is not None and rest.num_rows:
        yield from take(rest)
    for held in collections.values():
        if held:
            sort(held)
    if out:
        yield close()


def _by_whole_strings(classes: DataFrame, length: int) -> DataFrame:
    """The same as the sorted collections give, by grouping equal strings."""
    places = F.sequence(F.lit(1), F.octet_length("data") - length + 1)
    rows = classes.select("slice", "idx", "least", "most", "data", F.explode(places).alias("place"))
    rows = rows.withColumn("string", F.substring("data", F.col("place"), F.lit(length))).drop("data")
    first = rows.groupBy("string").agg(F.min("least").alias("first"))
    joined = rows.join(first, "string").where(F.col("first") < F.col("most"))
    return joined.select("slice", "idx", (F.col("place") - 1).alias("at"), F.lit(1).alias("n"), "first")


_FOUND = "slice long, found binary"


def _found_by_slice(runs: pa.Table) -> pa.RecordBatch:
    """Runs that were found, packed by slice."""
    runs = runs.sort_by([("slice", "ascending"), ("idx", "ascending"), ("at", "ascending")]).combine_chunks()
    numbers, idx, at, n, first = (c.to_numpy() for c in runs.columns)
    cuts = [*(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist()]
    cuts = [0, *cuts, len(numbers)] if len(numbers) else [0]
    packs = [
        _squeezed(np.diff(idx[a:b], prepend=np.int32(0)), at[a:b].astype("<u2"), n[a:b].astype("<u2"), first[a:b])
        for a, b in zip(cuts, cuts[1:])
    ]
    return _batch(_FOUND, [numbers[cuts[:-1]], packs], [pa.int64(), pa.binary()])


def _bucket_runs(batches, length: int, anchor: int):
    """Runs of shared strings of a bucket's fragments."""
    bucket, held = None, []

    def close():
        if not held:
            return
        sizes, places, least, most, data, slice_of, idx = (np.concatenate(c) for c in zip(*held))
        held.clear()
        anchors = _anchors_of(sizes, places, data, anchor)
        columns = [anchors, _binary(sizes, data), places.astype(np.int32), slice_of, idx, least, most]
        rows = pa.table(dict(zip(_KINDS, columns)))
        rows = rows.sort_by([("anchor", "ascending"), ("data", "ascending")]).combine_chunks()
        found = pa.Table.from_batches(list(_sorted_collections(rows.to_batches(), length, anchor)))
        if found.num_rows:
            yield _found_by_slice(found)

    for at, rows in _each(batches, "bucket", "rows"):
        if at != bucket:
            yield from close()
            bucket = at
        *columns, numbers, idx = _opened(rows, *_CLASSES, "<i8", "u1")
        held.append([*_classes_from(columns), numbers, np.cumsum(_numbers(idx, "<i4"), dtype=np.int32)])
    yield from close()


def _pack_runs(batches):
    for batch in batches:
        if batch.num_rows:
            yield _found_by_slice(pa.Table.from_batches([batch]))


def _gone(
    ends: np.ndarray, keys: np.ndarray, copies: list[int], places: bytes | None, found: list[bytes], length: int
) -> np.ndarray:
    """Which bytes of a slice lie in strings that a smaller id has as well."""
    change = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, np.int32)
    if places is not None and found:
        idx, begin = (np.cumsum(c) for c in _opened(places, "<i4", "<i4"))
        packs = [_opened(f, "<i4", "<u2", "<u2", "<i8") for f in found]
        of = np.concatenate([np.cumsum(p[0]) for p in packs])
        at, n, first = (np.concatenate([p[i] for p in packs]).astype(np.int64) for i in range(1, 4))
        order = np.argsort(of, kind="stable")
        of, at, n, first = of[order], at[order], n[order], first[order]
        low, high = np.searchsorted(of, idx, "left"), np.searchsorted(of, idx, "right")
        count = high - low
        piece = np.repeat(np.arange(len(idx)), count)
        run = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count) + low[piece]
        smaller = first[run] < keys[np.searchsorted(ends, begin, "right")][piece]
        piece, run = piece[smaller], run[smaller]
        start = begin[piece] + at[run]
        stop = start + n[run] + length - 1
        change += np.bincount(start, minlength=len(change)).astype(np.int32)
        change -= np.bincount(stop, minlength=len(change)).astype(np.int32)
    gone = np.cumsum(change[:-1]) > 0
    for c in copies:
        gone[ends[c - 1] if c else 0 : ends[c]] = True
    return gone


def remove_repeats(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    anchor: int = ANCHOR,
    group_fragments: int = GROUP_FRAGMENTS,
) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with the bytes that stay (``kept``) and the counts of bytes, removed ones and spans.

    The second value names the added columns, whose names avoid those of ``df``.
    """
    spark = df.sparkSession
    added = {"kept": "binary", "n_bytes": "long", "n_removed": "long", "n_spans": "long"}
    name = {c: fresh(df, c) for c in ("key", *added)}
    others = [c for c in df.columns if c != text_col]
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias(name["key"])
    docs = df.select(*others, F.col(text_col).cast("string").alias(text_col), key)
    packed = docs.mapInArrow(give_back(partial(_packed_slices, text_col=text_col, key=name["key"])), _SLICES)
    packed = materialize(packed, "slices", compression="uncompressed")
    # Whole copies: only those with the smallest id are looked into.
    rows = packed.select("slice", F.posexplode(F.arrays_zip("keys", "sizes", "shas")).alias("row", "is"))
    rows = rows.select("slice", "row", "is.keys", "is.shas").where(F.col("is.sizes") >= length)
    firsts = rows.groupBy("shas").agg(F.min("keys").alias("first"), F.max("keys").alias("last")).where("first < last")
    # Written, so that a join with many copies of one text can be split.
    firsts = materialize(firsts.drop("last"), "firsts", let_go=True)
    copies = rows.join(firsts, "shas").where("first < keys")
    copies = materialize(copies.groupBy("slice").agg(F.collect_list("row").alias("copies")), "copies", let_go=True)
    with shuffles_let_go(spark):
        total = packed.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))
    cutting = dict(buckets=buckets, length=length, anchor=anchor, text_col=text_col)
    packed = packed.select("slice", "packed")
    replies = packed.mapInArrow(give_back(partial(_requests, **cutting)), _REQUESTS)
    replies = replies.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(give_back(_replies), _REPLIES)
    replies = materialize(replies, "replies", compression="zstd", let_go=True)
    replies = replies.groupBy("slice").agg(F.collect_list(F.struct("bucket", "bits")).alias("replies"))
    cut = packed.join(replies, "slice").join(copies, "slice", "left")
    cut = cut.mapInArrow(give_back(partial(_cut_slices, **cutting, key=name["key"])), _CUT)
    cut = materialize(cut, "fragments", compression="uncompressed", let_go=True)
    many = cut.select(F.explode("many").alias("m")).groupBy("m.anchor").agg(F.sum("m.count").alias("n"))
    # So many fragments each, that the list stays small.
    with shuffles_let_go(spark):
        large = np.array([r["anchor"] for r in many.where(F.col("n") > group_fragments).collect()], np.int64)
    classes = cut.select("slice", "classes")
    found = classes.mapInArrow(give_back(partial(_dealt, buckets=buckets, large=large, anchor=anchor)), _DEALT)
    found = found.repartition("bucket").sortWithinPartitions("bucket")
    found = found.mapInArrow(give_back(partial(_bucket_runs, length=length, anchor=anchor)), _FOUND)
    if len(large):
        rest = classes.mapInArrow(
            partial(_large_rows, large=large, anchor=anchor), "slice long, idx int, least long, most long, data binary"
        )
        rest = _by_whole_strings(rest, length).repartition("slice")
        found = found.unionByName(rest.mapInArrow(_pack_runs, _FOUND))
    found = materialize(found, "runs", compression="uncompressed", let_go=True)
    found = found.groupBy("slice").agg(F.collect_list("found").alias("found"))
    out = StructType([f for f in docs.schema.fields if f.name in others])
    out = out.add(text_col, "string")
    for c, kind in added.items():
        out = out.add(name[c], kind)
    apply = partial(_cut_texts, key=name["key"], text_col=text_col, others=others, names=out.names, length=length)
    joined = packed.join(cut.select("slice", "places"), "slice", "left").join(found, "slice", "left")
    result = joined.join(copies, "slice", "left").mapInArrow(give_back(apply), out)
    return result.select(*df.columns, *[name[c] for c in added]), name


def _cut_texts(batches, key: str, text_col: str, others: list[str], names: list[str], length: int):
    """A slice's rows, what stays of their texts, and the counts of bytes, removed ones and spans."""
    for packed, places, found, copies in _each(batches, "packed", "places", "found", "copies"):
        rows = _rows(packed)
        flat, ends = _flat(rows, text_col)
        gone = _gone(ends, rows.column(key).to_numpy(), copies or [], places, found or [], length)
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        before = np.concatenate([[0], np.cumsum(gone)])
        first = gone.copy()
        first[1:] &= ~gone[:-1]
        at = begins[begins < ends]
        first[at] = gone[at]
        spans = np.concatenate([[0], np.cumsum(first)])
        removed = before[ends] - before[begins]
        kept = _binary(ends - begins - removed, np.frombuffer(flat, np.uint8)[~gone])
        counts = [ends - begins, removed, spans[ends] - spans[begins]]
        columns = [*(rows.column(c) for c in others), rows.column(text_col), kept, *(pa.array(c, pa.int64()) for c in counts)]
        yield pa.RecordBatch.from_arrays(columns, names)


def without_repeats(df: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``df`` with its texts cut; a character that loses a byte goes entirely. Null texts stay."""
    found, name = remove_repeats(df, text_col=text_col, **options)
    columns_of, cut_bytes = df.columns, name["kept"]

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        old, kept = batch.column(text_col), batch.column(cut_bytes)
        cut = [None if t is None else k.decode("utf-8", "ignore") for t, k in zip(old.to_pylist(), kept.to_pylist())]
        columns = [pa.array(cut, pa.string()) if c == text_col else batch.column(c) for c in columns_of]
        return pa.RecordBatch.from_arrays(columns, columns_of)

    return map_texts(found, text_col, df.schema, lambda: apply)


def repeat_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id``, byte counts and the checksum of what stays, per row."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found, name = remove_repeats(rows, **options)
    return found.select(
        "doc_id", *[F.col(name[c]).alias(c) for c in ("n_bytes", "n_removed", "n_spans")], F.sha2(name["kept"], 256).alias("kept_sha256")
    )
