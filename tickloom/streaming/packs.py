"""Rows packed per key on their way into a keyed streaming operator.

A stateful Python operator is called per key and row batch; packs let it handle many rows as one
Arrow table. Packing is done by the tasks that read the rows, ahead of the shuffle. An operator that
has to put the rows of a key in order cuts them into pieces and merges these, so that it holds a few
pieces at a time and not all rows of a micro-batch.
"""

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CLOCK, ROWS = "event_clock", "packed_rows"

# Bytes of packs that are unpacked together, rows of a piece, and rows that a merge hands on, about.
GATHER_BYTES, PIECE_ROWS, STEP_ROWS = 2 << 20, 1 << 11, 1 << 13


def packer(keys: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A pack per key of each Arrow batch, and a row that only carries the batch's latest clock.

    Spark drops rows behind the watermark ahead of a processor. Packs have no clock, so it keeps
    them; rows that have one are of use to the watermark alone and end ahead of the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]).sort_by([(k, "ascending") for k in keys])
            rows = table.drop_columns([*keys, CLOCK]).combine_chunks().to_batches()[0]
            starts = np.flatnonzero(_changes([table[k] for k in keys]))
            ends = [*starts[1:], batch.num_rows]
            packs = [_write(rows.slice(at, end - at)) for at, end in zip(starts, ends)]
            heads = table.select(keys).take(pa.array(starts))
            columns = {k: pa.concat_arrays([*heads[k].chunks, pa.nulls(1, heads[k].type)]) for k in keys}
            clock = pa.array([None] * len(packs) + [pc.max(table[CLOCK]).as_py()], table[CLOCK].type)
            yield pa.RecordBatch.from_pydict(
                {**columns, CLOCK: clock, ROWS: pa.array([*packs, None], pa.binary())}
            )

    return run


def _changes(columns: list[pa.ChunkedArray]) -> np.ndarray:
    """True where a sorted table's key differs from that of the row before."""
    out = np.zeros(len(columns[0]), bool)
    out[0] = True
    for column in columns:
        codes = column.combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        out[1:] |= codes[1:] != codes[:-1]
    return out


def _write(rows: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


def pack(table: pa.Table) -> bytes:
    return _write(table.combine_chunks().to_batches()[0])


def unpack(packs: Iterable[bytes]) -> pa.Table:
    return pa.concat_tables(pa.ipc.open_stream(p).read_all() for p in packs).combine_chunks()


def gather(packs: Iterable[bytes]) -> Iterator[pa.Table]:
    """The rows of packs, a bounded number of bytes at a time."""
    held, size = [], 0
    for p in packs:
        held.append(p)
        size += len(p)
        if size >= GATHER_BYTES:
            yield unpack(held)
            held, size = [], 0
    if held:
        yield unpack(held)


def pieces(table: pa.Table, at: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """Least and greatest ``at`` of a piece, and its rows; pieces of one table follow one another."""
    if table.num_rows > PIECE_ROWS:
        order = np.argsort(at, kind="stable")
        table, at = table.take(pa.array(order)), at[order]
    for start in range(0, table.num_rows, PIECE_ROWS):
        part = at[start : start + PIECE_ROWS]
        yield int(part.min()), int(part.max()), pack(table.slice(start, PIECE_ROWS))


def in_order(
    lows: Sequence[int],
    load: Callable[[int], pa.Table],
    at: Callable[[pa.Table], np.ndarray],
    end: int | None = None,
) -> Iterator[tuple[pa.Table, bool]]:
    """Merge pieces, given by their least ``at`` and a function that reads one by its place.

    Each table has all rows of its values of ``at``, which lie above those of the table before; the
    flag tells them from the rows at ``end`` and after, which come last. A piece is read once, when
    its turn comes, so that only pieces that overlap are held together.
    """
    order = sorted(range(len(lows)), key=lows.__getitem__)
    kept, i = None, 0
    while i < len(order):
        tables, rows = ([], 0) if kept is None else ([kept], -kept.num_rows)
        # As many new rows as were left over, so that none is looked at over and over again.
        while i < len(order) and rows < STEP_ROWS:
            tables.append(load(order[i]))
            rows += tables[-1].num_rows
            i += 1
        limit = lows[order[i]] if i < len(order) else None
        limit = min((x for x in (limit, end) if x is not None), default=None)
        kept = pa.concat_tables(tables).combine_chunks()
        if limit is None:
            break
        ready = at(kept) < limit
        if ready.any():
            yield kept.filter(pa.array(ready)), True
            kept = kept.filter(pa.array(~ready))
    if kept is not None and kept.num_rows:
        yield kept, end is None
