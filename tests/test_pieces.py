"""The book's two steps go through a micro-batch in pieces; state is a stand-in, without Spark."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tickloom.functions.clock import BAR_NS
from tickloom.streaming import book, packs

SHARDS = 3


class Cell:
    """A value, list or map state."""

    def __init__(self):
        self.value, self.entries, self.most = None, {}, 0

    def get(self):
        return self.value

    def exists(self):
        return self.value is not None

    def update(self, value):
        self.value = value

    put = update

    def clear(self):
        self.value = None

    def getValue(self, key):
        return self.entries.get(key)

    def updateValue(self, key, value):
        self.entries[key] = value
        self.most = max(self.most, len(self.entries))

    def removeKey(self, key):
        self.entries.pop(key, None)


class Handle:
    def __init__(self):
        self.cells, self.timers = {}, set()

    def _cell(self, name, *_):
        return self.cells.setdefault(name, Cell())

    getValueState = getListState = getMapState = _cell

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class Watermark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def started(processor):
    handle = Handle()
    processor.init(handle)
    return processor, handle


def arrivals(n, seed=0):
    """Packs of a hundred events in any order, ten to a bucket, dealt over shards."""
    rng = np.random.default_rng(seed)
    side = rng.choice([1, -1], n)
    table = pa.table(
        {
            "underlier": ["U"] * n, "instrument_type": ["FUT"] * n,
            "event_time": np.arange(n) * (BAR_NS // 10), "order_id": np.arange(n),
            "action": ["A"] * n, "side": ["B"] * n, "price": 100.0 - side * rng.integers(1, 30, n),
            "side_sign": side.astype(np.int32), "sequence": np.arange(n), "size": np.ones(n, np.int64),
            "delta": rng.choice([1, 1, -1, 0], n), "is_trade": rng.random(n) < 0.1,
        }
    )
    shard = (table["price"].to_numpy() % SHARDS).astype(int)
    for s in range(SHARDS):
        rows = np.flatnonzero(shard == s)
        rows = rng.permutation(rows)
        yield [packs.pack(table.take(rows[i : i + 100])) for i in range(0, len(rows), 100)]


def replayed(n):
    """All frames of both steps, and what the state has seen: arrival, then release of all."""
    second, book_handle = started(book._BookProcessor(10**9))
    sent = []
    for body in arrivals(n):
        first, handle = started(book._LevelProcessor(BAR_NS))
        frame = pd.DataFrame({packs.ROWS: body})
        assert list(first.handleInputRows(("C",), iter([frame]), Watermark(0))) == []
        sent += first.handleExpiredTimer(("C",), Watermark(n * BAR_NS // 10 // 10**6 + 10_000), None)
        assert not handle.cells["packs"].entries and not handle.cells["held"].exists()
    bars = list(second.handleInputRows(("C",), iter(sent), Watermark(0)))
    return sent, bars, book_handle.cells


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(packs, "GATHER_BYTES", 50_000)
    monkeypatch.setattr(packs, "PIECE_ROWS", 64)
    monkeypatch.setattr(packs, "STEP_ROWS", 256)
    monkeypatch.setattr(book, "HELD_BYTES", 40_000)


def test_a_large_micro_batch_is_handed_on_in_steps():
    """Neither step hands on, or holds as a table, all that a micro-batch brought."""
    n = 400_000
    sent, bars, cells = replayed(n)
    assert sum(len(b) for b in bars) == n // 10
    assert max(len(b) for b in bars) < n // 10 // 3
    assert max(len(p) for frame in sent for p in frame[packs.ROWS]) < 2 << 20
    assert cells["spilled"].most > 0 and not cells["spilled"].entries


def test_pieces_change_no_bar_and_no_state(monkeypatch, small):
    n = 6_000
    _, cut, cut_cells = replayed(n)
    assert len(cut) > 3 and cut_cells["spilled"].most > 3 and not cut_cells["spilled"].entries
    monkeypatch.undo()
    _, whole, cells = replayed(n)
    assert len(whole) == 1 and cells["spilled"].most == 0
    pd.testing.assert_frame_equal(pd.concat(cut, ignore_index=True), whole[0])
    for name in ("levels", "last", "trades"):
        assert cut_cells[name].get() == cells[name].get() and cells[name].exists()


def test_late_and_open_buckets_come_apart_in_pieces(small):
    n = 3_000
    closed = 1_000 * BAR_NS // 10
    first, handle = started(book._LevelProcessor(BAR_NS))
    body = next(arrivals(n))
    total = packs.unpack(body).num_rows
    late = list(first.handleInputRows(("C",), iter([pd.DataFrame({packs.ROWS: body})]), Watermark(closed // 10**6)))
    assert {k for f in late for k in f["kind"]} == {book.LATE}
    behind = packs.unpack(p for f in late for p in f[packs.ROWS])
    kept = packs.unpack(v[0] for v in handle.cells["packs"].entries.values())
    assert (behind["event_time"].to_numpy() < closed).all() and (kept["event_time"].to_numpy() >= closed).all()
    assert behind.num_rows + kept.num_rows == total
    sent = list(first.handleExpiredTimer(("C",), Watermark(2 * closed // 10**6), None))
    changes = packs.unpack(p for f in sent for p in f[packs.ROWS])
    open_ = packs.unpack(v[0] for v in handle.cells["packs"].entries.values())
    assert changes["bucket_ns"].to_numpy().max() < 2 * closed <= open_["event_time"].to_numpy().min()
    assert sum(changes["event_count"].to_pylist()) + open_.num_rows == kept.num_rows


@pytest.mark.parametrize("runs", [1, 7])
def test_merge_hands_on_equal_values_once(small, runs):
    rng = np.random.default_rng(runs)
    values = [rng.integers(0, 300, 500) for _ in range(runs)]
    cut = [p for v in values for p in packs.pieces(pa.table({"x": v}), v)]
    reads = []

    def load(i):
        reads.append(i)
        return packs.unpack([cut[i][2]])

    found = list(packs.in_order([low for low, _, _ in cut], load, lambda t: t["x"].to_numpy(), 200))
    seen = [set(t["x"].to_pylist()) for t, _ in found]
    assert sorted(reads) == list(range(len(cut)))
    assert all(max(a) < min(b) for a, b in zip(seen, seen[1:]))
    assert [done for _, done in found] == [True] * (len(found) - 1) + [False]
    assert sorted(x for t, _ in found for x in t["x"].to_pylist()) == sorted(np.concatenate(values).tolist())
