"""Order book over a stream in two chained stateful steps.

The first is keyed by a shard of a contract's price levels. It holds events until the watermark has
passed their bucket and then sums up each touched level and bucket in one row, so that the events of
one busy contract are spread over tasks. The second is keyed by contract; it puts these rows in
order of their buckets, keeps level sizes and best prices, and sees a contract fall silent. Both go
through a micro-batch in pieces of time, so their memory does not follow its size.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.functions.clock import BAR_NS, local_day, ns_to_timestamp
from tickloom.operators.book import book_delta, is_trade
from tickloom.schemas import DOUBLE, LONG, STREAM_BAR, STRING, struct
from tickloom.streaming.levels import LevelIndex
from tickloom.streaming.packs import CLOCK, ROWS, gather, in_order, pack, packer, pieces, unpack

IDLE_MS = 600_000
DELAY = "10 minutes"
# Tasks that the levels of one contract can be spread over.
SHARDS = 8
# Changes of a contract that are held in memory; more go through the state store.
HELD_BYTES = 4 << 20

BAR, LATE, CHANGE = "bar", "late", "change"
MS_NS = 1_000_000

LATE_EVENT = dict(
    event_time=LONG, sequence=LONG, order_id=LONG, action=STRING, side=STRING, price=DOUBLE, size=LONG
)
_MEASURES = dict(event_count=LONG, size_total=LONG, buy_size=LONG, sell_size=LONG, notional=DOUBLE)


class _LevelProcessor(StatefulProcessor):
    """Packed events of a shard whose buckets may still grow.

    ``packs`` has an entry or more per arrival, ``held`` the buckets that each spans, so that a
    release reads the packs that it concerns and no others, a few at a time.
    """

    # Changes or late events of a contract, with the least bucket of the changes.
    OUTPUT = struct(
        kind=STRING,
        clock=T.TimestampType(),
        low=LONG,
        **{ROWS: T.BinaryType()},
        contract_id=STRING,
    )

    def __init__(self, width_ns: int) -> None:
        self.width_ns = width_ns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.packs = handle.getMapState("packs", "pack_id LONG", "events BINARY")
        self.held = handle.getValueState(
            "held", "next_id LONG, timer LONG, ids ARRAY<LONG>, lows ARRAY<LONG>, highs ARRAY<LONG>"
        )

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        packs = (bytes(p) for frame in rows for p in frame[ROWS])
        yield from self._release(key[0], timerValues.getCurrentWatermarkInMs(), packs)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._release(key[0], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass

    def _closed(self, watermark_ms: int) -> int:
        """Start of the first bucket that the watermark has not passed whole."""
        return watermark_ms * MS_NS // self.width_ns * self.width_ns

    def _bucket(self, events: pa.Table) -> np.ndarray:
        return events["event_time"].to_numpy() // self.width_ns * self.width_ns

    def _release(self, contract: str, watermark: int, packs: Iterable[bytes] = ()) -> Iterator[pd.DataFrame]:
        """Take in what arrived, sum up buckets that are closed, and wait for the next one to close."""
        closed = self._closed(watermark)
        stored = self.held.get() or (0, None, [], [], [])
        next_id, timer = stored[:2]
        kept, due = [], []
        for entry in zip(*stored[2:]):
            (due if entry[1] < closed else kept).append(entry)
        before = len(kept)

        def hold(events: pa.Table) -> None:
            nonlocal next_id
            for low, high, piece in pieces(events, self._bucket(events)):
                self.packs.updateValue((next_id,), (piece,))
                kept.append((next_id, low, high))
                next_id += 1

        def take(place: int) -> pa.Table:
            number = (due[place][0],)
            piece = bytes(self.packs.getValue(number)[0])
            self.packs.removeKey(number)
            return unpack([piece])

        for events in gather(packs):
            late = self._bucket(events) < closed
            if late.any():
                behind = events.filter(pa.array(late)).select(["underlier", "instrument_type", *LATE_EVENT])
                yield self._rows(contract, LATE, [(watermark + 1) * MS_NS], [0], [pack(behind)])
                events = events.filter(pa.array(~late))
            hold(events)
        for events, ready in in_order([low for _, low, _ in due], take, self._bucket, closed):
            if ready:
                yield self._summed(events, contract)
            else:
                hold(events)
        if not due and len(kept) == before:
            return
        wanted = min(low for _, low, _ in kept) + self.width_ns if kept else None
        wanted = wanted and -(-wanted // MS_NS)
        if wanted != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if wanted is not None:
                self.handle.registerTimer(wanted)
        if kept:
            self.held.update((next_id, wanted, *(list(c) for c in zip(*kept))))
        else:
            self.held.clear()

    def _summed(self, events: pa.Table, contract: str) -> pd.DataFrame:
        """Changes per bucket and level; events that leave the book alone share one of side zero."""
        whole = {c: events[c].to_numpy() for c in ("event_time", "sequence", "size", "delta", "side_sign")}
        price = events["price"].to_numpy()
        on_book = whole["delta"] != 0
        side = np.where(on_book, whole["side_sign"], 0)
        level = np.where(on_book, price, 0.0)
        bucket = self._bucket(events)
        order = np.lexsort((whole["sequence"], whole["event_time"], level, side, bucket))
        bucket, side, level, price = bucket[order], side[order], level[order], price[order]
        time, sequence, size, delta, sign = (v[order] for v in whole.values())
        new = np.ones(len(order), bool)
        new[1:] = (bucket[1:] != bucket[:-1]) | (side[1:] != side[:-1]) | (level[1:] != level[:-1])
        starts = np.flatnonzero(new)
        lengths = np.diff(np.append(starts, len(order)))
        running = np.cumsum(delta)
        running -= np.repeat(running[starts] - delta[starts], lengths)
        sums = lambda values: np.add.reduceat(values, starts)
        last = starts + lengths - 1
        traded = events["is_trade"].to_numpy(zero_copy_only=False)[order]
        # Rows are in order of time within a group, so the last trade is that with the last place.
        trade = np.maximum.reduceat(np.where(traded, np.arange(len(order)), -1), starts)
        some = trade >= 0
        names = {c: events[c].take(pa.array(order[last])) for c in ("underlier", "instrument_type")}
        pick = lambda values: np.where(some, values[trade], 0)
        changes = dict(
            bucket_ns=bucket[starts], side_sign=side[starts], level_price=level[starts],
            total=running[last], low=np.minimum.reduceat(running, starts),
            event_count=lengths, size_total=sums(size), buy_size=sums(np.where(sign == 1, size, 0)),
            sell_size=sums(np.where(sign == -1, size, 0)), notional=sums(np.nan_to_num(price * size)),
            first_time=time[starts], last_time=time[last], last_sequence=sequence[last],
            trades=sums(traded.astype(np.int64)), trade_time=pick(time), trade_sequence=pick(sequence), trade_size=pick(size),
            trade_price=np.where(some, price[trade], np.nan), trade_volume=sums(np.where(traded, size, 0)),
            **names,
        )
        lows, _, packed = zip(*pieces(pa.table(changes), changes["bucket_ns"]))
        return self._rows(contract, CHANGE, [low + self.width_ns for low in lows], lows, packed)

    def _rows(
        self, contract: str, kind: str, clock: Iterable[int], low: Iterable[int], packed: Iterable[bytes]
    ) -> pd.DataFrame:
        # The clock has a zone, since Spark reads bare times in that of the session.
        at = pd.DatetimeIndex(np.array(clock, "datetime64[ns]"), tz="UTC")
        return _frame(self.OUTPUT, len(at), clock=at, low=low, **{ROWS: packed}, kind=kind, contract_id=contract)


class _BookProcessor(StatefulProcessor):
    """Levels, last event and trades of one contract.

    ``levels`` is read and written as one list per micro-batch, in price order. ``spilled`` holds
    changes for as long as a micro-batch has too many of them for memory.
    """

    # kind tells bars from late events.
    OUTPUT = struct(
        kind=STRING,
        bucket_ns=LONG,
        underlier=STRING,
        instrument_type=STRING,
        **_MEASURES,
        best_bid=DOUBLE,
        best_ask=DOUBLE,
        **LATE_EVENT,
        contract_id=STRING,
    )

    def __init__(self, idle_ms: int) -> None:
        self.idle_ns = idle_ms * MS_NS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.levels = handle.getListState("levels", "side INT, price DOUBLE, size LONG")
        self.last = handle.getValueState("last", "event_time LONG")
        self.trades = handle.getValueState("trades", "price DOUBLE, size LONG, total_volume LONG")
        self.spilled = handle.getMapState("spilled", "pack_id LONG", "changes BINARY")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        lows, held, size = [], [], 0
        for frame in rows:
            for kind, low, piece in zip(frame["kind"], frame["low"], frame[ROWS]):
                piece = bytes(piece)
                if kind == LATE:
                    yield self._late(unpack([piece]), key[0])
                    continue
                size += len(piece)
                if size > HELD_BYTES:
                    self.spilled.updateValue((len(held),), (piece,))
                    piece = None
                lows.append(int(low))
                held.append(piece)
        if held:
            yield from self._advance(lows, held, key[0])
        self._expire(timerValues.getCurrentWatermarkInMs() * MS_NS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self._expire(timerValues.getCurrentWatermarkInMs() * MS_NS)
        return iter(())

    def close(self) -> None:
        pass

    def _late(self, events: pa.Table, contract: str) -> pd.DataFrame:
        columns = {c: events[c].to_pandas(integer_object_nulls=True).to_numpy() for c in events.column_names}
        return _frame(self.OUTPUT, events.num_rows, **columns, kind=LATE, contract_id=contract)

    def _expire(self, watermark_ns: int) -> None:
        """Forget a contract whose next event will find it silent; else look again in time."""
        last = self.last.get()
        if last is None:
            return
        due = last[0] + self.idle_ns
        if watermark_ns >= due:
            for state in (self.levels, self.last, self.trades):
                state.clear()
        else:
            # A timer that was overtaken by later events finds nothing to do.
            self.handle.registerTimer(-(-due // MS_NS))

    def _advance(self, lows: list[int], held: list[bytes | None], contract: str) -> Iterator[pd.DataFrame]:
        """Apply the changes of whole buckets in order; return their bars."""

        def take(place: int) -> pa.Table:
            piece, held[place] = held[place], None
            if piece is None:
                piece = bytes(self.spilled.getValue((place,))[0])
                self.spilled.removeKey((place,))
            return unpack([piece])

        book = _Book(self.idle_ns, self.levels.get() if self.levels.exists() else (), self.last.get(), self.trades.get())
        for changes, _ in in_order(lows, take, lambda t: t["bucket_ns"].to_numpy()):
            bars = book.apply({c: changes[c].to_numpy() for c in changes.column_names})
            yield _frame(self.OUTPUT, len(bars["bucket_ns"]), kind=BAR, contract_id=contract, **bars)
        if book.index.sizes:
            self.levels.put(book.index.rows())
        else:
            self.levels.clear()
        self.last.update((book.last,))
        if book.trades:
            self.trades.update(book.trades)
        else:
            self.trades.clear()


class _Book:
    """A contract's levels, last event and trades while changes are applied."""

    def __init__(self, idle_ns: int, levels: Iterable[tuple], last: tuple | None, trades: tuple | None) -> None:
        self.idle_ns = idle_ns
        self.index = LevelIndex(levels)
        self.last = last[0] if last else None
        self.trades = trades

    def apply(self, changes: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """The bars of whole buckets, which lie behind all that were applied before."""
        order = np.lexsort([changes[c] for c in ("last_sequence", "last_time", "bucket_ns")])
        changes = {c: v[order] for c, v in changes.items()}
        bucket, time = changes["bucket_ns"], changes["last_time"]
        starts = np.flatnonzero(np.diff(bucket, prepend=bucket[0] - 1))
        # Rows are in order of their last event, so the last one has the bucket's latest names.
        ends = np.append(starts[1:], len(bucket)) - 1
        first, last = np.minimum.reduceat(changes["first_time"], starts), time[ends]
        silent = np.zeros(len(starts), bool)
        silent[1:] = first[1:] - last[:-1] >= self.idle_ns
        if self.last is not None:
            silent[0] = first[0] - self.last >= self.idle_ns
        self.last = int(last[-1])
        bids, asks = [], []
        sides, prices = changes["side_sign"].tolist(), changes["level_price"].tolist()
        totals, lows = changes["total"].tolist(), changes["low"].tolist()
        for at, end, restart in zip(starts.tolist(), ends.tolist(), silent.tolist()):
            if restart:
                self.index = LevelIndex()
            for i in range(at, end + 1):
                if sides[i]:
                    self.index.apply((sides[i], prices[i]), totals[i], lows[i])
            bids.append(self.index.best(1))
            asks.append(self.index.best(-1))
        if silent.any():
            self.trades = None
        self._add_trades(changes, int(starts[np.flatnonzero(silent)[-1]]) if silent.any() else 0)
        return {
            "bucket_ns": bucket[starts],
            **{c: changes[c][ends] for c in ("underlier", "instrument_type")},
            **{c: np.add.reduceat(changes[c], starts) for c in _MEASURES},
            "best_bid": np.array(bids, dtype=float),
            "best_ask": np.array(asks, dtype=float),
        }

    def _add_trades(self, changes: dict[str, np.ndarray], since: int) -> None:
        """Last trade price and size, and volume since the contract was last silent."""
        traded = since + np.flatnonzero(changes["trades"][since:])
        if not len(traded):
            return
        last = traded[np.lexsort((changes["trade_sequence"][traded], changes["trade_time"][traded]))[-1]]
        volume = (self.trades[2] if self.trades else 0) + int(changes["trade_volume"][traded].sum())
        self.trades = (float(changes["trade_price"][last]), int(changes["trade_size"][last]), volume)


def _frame(schema: T.StructType, n: int, **columns) -> pd.DataFrame:
    """So many rows in schema order; a column that is not given is null."""
    return pd.DataFrame(
        {f.name: columns[f.name] if f.name in columns else np.full(n, None, object) for f in schema},
        index=range(n), copy=False,
    )


def book_stream(
    df: DataFrame,
    *,
    delay: str = DELAY,
    width_ns: int = BAR_NS,
    idle_ms: int = IDLE_MS,
    shards: int = SHARDS,
) -> DataFrame:
    """Bars with the book's top at their end, and late events, from normalised events.

    The only clock is event time. A bucket's events wait in state until the watermark, ``delay``
    behind the latest event of earlier micro-batches, has passed the bucket's end; then they are
    applied in order. So disorder within ``delay`` changes nothing, wherever micro-batches end.
    Events of a bucket that the watermark has already passed come out as late, with all that is
    needed to apply them again. A contract that stays silent for ``idle_ms`` loses its state;
    buckets must be shorter than that, so that silence falls between them.

    Events are packed per contract and shard before the shuffle, in the tasks that read them. A
    shard is a hash of the level, and of the event where it leaves the book alone. Rows without
    contract or event time are dropped. A missing sequence or size counts as zero.
    """
    if width_ns >= idle_ms * MS_NS:
        raise ValueError("width_ns must be shorter than idle_ms")
    whole = [F.coalesce(c, F.lit(0)).alias(c) for c in ("sequence", "size")]
    delta = F.coalesce(book_delta(), F.lit(0))
    plain = ["underlier", "instrument_type", "event_time", "order_id", "action", "side",
             F.col("price").cast("double").alias("price"),
             F.coalesce("side_sign", F.lit(0)).cast("int").alias("side_sign")]
    level = F.xxhash64(
        *[F.when(delta != 0, F.col(c)) for c in ("side_sign", "price")], F.when(delta == 0, F.col("event_time"))
    )
    events = df.where(F.col("contract_id").isNotNull() & F.col("event_time").isNotNull()).select(
        "contract_id",
        F.pmod(level, F.lit(shards)).cast("int").alias("shard"),
        ns_to_timestamp("event_time").alias(CLOCK),
        *plain,
        *whole,
        delta.alias("delta"),
        is_trade().alias("is_trade"),
    )
    layout = f"contract_id STRING, shard INT, {CLOCK} TIMESTAMP, {ROWS} BINARY"
    packed = events.mapInArrow(packer(["contract_id", "shard"]), layout).withWatermark(CLOCK, delay)
    changes = (
        packed.where(F.col(CLOCK).isNull())
        .groupBy("contract_id", "shard")
        .transformWithStateInPandas(
            _LevelProcessor(width_ns),
            outputStructType=_LevelProcessor.OUTPUT,
            outputMode="append",
            timeMode="EventTime",
            eventTimeColumnName="clock",
        )
    )
    return changes.groupBy("contract_id").transformWithStateInPandas(
        _BookProcessor(idle_ms),
        outputStructType=_BookProcessor.OUTPUT,
        outputMode="append",
        timeMode="EventTime",
    )


def stream_primitives(book: DataFrame) -> DataFrame:
    """The bars of ``book_stream`` in the layout of the streaming feature table."""
    buy, sell = F.col("buy_size"), F.col("sell_size")
    bid, ask = F.col("best_bid"), F.col("best_ask")
    sided: Column = buy + sell
    return (
        book.where(F.col("kind") == BAR)
        .withColumns(
            {
                "bucket_ts": ns_to_timestamp("bucket_ns"),
                "session_date": local_day("bucket_ns"),
                "vwap": F.when(F.col("size_total") > 0, F.col("notional") / F.col("size_total")),
                "ofi": buy - sell,
                "ofi_ratio": F.when(sided > 0, (buy - sell) / sided).otherwise(F.lit(0.0)),
                "mid": (ask + bid) / 2.0,
                "spread": ask - bid,
            }
        )
        .select(*STREAM_BAR.fieldNames())
    )


def late_rows(book: DataFrame) -> DataFrame:
    """Late events, with what it takes to apply them again."""
    return book.where(F.col("kind") == LATE).select(
        "contract_id", "underlier", "instrument_type", *LATE_EVENT
    )
