"""Streaming operators over files that arrive one per micro-batch."""

import random
import time
from datetime import datetime, timedelta, timezone

import pytest
from events import SECOND, T0, events
from pyspark.sql import functions as F

from tickloom.operators import book
from tickloom.operators.bars import bars, feature_primitives, normalize, stream_bars
from tickloom.operators.scoring import LinearScorer
from tickloom.plans import stream
from tickloom.schemas import BROKER
from tickloom.sources import (
    append_batches,
    append_stream,
    fan_out,
    finish,
    read_batches,
    table_stream,
)
from tickloom.streaming.ingest import dedup_stream
from tickloom.streaming.book import book_stream, late_rows, stream_primitives
from tickloom.streaming.gold import gold_stream
from tickloom.streaming.late import bars_with_late, dedup_with_late
from tickloom.streaming.levels import LevelIndex
from tickloom.streaming.packs import unpack
from tickloom.streaming.replay import closing_row
from tickloom.streaming.settings import stateful_session
from tickloom.streaming.state import state_variable

TIMEOUT = 120


class Replay:
    """Appends batches to a folder and runs a query over what is new, from one checkpoint."""

    def __init__(self, spark, root):
        self.spark, self.session = spark, stateful_session(spark, 2)
        self.source, self.out = f"{root}/source", f"{root}/out"
        self.mark = f"{root}/mark"

    def add(self, df):
        df.coalesce(1).write.mode("append").parquet(self.source)

    def stream(self):
        return table_stream(self.session, self.source, max_files=1)

    def run(self, make):
        finish(append_stream(make(self.stream()), self.out, self.mark), TIMEOUT)
        return self.spark.read.parquet(self.out)


@pytest.fixture
def replay(spark, tmp_path):
    return Replay(spark, str(tmp_path))


def timed(df, clock="event_time"):
    return df.withColumn("enqueued_time", F.timestamp_micros(F.floor(F.col(clock) / 1000)))


def test_duplicates_inside_and_outside_the_watermark(spark, replay):
    def at(minutes):
        row = {"order_id": 1, "ingest_time": T0 + minutes * 60 * SECOND}
        return timed(events(spark, [row]), "ingest_time")

    for minutes in (0, 5):
        replay.add(at(minutes))
    assert replay.run(dedup_stream).count() == 1
    # The key is forgotten once the watermark has passed it, so a far later copy is new.
    replay.add(timed(events(spark, [{"order_id": 2, "ingest_time": T0 + 7200 * SECOND}]), "ingest_time"))
    replay.run(dedup_stream)
    replay.add(at(130))
    assert replay.run(dedup_stream).where("order_id = 1").count() == 2


def rows_over(minutes, step=7):
    sides, actions = "BSN", "AACT"
    return [
        {
            "event_time": T0 + i * step * SECOND,
            "contract_id": f"C{i % 3}",
            "side": sides[i % 7 % 3],
            "action": actions[i % 11 % 4],
            "price": 100.0 + i % 5,
            "size": 1 + i % 4,
        }
        for i in range(minutes * 60 // step)
    ]


def halves(spark, rows, at):
    for part in (rows[:at], rows[at:]):
        yield timed(events(spark, rows).where(F.col("sequence").isin([r["sequence"] for r in part])))


def numbered(rows):
    return [{**r, "sequence": i} for i, r in enumerate(rows)]


def test_streamed_bars_equal_batch_bars(spark, replay):
    rows = numbered(rows_over(6))
    for part in halves(spark, rows, 20):
        replay.add(part)
    replay.add(closing_row(timed(events(spark, rows))))
    found = replay.run(lambda s: stream_bars(normalize(s))).where("contract_id <> '__end__'")
    want = bars(normalize(events(spark, rows)))
    assert sorted(map(tuple, found.select(want.columns).collect())) == sorted(
        map(tuple, want.collect())
    )


@pytest.mark.parametrize("cut", [1, 23])
def test_streamed_book_equals_batch_book_wherever_batches_end(spark, replay, cut):
    rows = numbered(rows_over(6, step=3))
    for part in halves(spark, rows, cut):
        replay.add(part)
    replay.add(closing_row(timed(events(spark, rows))))
    found = replay.run(lambda s: stream_primitives(book_stream(normalize(s))))
    norm = normalize(events(spark, rows))
    want = book.book_top(norm).join(
        bars(norm).drop("best_bid", "best_ask", "mid", "spread"), ["contract_id", "bucket_ns"]
    )
    columns = ["contract_id", "bucket_ns", "best_bid", "best_ask", "mid", "spread", "event_count",
               "buy_size", "sell_size", "vwap", "ofi"]
    assert sorted(map(str, found.select(columns).collect())) == sorted(
        map(str, want.select(columns).collect())
    )


@pytest.mark.parametrize("parts", [2, 3])
def test_book_takes_back_disorder_within_the_delay(spark, replay, parts):
    rows = numbered(rows_over(6, step=3))
    for at in range(parts):  # each part spans the whole time
        replay.add(events(spark, rows).where(F.col("sequence") % parts == at))
    replay.add(closing_row(events(spark, rows)))
    found = replay.run(lambda s: book_stream(normalize(s)))
    assert found.where("kind = 'late'").count() == 0
    norm = normalize(events(spark, rows))
    want = book.book_top(norm).join(bars(norm).select("contract_id", "bucket_ns", "event_count"),
                                    ["contract_id", "bucket_ns"])
    columns = ["contract_id", "bucket_ns", "best_bid", "best_ask", "event_count"]
    assert sorted(map(str, found.select(columns).collect())) == sorted(
        map(str, want.select(columns).collect())
    )


def test_events_behind_the_watermark_come_out_whole_as_late(spark, replay):
    replay.add(events(spark, [{"event_time": T0 + 3600 * SECOND}]))
    late = [{"event_time": T0, "sequence": 9, "price": 60.0, "size": 7}]
    replay.add(events(spark, [*late, {"event_time": T0 + 3100 * SECOND}]))
    replay.add(closing_row(events(spark, late)))
    found = replay.run(lambda s: book_stream(normalize(s)))
    assert found.where("kind = 'bar'").agg(F.sum("event_count")).first()[0] == 2
    row = late_rows(found).first()
    assert (row["event_time"], row["sequence"], row["price"], row["size"]) == (T0, 9, 60.0, 7)
    assert late_rows(found).count() == 1


def test_lagging_arrival_does_not_wipe_the_book(spark, replay):
    def at(seconds, price, contract="C1"):
        rows = [{"event_time": T0 + seconds * SECOND, "price": price, "contract_id": contract}]
        stamp = F.timestamp_micros(F.floor(F.col("event_time") / 1000)) + F.expr("INTERVAL 1 DAY")
        return events(spark, rows).withColumn("enqueued_time", stamp)

    for part in (at(0, 99.0), at(5, 1.0, "C2"), at(10, 1.0, "C2"), at(15, 40.0)):
        replay.add(part)
    replay.add(closing_row(at(0, 1.0)))
    found = replay.run(lambda s: stream_primitives(book_stream(normalize(s))))
    last = found.where("contract_id = 'C1'").orderBy(F.desc("bucket_ns")).first()
    assert last["best_bid"] == 99.0


def test_old_dead_letters_are_kept(spark, tmp_path):
    root, start = str(tmp_path), datetime(2024, 1, 2, tzinfo=timezone.utc)
    body = events(spark, [{}]).select(F.to_json(F.struct("*"))).first()[0].encode()
    old = start - timedelta(days=1)
    for row in [(body, start, 0, 0), (body, start, 1, 0), (b"broken", old, 2, 0)]:
        spark.createDataFrame([row], BROKER).coalesce(1).write.mode("append").parquet(f"{root}/in")
    source = table_stream(stateful_session(spark, 2), f"{root}/in", max_files=1)
    finish(stream.broker_to_bronze(source, f"{root}/ok", f"{root}/dead", f"{root}/mark"), TIMEOUT)
    assert read_batches(spark, f"{root}/ok").count() == 1
    assert read_batches(spark, f"{root}/dead").select("source_offset").first()[0] == "2"


def test_bars_far_behind_still_give_vectors(spark, replay):
    def part(at):
        rows = [{"event_time": T0 + at * SECOND, "price": 50.0}]
        return feature_primitives(bars(normalize(events(spark, rows))))

    for at in (3600, 7200, 0):
        replay.add(part(at))
    assert replay.run(gold_stream).count() == 3


def test_silent_contract_starts_again_empty(spark, replay):
    pause = 700 * SECOND
    rows = [
        {"event_time": T0, "price": 50.0},
        {"event_time": T0 + 60 * SECOND, "price": 40.0},
        {"event_time": T0 + 60 * SECOND + pause, "price": 30.0},
    ]
    replay.add(timed(events(spark, rows)))
    replay.add(closing_row(timed(events(spark, rows))))
    found = replay.run(lambda s: stream_primitives(book_stream(normalize(s)))).orderBy("bucket_ns")
    assert [r["best_bid"] for r in found.collect()] == [50.0, 50.0, 30.0]


def test_state_is_dropped_when_the_watermark_passes_the_idle_time(spark, replay):
    make = lambda s: stream_primitives(book_stream(normalize(s)))
    replay.add(timed(events(spark, [{"event_time": T0, "price": 50.0}])))
    replay.add(timed(events(spark, [{"event_time": T0 + 7200 * SECOND, "contract_id": "C2"}])))
    replay.run(make)

    def contracts(name):
        return {r["contract_id"] for r in state_variable(spark, replay.mark, name).collect()}

    assert contracts("levels") == contracts("last") == set()  # C1 is past its idle time
    assert contracts("packs") == contracts("held") == {"C2"}


def test_gold_stream_carries_the_last_mid_over_batches(spark, replay):
    def part(rows):
        return feature_primitives(bars(normalize(events(spark, rows))))

    quotes = [
        {"event_time": T0 + i * 5 * SECOND, "side": side, "price": price}
        for i, mid in enumerate([100.0, 101.0, 103.0, 102.0])
        for side, price in (("B", mid - 1), ("S", mid + 1))
    ]
    replay.add(part(quotes[:4]))
    replay.add(part(quotes[4:]))
    found = replay.run(gold_stream).orderBy("vector_time").collect()
    assert [r["mid_change"] for r in found] == [0.0, 1.0, 2.0, -1.0]
    assert [r["feature_vector"][2] for r in found] == [0.0, 1.0, 2.0, -1.0]
    assert {r["model_id"] for r in found} == {"ES_MODEL"}


def test_replayed_batch_replaces_itself(spark, tmp_path):
    sink = append_batches(str(tmp_path / "t"), ["id"])
    for _ in range(2):
        sink(spark.range(3), 0)
    sink(spark.range(3, 5), 1)
    assert sorted(r["id"] for r in read_batches(spark, str(tmp_path / "t")).collect()) == list(range(5))


def test_fan_out_computes_a_batch_once_for_all_sinks(spark, replay):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        calls.add(1)
        return x

    replay.add(spark.range(10))
    sinks = [append_batches(f"{replay.out}{i}") for i in range(3)]
    finish(fan_out(replay.stream().withColumn("y", counted("id")), sinks, replay.mark), TIMEOUT)
    assert calls.value == 10
    assert [read_batches(spark, f"{replay.out}{i}").count() for i in range(3)] == [10] * 3


def test_streaming_jobs_chain(spark, tmp_path):
    """Broker rows through bronze, silver and gold to scores, each job with two sinks."""
    rows = numbered(rows_over(3))
    root = str(tmp_path)
    start = datetime(2024, 1, 1, 18, tzinfo=timezone.utc)
    bodies = [r["value"] for r in events(spark, rows).select(F.to_json(F.struct("*")).alias("value")).collect()]
    data = [(b.encode(), start + timedelta(seconds=i), i, 0) for i, b in enumerate(bodies)]
    data += [(b"broken", start, 1000, 0), (b"broken", start, 1001, 0), data[0]]
    spark.createDataFrame(data, BROKER).coalesce(1).write.parquet(f"{root}/topic")
    session = stateful_session(spark, 2)
    broker = table_stream(session, f"{root}/topic")
    finish(stream.broker_to_bronze(broker, f"{root}/bronze", f"{root}/dead", f"{root}/m1"), TIMEOUT)
    bronze = read_batches(spark, f"{root}/bronze")
    assert bronze.count() == len(rows)
    assert read_batches(spark, f"{root}/dead").count() == 2
    closed = bronze.unionByName(closing_row(bronze))
    closed.write.parquet(f"{root}/bronze2")
    source = table_stream(session, f"{root}/bronze2")
    finish(stream.bronze_to_silver(source, f"{root}/silver", f"{root}/late", f"{root}/m2"), TIMEOUT)
    silver = read_batches(spark, f"{root}/silver")
    n = bars(normalize(events(spark, rows))).count()
    assert silver.where("contract_id <> '__end__'").count() == n
    silver.where("contract_id <> '__end__'").write.parquet(f"{root}/silver2")
    source = table_stream(session, f"{root}/silver2")
    finish(stream.silver_to_gold(source, f"{root}/gold", f"{root}/out1", f"{root}/m3"), TIMEOUT)
    gold = read_batches(spark, f"{root}/gold")
    assert gold.count() == n == spark.read.text(f"{root}/out1").count()
    gold.write.parquet(f"{root}/gold2")
    source = table_stream(session, f"{root}/gold2")
    finish(
        stream.gold_to_scores(
            source, lambda: LinearScorer([0.1] * 5), f"{root}/scores", f"{root}/out2", f"{root}/m4"
        ),
        TIMEOUT,
    )
    assert read_batches(spark, f"{root}/scores").where("prediction >= 0").count() == n
    message = spark.read.text(f"{root}/out2").first()["value"]
    assert message.startswith('{"contract_id":"C')


@pytest.mark.parametrize("n", [1_000, 10_000])
def test_level_index_equals_a_scan(n):
    rng = random.Random(n)
    index, sizes = LevelIndex((side, float(p), 1) for p in range(n // 2) for side in (1, -1)), {}
    sizes.update({(side, float(p)): 1 for p in range(n // 2) for side in (1, -1)})
    for step in range(2_000):
        level = (rng.choice([1, -1]), float(rng.randrange(n)))
        total = rng.choice([-5, -1, 2, 9])
        low = min(total, rng.choice([0, -3]))
        index.apply(level, total, low)
        size = sizes.get(level, 0)
        size += total - min(0, size + low)
        sizes[level] = size
        if step % 50 == 0:
            live = [k for k, v in sizes.items() if v > 0]
            assert index.best(1) == max(p for s, p in live if s == 1)
            assert index.best(-1) == min(p for s, p in live if s == -1)
    assert {(s, p): v for s, p, v in index.rows()} == {k: v for k, v in sizes.items() if v > 0}
    again = LevelIndex(index.rows())
    assert (again.best(1), again.best(-1)) == (index.best(1), index.best(-1))


def test_level_index_takes_no_scan_for_a_bar():
    """Ten thousand bars, each taking away the best of ten thousand bids and adding a better one."""
    def steps(levels):
        index = LevelIndex((1, float(p), 1) for p in range(levels))
        seen = CountedDict(index.sizes)
        index.sizes = seen
        for bar in range(10_000):
            index.apply((1, index.best(1)), -1, -1)
            index.apply((1, float(levels + bar)), 1, 0)
            assert index.best(1) == levels + bar
        return seen.lookups

    # A scan would look at every level for every bar.
    assert steps(10_000) < 10_000 * 20
    assert steps(10_000) < 2 * steps(1_000)


class CountedDict(dict):
    lookups = 0

    def __contains__(self, key):
        self.lookups += 1
        return super().__contains__(key)


def test_a_busy_contract_spreads_over_tasks(spark, replay):
    """Nine tenths of the events are of one contract; its levels are held by all partitions alike."""
    rows = [
        {
            "event_time": T0 + i * SECOND // 10, "sequence": i, "price": 100.0 + i % 90, "side": "BS"[i % 2],
            "contract_id": "BUSY" if i % 10 else f"C{i % 70}",
        }
        for i in range(4_000)
    ]
    replay.session.conf.set("spark.sql.shuffle.partitions", "4")
    replay.add(events(spark, rows))
    replay.run(lambda s: book_stream(normalize(s), shards=32))
    packs = state_variable(spark, replay.mark, "packs").select("partition_id", "events").collect()
    held = {}
    for r in packs:
        held[r["partition_id"]] = held.get(r["partition_id"], 0) + unpack([bytes(r["events"])]).num_rows
    assert sum(held.values()) == 4_000 and len(held) == 4
    assert max(held.values()) <= 3 * sorted(held.values())[1]


def test_gold_state_expires_on_the_wall_clock(spark, replay):
    def part(contract):
        rows = [{"event_time": T0, "price": 50.0, "contract_id": contract}]
        return feature_primitives(bars(normalize(events(spark, rows))))

    replay.session = stateful_session(spark, 2, idle_batches=False)
    make = lambda s: gold_stream(s, ttl_ms=1_500)

    def contracts():
        return {r["contract_id"] for r in state_variable(spark, replay.mark, "last").collect()}

    replay.add(part("C1"))
    replay.run(make)
    assert contracts() == {"C1"}
    time.sleep(2)
    replay.add(part("C1").limit(0))  # a micro-batch without a row of any contract
    assert replay.run(make).count() == 1
    assert contracts() == set()


def test_rows_behind_the_watermark_stay_whole_beside_native_operators(spark, replay):
    def at(seconds, n):
        return timed(events(spark, [{"event_time": T0 + seconds * SECOND, "sequence": n, "order_id": n}]))

    for part in (at(0, 1), at(3603, 2), at(1, 3).unionByName(at(1, 3)).unionByName(at(3001, 4)), at(2, 5)):
        replay.add(part)
    replay.add(closing_row(at(0, 0)))
    found = replay.run(lambda s: bars_with_late(normalize(s))).where("contract_id <> '__end__'")
    late = found.where("late is not null").select("late.*")
    assert sorted(r["order_id"] for r in late.collect()) == [3, 3, 5]
    assert late.first().asDict().keys() >= {"event_time", "price", "size", "payload", "event_ts"}
    kept = found.where("late is null").agg(F.sum("event_count")).first()[0]
    assert kept == 3


def test_a_missing_clock_is_late_and_not_lost(spark, replay):
    rows = timed(events(spark, [{"order_id": 1}, {"order_id": 1}, {"order_id": 2}]))
    replay.add(rows.withColumn("enqueued_time", F.when(F.col("order_id") == 1, F.col("enqueued_time"))))
    found = replay.run(lambda s: dedup_with_late(s, ["order_id"]))
    assert sorted((r["order_id"], r["late_row"] is not None) for r in found.collect()) == [(1, False), (2, True)]
