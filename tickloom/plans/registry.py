"""Every operator as a query over the given tables.

Timestamps come out as UTC wall clock (``TIMESTAMP_NTZ``) and vectors as plain columns, so that a
result reads the same in any engine and session zone.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import fixtures as fx
from tickloom.functions.clock import SECOND_NS, local_day, ns_to_local, ns_to_utc
from tickloom.functions.vectors import feature_vector as vector_of
from tickloom.operators import bars as b
from tickloom.operators import book, features, ingest, scoring, training
from tickloom.operators.guards import guard_nonempty, guard_training_set, optional_columns
from tickloom.plans import batch, stream
from tickloom.schemas import ENVELOPE_COLUMNS, SCORE_MESSAGE, SERIES_KEYS, VECTOR_MESSAGE
from tickloom.sources import (
    Slice,
    append_batches,
    append_stream,
    append_table,
    decode_envelope,
    export_snapshot,
    fan_out,
    finish,
    follow_batches,
    publish_batches,
    publish_slice,
    raw_to_envelope,
    read_batches,
    read_published,
    read_segments,
    read_slice,
    replace_slice,
    shared_dir,
    table_stream,
    write_segments,
)
from tickloom.sources.records import payload_json
from tickloom.streaming.ingest import dedup_decoded
from tickloom.streaming.late import LATE_ROW, bars_with_late, dedup_with_late
from tickloom.streaming.book import book_stream, late_rows, stream_primitives
from tickloom.streaming.gold import gold_stream
from tickloom.streaming.replay import FAR_FUTURE_KEY, stage
from tickloom.streaming.settings import stateful_session
from tickloom.streaming.state import book_levels as stored_levels

Query = Callable[[SparkSession, str], DataFrame]

TIMEOUT_S = 900
FIRST_DAY = Slice("2024-01-01", "SYN", "FUT")
MID_DAY = Slice("2024-01-15", "SYN", "FUT")
RAW = {"venue": "SYNTH", "underlier": "SYN", "instrument_type": "FUT", "price_scale": 1e9}
WEIGHTS = [0.8, -0.05, 0.1, 0.0005, -0.2]
BIAS = -1.5
RIDGE = 0.01
HOUR_NS = 3600 * SECOND_NS

_REGISTRY: dict[str, Query] = {}


def _query(f: Query) -> Query:
    """Register under the function's name; ``_q`` ends a name that an import already has."""
    _REGISTRY[f.__name__.removesuffix("_q")] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.normalize(fx.mbo(spark, sf_dir))


def _bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.bars(_norm(spark, sf_dir))


def _primitives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.feature_primitives(_bars(spark, sf_dir))


def _plain_time(df: DataFrame) -> DataFrame:
    return df.withColumn("bucket_ts", ns_to_utc("bucket_ns"))


def _plain_vector(df: DataFrame, size: int = 5) -> DataFrame:
    parts = {f"f{i}": F.col("feature_vector")[i] for i in range(size)}
    return df.withColumns(parts).drop("feature_vector")


def _utc_wall(instant: str) -> F.Column:
    return ns_to_utc(F.unix_micros(instant) * 1000)




# Sources


@_query
def src_envelope_decode(spark, sf_dir):
    decoded = decode_envelope(fx.broker_rows(spark, sf_dir))
    return ingest.valid_rows(decoded).withColumn("enqueued_time", _utc_wall("enqueued_time"))


@_query
def src_table_stream(spark, sf_dir):
    source = stage(fx.mbo(spark, sf_dir), "event_time")
    out, mark = shared_dir(spark, "out"), shared_dir(spark, "checkpoint")
    rows = source.stream(spark).select("contract_id", "event_time", "size")
    finish(append_stream(rows, out, mark), TIMEOUT_S)
    return spark.read.parquet(out)


@_query
def src_offsets_stream(spark, sf_dir):
    """Broker segments from the earliest offset with a cap, and from the latest one on.

    The batch numbers show the cap; the other stream begins when only half of the offsets are there.
    """
    broker = fx.broker_rows(spark, sf_dir).drop("key", "topic")
    count = broker.count()
    root, share = shared_dir(spark, "segments"), -(-count // 6)
    early, late = F.col("offset") < count // 2, F.col("offset") >= count // 2
    outs = {"earliest": shared_dir(spark, "out"), "latest": shared_dir(spark, "out")}

    def started(mode: str, **options):
        rows = read_segments(spark, root, starting_offsets=mode, **options)
        return fan_out(rows, [append_batches(outs[mode])], shared_dir(spark, "checkpoint"), every="0 seconds")

    write_segments(broker.where(early), root, count // 8)
    follower = started("latest")
    follower.processAllAvailable()
    write_segments(broker.where(late), root, count // 8)
    follower.processAllAvailable()
    follower.stop()
    capped = started("earliest", max_offsets=4 * share, position=shared_dir(spark, "position"))
    capped.processAllAvailable()
    capped.stop()
    first, second = (
        spark.read.parquet(outs[mode]).select(
            F.lit(mode).alias("mode"), "partition", "offset", F.length("value").alias("value_bytes"),
            _utc_wall("timestamp").alias("timestamp"), batch.cast("int").alias("batch"),
        )
        for mode, batch in (("earliest", F.col("batch_id")), ("latest", F.lit(None)))
    )
    return first.unionByName(second)


def _daily_table(spark: SparkSession, sf_dir: str) -> str:
    path = shared_dir(spark, "daily")
    daily = fx.mbo_daily(spark, sf_dir)
    daily.write.partitionBy("session_date", "underlier", "instrument_type").parquet(path)
    return path


@_query
def scan_partition(spark, sf_dir):
    rows = read_slice(spark, _daily_table(spark, sf_dir), MID_DAY)
    return rows.select(*ENVELOPE_COLUMNS, "session_date")


@_query
def scan_table(spark, sf_dir):
    name = f"tickloom_scan_{uuid.uuid4().hex}"
    append_table(fx.mbo(spark, sf_dir), name, shared_dir(spark, name))
    return spark.table(name)


@_query
def raw_to_envelope_q(spark, sf_dir):
    return raw_to_envelope(fx.raw_records(spark, sf_dir), session_date="2024-01-01", **RAW)


# Sinks


@_query
def sink_replace_slice(spark, sf_dir):
    path = _daily_table(spark, sf_dir)
    changed = read_slice(spark, path, MID_DAY).withColumn("size", F.col("size") + 1000)
    replace_slice(changed, path, MID_DAY)
    replace_slice(changed.limit(0), path, Slice("2024-01-16", "SYN", "FUT"))
    return spark.read.parquet(path).select(
        "order_id", "size", F.col("session_date").cast("string").alias("session_date")
    )


@_query
def sink_publish_slice(spark, sf_dir):
    """As ``sink_replace_slice``, by manifests."""
    root = shared_dir(spark, "published")
    rows = fx.mbo_daily(spark, sf_dir).where(F.col("session_date").isin("2024-01-14", "2024-01-15", "2024-01-16"))
    for day in ("2024-01-14", "2024-01-15", "2024-01-16"):
        publish_slice(rows.where(F.col("session_date") == day), root, Slice(day, "SYN", "FUT"))
    publish_slice(read_published(spark, root, MID_DAY).withColumn("size", F.col("size") + 1000), root, MID_DAY)
    publish_slice(rows.limit(0), root, Slice("2024-01-16", "SYN", "FUT"))
    return read_published(spark, root).select("order_id", "size", "session_date")


@_query
def sink_stream_append(spark, sf_dir):
    source = stage(fx.mbo(spark, sf_dir), "event_time")
    out, mark = shared_dir(spark, "out"), shared_dir(spark, "checkpoint")
    finish(append_stream(source.stream(spark), out, mark), TIMEOUT_S)
    # A second run from the same checkpoint finds nothing new.
    finish(append_stream(source.stream(spark), out, mark), TIMEOUT_S)
    return spark.read.parquet(out)


@_query
def export_snapshot_q(spark, sf_dir):
    root = shared_dir(spark, "datasets")
    rows = features.setup_vectors(_primitives(spark, sf_dir), canonical=True)
    for _ in range(2):  # the second export replaces the first
        path = export_snapshot(rows, root, "OTHER_MODEL", "2024-01-02")
    return _plain_vector(spark.read.parquet(path))


# Filters


@_query
def flt_record_type(spark, sf_dir):
    return ingest.record_type(fx.raw_records(spark, sf_dir)).select("order_id", "rtype")


@_query
def flt_symbol_present(spark, sf_dir):
    return ingest.symbol_present(fx.raw_records(spark, sf_dir)).select("order_id", "symbol")


@_query
def flt_outright(spark, sf_dir):
    return ingest.outright_only(fx.raw_records(spark, sf_dir)).select("order_id", "symbol")


@_query
def flt_session_window(spark, sf_dir):
    rows = ingest.session_window(fx.mbo(spark, sf_dir), "2024-01-01", "13:10", "13:30")
    return rows.select("order_id", "event_time")


@_query
def dlq_valid(spark, sf_dir):
    valid, _ = ingest.split_valid(decode_envelope(fx.broker_rows(spark, sf_dir)))
    return valid.select("order_id", "contract_id", "source_offset", "source_sequence")


@_query
def dlq_invalid(spark, sf_dir):
    _, dead = ingest.split_valid(decode_envelope(fx.broker_rows(spark, sf_dir)))
    return dead.drop("ingestion_timestamp")


@_query
def guard_nonempty_q(spark, sf_dir):
    return guard_nonempty(fx.mbo(spark, sf_dir), "bronze")


@_query
def guard_training_set_q(spark, sf_dir):
    rows = fx.mbo(spark, sf_dir).withColumn("label", (F.col("sequence") % 2).cast("int"))
    return guard_training_set(rows)


# Projections


@_query
def json_parse(spark, sf_dir):
    decoded = decode_envelope(fx.broker_rows(spark, sf_dir))
    return decoded.where(F.col("data.event_time").isNotNull()).select(
        *[f"data.{c}" for c in ENVELOPE_COLUMNS]
    )


@_query
def ns_to_ts(spark, sf_dir):
    return fx.mbo_daily(spark, sf_dir).select(
        "order_id", "event_time", ns_to_utc("event_time").alias("event_ts")
    )


@_query
def ts_to_local(spark, sf_dir):
    return fx.mbo_daily(spark, sf_dir).select(
        "order_id", ns_to_local("event_time").alias("event_ts_est")
    )


@_query
def session_date(spark, sf_dir):
    rows = fx.mbo_daily(spark, sf_dir).drop("session_date")
    return rows.select("order_id", local_day("event_time").alias("session_date"))


@_query
def side_sign(spark, sf_dir):
    return _norm(spark, sf_dir).select("order_id", "side", "side_sign")


@_query
def signed_size(spark, sf_dir):
    return _norm(spark, sf_dir).select("order_id", "signed_size")


@_query
def mbo_normalized(spark, sf_dir):
    return _norm(spark, sf_dir).withColumn("event_ts", ns_to_utc("event_time"))


@_query
def bucket_floor(spark, sf_dir):
    return _plain_time(b.with_bucket(fx.mbo_daily(spark, sf_dir))).select(
        "order_id", "bucket_ns", "bucket_ts"
    )


@_query
def payload_pack(spark, sf_dir):
    return fx.raw_records(spark, sf_dir).select("order_id", payload_json().alias("payload"))


@_query
def feature_vector(spark, sf_dir):
    rows = features.vectors(features.mid_change(_primitives(spark, sf_dir)))
    return _plain_vector(rows.select("contract_id", "bucket_ns", "feature_vector"))


@_query
def feature_hash(spark, sf_dir):
    rows = features.vectors(features.mid_change(_primitives(spark, sf_dir)))
    return features.hashes(rows, canonical=True).select("contract_id", "bucket_ns", "feature_hash")


@_query
def feature_hash_json(spark, sf_dir):
    """The default hash, over measures whose text is the same in any engine."""
    measures = ["event_count", "size_total", "ofi", "price_min", "spread"]
    rows = _bars(spark, sf_dir).withColumn("feature_vector", vector_of(measures))
    return features.hashes(rows).select("contract_id", "bucket_ns", "feature_hash")


@_query
def label_forward(spark, sf_dir):
    rows = features.forward_label(_primitives(spark, sf_dir))
    return rows.select("contract_id", "bucket_ns", "label")


@_query
def label_forward_strict(spark, sf_dir):
    rows = features.forward_label(_primitives(spark, sf_dir), by="time", strict=True)
    return rows.select("contract_id", "bucket_ns", "label")


@_query
def optional_columns_q(spark, sf_dir):
    rows = fx.mbo(spark, sf_dir).select("order_id", "venue")
    defaults = {"venue": F.lit("NONE"), "close_price": F.lit(None).cast("double"),
                "model_id": F.lit("ES_MODEL")}
    return optional_columns(rows, defaults)


# Bars


@_query
def bar_5s(spark, sf_dir):
    return _plain_time(_bars(spark, sf_dir))


@_query
def bar_1h_daily(spark, sf_dir):
    rows = b.normalize(fx.mbo_daily(spark, sf_dir))
    return _plain_time(b.bars(rows, width_ns=HOUR_NS))


@_query
def orderbook_state(spark, sf_dir):
    return _plain_time(b.orderbook_state(_bars(spark, sf_dir)))


@_query
def feature_primitives(spark, sf_dir):
    return _plain_time(_primitives(spark, sf_dir))


# Windows


@_query
def mid_change(spark, sf_dir):
    rows = features.mid_change(_primitives(spark, sf_dir))
    return rows.select("contract_id", "bucket_ns", "mid", "mid_change")


@_query
def mid_future(spark, sf_dir):
    rows = features.mid_future(_primitives(spark, sf_dir))
    return rows.select("contract_id", "bucket_ns", "mid_future")


@_query
def mid_future_time(spark, sf_dir):
    rows = features.mid_future(_primitives(spark, sf_dir), by="time")
    return rows.select("contract_id", "bucket_ns", "mid_future")


@_query
def setup_vectors(spark, sf_dir):
    return _plain_vector(features.setup_vectors(_primitives(spark, sf_dir), canonical=True))


@_query
def labels(spark, sf_dir):
    setup = features.setup_vectors(_primitives(spark, sf_dir), canonical=True)
    return features.labels(setup)


@_query
def global_row_number(spark, sf_dir):
    rows = training.training_rows(fx.mbo(spark, sf_dir))
    return rows.select("row_id", "label", "order_id", "price", "size")


# Order book


@_query
def level_deltas(spark, sf_dir):
    return book.level_deltas(_norm(spark, sf_dir))


@_query
def trade_stats(spark, sf_dir):
    return book.trade_stats(_norm(spark, sf_dir))


@_query
def book_levels(spark, sf_dir):
    return book.book_levels(_norm(spark, sf_dir))


@_query
def book_top(spark, sf_dir):
    return book.book_top(_norm(spark, sf_dir))


@_query
def book_snapshot(spark, sf_dir):
    return book.book_snapshot(_norm(spark, sf_dir))


@_query
def book_snapshot_at(spark, sf_dir):
    """The book half-way through the data."""
    rows = _norm(spark, sf_dir)
    low, high = rows.agg(F.min("event_time"), F.max("event_time")).first()
    return book.book_snapshot(rows, at_ns=(low + high) // 2)


@_query
def dedup_batch(spark, sf_dir):
    return ingest.dedup_batch(fx.with_duplicates(fx.mbo(spark, sf_dir)))


# Streams: the tables are staged as files and replayed as a bounded stream.


def _bronze_stream(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    rows = fx.mbo(spark, sf_dir).withColumn(
        "enqueued_time", F.timestamp_micros(F.call_function("div", "ingest_time", F.lit(1000)))
    )
    session = stateful_session(spark)
    return stage(rows, "event_time", **options).stream(session)


def _collect_stream(spark: SparkSession, rows: DataFrame) -> DataFrame:
    out, mark = shared_dir(spark, "out"), shared_dir(spark, "checkpoint")
    finish(append_stream(rows, out, mark), TIMEOUT_S)
    found = spark.read.parquet(out)
    return found.where(~F.col("contract_id").eqNullSafe(FAR_FUTURE_KEY))


@_query
def dedup_stream(spark, sf_dir):
    broker = fx.broker_rows(spark, sf_dir)
    twice = broker.unionByName(broker.where(F.col("offset") % 10 == 0))
    session = stateful_session(spark)
    source = stage(twice, "offset").stream(session)
    rows = ingest.valid_rows(dedup_decoded(decode_envelope(source)))
    out, mark = shared_dir(spark, "out"), shared_dir(spark, "checkpoint")
    finish(append_stream(rows, out, mark), TIMEOUT_S)
    return spark.read.parquet(out).select(*ENVELOPE_COLUMNS, "session_date", "source_sequence")


@_query
def stream_fanout(spark, sf_dir):
    session = stateful_session(spark)
    # Broken rows are a day old, far behind the watermark.
    broken = F.col("offset") % fx.BROKEN_EVERY == 0
    age = F.when(broken, F.expr("INTERVAL 1 DAY")).otherwise(F.expr("INTERVAL 0 DAY"))
    broker = fx.broker_rows(spark, sf_dir).withColumn("timestamp", F.col("timestamp") - age)
    source = stage(broker, "offset").stream(session)
    bronze, dead = shared_dir(spark, "bronze"), shared_dir(spark, "dead")
    mark = shared_dir(spark, "checkpoint")
    finish(stream.broker_to_bronze(source, bronze, dead, mark), TIMEOUT_S)
    kept = read_batches(spark, bronze).select(
        F.lit("bronze").alias("sink"), "source_offset", F.lit(None).cast("string").alias("reason")
    )
    lost = read_batches(spark, dead).select(
        F.lit("dead").alias("sink"), "source_offset", F.col("error_message").alias("reason")
    )
    return kept.unionByName(lost)


@_query
def fanout_handoff(spark, sf_dir):
    """A stream that follows a fan-out whose every micro-batch is run twice, as after a failure."""
    source = stage(fx.broker_rows(spark, sf_dir), "offset").stream(spark)
    root, out = shared_dir(spark, "published"), shared_dir(spark, "followed")
    publish = publish_batches(root)
    sinks = [lambda batch, batch_id: publish(ingest.valid_rows(batch), batch_id)] * 2
    finish(fan_out(decode_envelope(source), sinks, shared_dir(spark, "checkpoint")), TIMEOUT_S)
    finish(follow_batches(spark, root, append_batches(out), shared_dir(spark, "checkpoint"), max_batches=2), TIMEOUT_S)
    return read_batches(spark, out).select(*ENVELOPE_COLUMNS, "session_date", "source_sequence")


@_query
def bar_stream(spark, sf_dir):
    rows = b.normalize(_bronze_stream(spark, sf_dir, closing=True))
    return _plain_time(_collect_stream(spark, b.stream_bars(rows)))


def _plain_book(rows: DataFrame) -> DataFrame:
    return _plain_time(rows).select(
        *SERIES_KEYS, "bucket_ns", "bucket_ts", "event_count", "size_total", "buy_size",
        "sell_size", "vwap", "ofi", "ofi_ratio", "mid", "spread", "best_bid", "best_ask",
    )


@_query
def book_stream_q(spark, sf_dir):
    rows = b.normalize(_bronze_stream(spark, sf_dir, closing=True))
    return _plain_book(_collect_stream(spark, stream_primitives(book_stream(rows))))


@_query
def book_stream_unordered(spark, sf_dir):
    """Events arrive up to 400 seconds late and so in other micro-batches than their neighbours."""
    lag = F.col("order_id") % 3 * 200 * SECOND_NS
    rows = fx.mbo(spark, sf_dir).withColumn("arrival", F.col("event_time") + lag)
    session = stateful_session(spark)
    source = stage(rows, "arrival", closing=True).stream(session)
    found = _collect_stream(spark, stream_primitives(book_stream(b.normalize(source))))
    return _plain_book(found)


@_query
def late_rows_q(spark, sf_dir):
    """Four turns over the whole time span; what the ones before left over ten minutes behind."""
    rows = fx.mbo(spark, sf_dir).withColumn("turn", F.col("order_id") % 4)
    session = stateful_session(spark)
    source = stage(rows, "turn").stream(session)
    return _collect_stream(spark, late_rows(book_stream(b.normalize(source))))


@_query
def book_state_snapshot(spark, sf_dir):
    """The live levels that the book stream holds in its state store after its last micro-batch."""
    out, mark = shared_dir(spark, "out"), shared_dir(spark, "checkpoint")
    finish(append_stream(book_stream(b.normalize(_bronze_stream(spark, sf_dir))), out, mark), TIMEOUT_S)
    return stored_levels(spark, mark)


def _in_turns(spark: SparkSession, rows: DataFrame, number: str, **options) -> DataFrame:
    """Four turns over the whole time span, a micro-batch each."""
    turns = rows.withColumn("turn", F.col(number) % 4)
    return stage(turns, "turn", **options).stream(stateful_session(spark))


@_query
def dedup_late(spark, sf_dir):
    """Every tenth message twice: kept once where it is on time, each copy where it is late."""
    broker = fx.broker_rows(spark, sf_dir)
    twice = broker.unionByName(broker.where(F.col("offset") % 10 == 0))
    source = _in_turns(spark, twice, "offset")
    out, mark = shared_dir(spark, "out"), shared_dir(spark, "checkpoint")
    kept = dedup_with_late(source, ["partition", "offset"], clock="timestamp")
    finish(append_stream(kept, out, mark), TIMEOUT_S)
    return spark.read.parquet(out).select(
        "partition", "offset", F.length("value").alias("value_bytes"), _utc_wall("timestamp").alias("timestamp"),
        F.col(LATE_ROW).isNotNull().alias("late"),
    )


@_query
def bar_late(spark, sf_dir):
    """Bars of the events on time, and each late event as it came."""
    rows = _in_turns(spark, fx.mbo(spark, sf_dir), "order_id", closing=True)
    found = _collect_stream(spark, bars_with_late(b.normalize(rows)))
    late = F.col("late.order_id").isNotNull()
    measures = ["event_count", "size_total", "notional", "price_last", "best_bid", "best_ask"]
    # A late event's window is that of its stand-in clock; its own time is in the event.
    bucket = F.when(late, F.col("late.event_time")).otherwise(F.col("bucket_ns"))
    return found.select(
        "contract_id", bucket.alias("bucket_ns"), *measures,
        "late.order_id", "late.action", F.col("late.size").alias("late_size"),
    )


@_query
def state_expiry(spark, sf_dir):
    """Every contract pauses for an hour half-way; its book starts again empty."""
    rows = fx.mbo(spark, sf_dir)
    half = rows.agg(((F.min("event_time") + F.max("event_time")) / 2).cast("long")).scalar()
    shifted = F.col("event_time") + F.when(F.col("event_time") > half, HOUR_NS).otherwise(0)
    rows = rows.withColumn("event_time", shifted)
    session = stateful_session(spark)
    source = stage(rows, "event_time", closing=True).stream(session)
    found = _collect_stream(spark, stream_primitives(book_stream(b.normalize(source))))
    return found.select("contract_id", "bucket_ns", "event_count", "best_bid", "best_ask")


def _bar_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    session = stateful_session(spark)
    return stage(_primitives(spark, sf_dir), "bucket_ns").stream(session)


@_query
def gold_stream_q(spark, sf_dir):
    found = _collect_stream(spark, gold_stream(_bar_source(spark, sf_dir)))
    return _plain_vector(found.drop("gold_ingest_time"))


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch twin of the streamed vectors."""
    rows = features.vectors(features.mid_change(_primitives(spark, sf_dir), first=0.0))
    return rows.withColumnRenamed("bucket_ns", "vector_time").withColumn(
        "model_id", F.lit("ES_MODEL")
    )


@_query
def msg_gold_json(spark, sf_dir):
    """Messages of the gold stream, read back field by field from the message sink."""
    vectors, topic = shared_dir(spark, "vectors"), shared_dir(spark, "topic")
    mark = shared_dir(spark, "checkpoint")
    finish(stream.silver_to_gold(_bar_source(spark, sf_dir), vectors, topic, mark), TIMEOUT_S)
    fields = _gold(spark, sf_dir).select(*VECTOR_MESSAGE).schema
    sent = spark.read.text(topic).select(F.from_json("value", fields).alias("m"))
    return sent.select("m.*")


# Scoring and models


def _scorer():
    return scoring.LinearScorer(WEIGHTS, BIAS)


def _score_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some vectors are missing."""
    present = F.when(F.col("event_count") != 3, F.col("feature_vector"))
    return _gold(spark, sf_dir).withColumn("feature_vector", present)


_SCORES = ["contract_id", "vector_time", "session_date", "model_id", "close_price", "prediction",
           "inference_error", "model_version"]


def _plain_scores(df: DataFrame) -> DataFrame:
    return df.select(*_SCORES, *[F.round(c, 9).alias(c) for c in ("prob_0", "prob_1")])


@_query
def score_vectors(spark, sf_dir):
    return _plain_scores(scoring.score_vectors(_score_input(spark, sf_dir), _scorer))


class _PickyScorer(scoring.LinearScorer):
    def __call__(self, rows):
        if any(r[4] == 2.0 for r in rows):
            raise ValueError("bad vector")
        return super().__call__(rows)


def _picky():
    return _PickyScorer(WEIGHTS, BIAS)


@_query
def score_failures(spark, sf_dir):
    """Mini-batches of one row, so that which rows fail does not depend on partitioning."""
    scored = scoring.score_vectors(_score_input(spark, sf_dir), _picky, batch=1)
    return _plain_scores(scored)


def _run_scores(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    source = stage(_gold(spark, sf_dir), "vector_time")
    scores, topic = shared_dir(spark, "scores"), shared_dir(spark, "topic")
    mark = shared_dir(spark, "checkpoint")
    vectors = source.stream(spark)
    finish(stream.gold_to_scores(vectors, _scorer, scores, topic, mark), TIMEOUT_S)
    return scores, topic


@_query
def score_stream(spark, sf_dir):
    scores, _ = _run_scores(spark, sf_dir)
    return _plain_scores(read_batches(spark, scores))


@_query
def msg_score_json(spark, sf_dir):
    _, topic = _run_scores(spark, sf_dir)
    fields = scoring.score_vectors(_gold(spark, sf_dir), _scorer).select(*SCORE_MESSAGE).schema
    sent = spark.read.text(topic).select(F.from_json("value", fields).alias("m")).select("m.*")
    rounded = {c: F.round(c, 9) for c in ("prob_0", "prob_1")}
    return sent.withColumns(rounded).drop("inference_time")


def _trained(spark: SparkSession, sf_dir: str):
    path = shared_dir(spark, "model")
    rows = training.training_rows(fx.mbo(spark, sf_dir))
    # Parity follows the side and so the price, which parts most labels: a penalty makes the fit unique.
    return training.train_model(rows, path, ridge=RIDGE), rows, path


@_query
def train_model(spark, sf_dir):
    """Rows trained on, and the fitted weights."""
    model, rows, _ = _trained(spark, sf_dir)
    fitted = {f"weight_{c}": F.lit(round(w, 6)) for c, w in zip(model.inputs, model.weights)}
    counted = rows.agg(F.count(F.lit(1)).alias("record_count"))
    return counted.withColumns({**fitted, "intercept": F.lit(round(model.intercept, 6))})


@_query
def model_accuracy(spark, sf_dir):
    model, rows, _ = _trained(spark, sf_dir)
    measured = training.model_accuracy(model, rows)
    return measured.select("record_count", F.round("accuracy", 9).alias("accuracy"))


@_query
def model_registry(spark, sf_dir):
    model, rows, path = _trained(spark, sf_dir)
    name = f"tickloom_models_{uuid.uuid4().hex}"
    row = training.registry_row(spark, path, training.model_accuracy(model, rows))
    append_table(row, name, shared_dir(spark, name))
    return spark.table(name).select(
        "record_count",
        F.round("accuracy", 9).alias("accuracy"),
        (F.col("model_path") == path).alias("names_model"),
        (F.col("trained_at") > fx.BASE_NS).alias("has_time"),
    )


def _plain_model_scores(scored: DataFrame) -> DataFrame:
    p = F.col("probability")
    return scored.select(
        "contract_id", "event_time", "price", "size", "prediction",
        F.round(p[0], 6).alias("prob_0"), F.round(p[1], 6).alias("prob_1"),
    )


@_query
def score_table(spark, sf_dir):
    _, rows, path = _trained(spark, sf_dir)
    return _plain_model_scores(training.score_table(rows, path))


# Jobs


def _lake(spark: SparkSession, **options) -> batch.Lake:
    return batch.Lake(shared_dir(spark, "lake"), **options)


def _with_bronze(spark: SparkSession, sf_dir: str, **options) -> batch.Lake:
    lake = _lake(spark, **options)
    lake.put(fx.mbo(spark, sf_dir).where(FIRST_DAY.predicate()), batch.BRONZE, FIRST_DAY)
    return lake


@_query
def pipe_raw_to_bronze(spark, sf_dir):
    lake = _lake(spark)
    batch.raw_to_bronze(
        fx.raw_records(spark, sf_dir), lake, FIRST_DAY, venue="SYNTH", price_scale=1e9,
        start_time="13:01", end_time="13:40",
    )
    rows = read_slice(spark, lake.path(batch.BRONZE), FIRST_DAY)
    return rows.select(*ENVELOPE_COLUMNS, "session_date")


@_query
def pipe_bronze_to_silver(spark, sf_dir):
    lake = _with_bronze(spark, sf_dir)
    batch.bronze_to_silver(spark, lake, FIRST_DAY)
    bar_rows = read_slice(spark, lake.path(batch.BARS), FIRST_DAY)
    narrow = read_slice(spark, lake.path(batch.PRIMITIVES), FIRST_DAY)
    tops = read_slice(spark, lake.path(batch.ORDERBOOK), FIRST_DAY)
    keys = [*SERIES_KEYS, "bucket_ns"]
    rest = bar_rows.select(*keys, "notional", "price_min", "price_max", "price_last")
    joined = narrow.join(tops.select(*keys, "best_bid", "best_ask"), keys).join(rest, keys)
    return _plain_time(joined).select(*SERIES_KEYS, "bucket_ns", "bucket_ts", *b.MEASURES)


@_query
def pipe_silver_to_gold(spark, sf_dir):
    lake = _with_bronze(spark, sf_dir)
    batch.bronze_to_silver(spark, lake, FIRST_DAY)
    batch.silver_to_gold(spark, lake, FIRST_DAY, canonical=True)
    return _plain_vector(read_slice(spark, lake.path(batch.TRAINING), FIRST_DAY))


@_query
def pipe_published(spark, sf_dir):
    """Bronze to gold over tables with manifests."""
    lake = _with_bronze(spark, sf_dir, published=True)
    batch.bronze_to_silver(spark, lake, FIRST_DAY)
    batch.silver_to_gold(spark, lake, FIRST_DAY, canonical=True)
    return _plain_vector(lake.get(spark, batch.TRAINING, FIRST_DAY))


@_query
def pipe_train_score(spark, sf_dir):
    source = stage(fx.broker_rows(spark, sf_dir), "offset")
    run = uuid.uuid4().hex
    tables = {f"{t}_table": f"tickloom_{t}_{run}" for t in ("events", "registry", "scores")}
    batch.train_and_score(
        table_stream(spark, source.path),
        model_path=shared_dir(spark, "model"),
        checkpoint=shared_dir(spark, "checkpoint"),
        location=shared_dir(spark, "tables"),
        timeout_s=TIMEOUT_S,
        **tables,
    )
    return _plain_model_scores(spark.table(tables["scores_table"]))

