"""Deterministic market-by-order inputs derived from the ``events`` table.

Shared by the query registry, the tests and the benchmark. Event time is re-based to one event per
250 ms because the table's own timestamps are too thin for five-second bars.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.clock import local_day
from tickloom.schemas import BROKER, ENVELOPE_COLUMNS, PAYLOAD_FIELDS

BASE_NS = 1_704_132_000_000_000_000
STEP_NS = 250_000_000
INGEST_LAG_NS = 1_500_000
BROKEN_EVERY = 19
BROKEN_FORMS = ["not json", '{"event_time":1', "[1]", '""', "{}", "", None, '{"size":"many"}']


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _envelope(events: DataFrame, event_time: Column) -> DataFrame:
    level = F.round(F.col("value") * 4).cast("long") % 40
    side = (
        F.when(F.col("event_id") % 7 == 0, "N").when(F.col("event_id") % 2 == 0, "B").otherwise("S")
    )
    action = (
        F.when(F.col("event_type").isin("click", "view"), "A")
        .when(F.col("event_type") == "purchase", "T")
        .otherwise("C")
    )
    contract = F.concat(F.lit("SYN"), (F.col("user_id") % 8).cast("string"))
    price = (
        F.when(side == "B", 4000 - 0.25 * (1 + level))
        .when(side == "S", 4000 + 0.25 * level)
        .otherwise(4000)
    )
    return events.select(
        event_time.alias("event_time"),
        (event_time + INGEST_LAG_NS).alias("ingest_time"),
        F.lit("SYNTH").alias("venue"),
        contract.alias("symbol"),
        F.lit("FUT").alias("instrument_type"),
        F.lit("SYN").alias("underlier"),
        contract.alias("contract_id"),
        action.alias("action"),
        F.col("event_id").alias("order_id"),
        side.alias("side"),
        price.cast("double").alias("price"),
        (1 + F.col("event_id") % 10).alias("size"),
        F.col("event_id").alias("sequence"),
        F.col("props").alias("payload"),
    ).withColumn("session_date", local_day("event_time"))


def mbo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope rows at one event per 250 ms."""
    return _envelope(load(spark, sf_dir, "events"), F.lit(BASE_NS) + F.col("event_id") * STEP_NS)


def mbo_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope rows at their own timestamps, spread over many session dates."""
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    return _envelope(load(spark, sf_dir, "events"), micros * 1000)


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded feed records: other record types, missing symbols and spreads mixed in."""
    n = F.col("order_id")
    extra = {
        "instrument_id": 100 + n % 8,
        "publisher_id": 1 + n % 3,
        "flags": n % 256,
        "channel_id": n % 4,
        "ts_in_delta": n % 1000,
        "rtype": F.when(n % 11 == 0, 161).otherwise(160),
    }
    symbol = (
        F.when(n % 13 == 0, None).when(n % 17 == 0, "SYN1-SYN2").otherwise(F.col("symbol"))
    )
    return mbo(spark, sf_dir).select(
        F.col("event_time").alias("ts_event"),
        F.col("ingest_time").alias("ts_recv"),
        symbol.alias("symbol"),
        "action",
        "side",
        "order_id",
        "size",
        "sequence",
        (F.col("price") * 1_000_000_000).cast("long").alias("price"),
        *[extra[f].alias(f) for f in PAYLOAD_FIELDS],
    )


def broker_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker rows of the envelope as JSON; one in nineteen is malformed."""
    n = F.col("order_id")
    forms = F.array(*[F.lit(f).cast("string") for f in BROKEN_FORMS])
    broken = F.get(forms, (F.floor(n / BROKEN_EVERY) % len(BROKEN_FORMS)).cast("int"))
    value = F.when(n % BROKEN_EVERY == 0, broken).otherwise(
        F.to_json(F.struct(*ENVELOPE_COLUMNS))
    )
    return mbo(spark, sf_dir).select(
        value.cast("binary").alias("value"),
        F.timestamp_micros(F.call_function("div", F.col("ingest_time"), F.lit(1000))).alias(
            "timestamp"
        ),
        n.alias("offset"),
        (n % 4).cast("int").alias("partition"),
    ).to(BROKER)


def with_duplicates(mbo_rows: DataFrame) -> DataFrame:
    """Every tenth row twice."""
    return mbo_rows.unionByName(mbo_rows.where(F.col("order_id") % 10 == 0))
