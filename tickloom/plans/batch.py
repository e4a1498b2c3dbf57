"""Batch jobs: raw records to bronze, silver, gold, training snapshot, trained model."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.clock import BAR_NS, EXCHANGE_TZ
from tickloom.operators import training
from tickloom.operators.bars import bars, feature_primitives, normalize, orderbook_state
from tickloom.operators.features import labels, setup_vectors
from tickloom.operators.guards import guard_nonempty, guard_training_set
from tickloom.operators.ingest import (
    outright_only,
    record_type,
    session_window,
    symbol_present,
    valid_rows,
)
from tickloom.sources.broker import decode_envelope
from tickloom.sources.publish import publish_slice, read_published
from tickloom.sources.records import raw_to_envelope
from tickloom.sources.sinks import (
    append_stream,
    append_table,
    export_snapshot,
    finish,
    replace_slice,
)
from tickloom.sources.tables import Slice, read_slice


@dataclass(frozen=True)
class Lake:
    """The tables below one root, as partitioned folders or, ``published``, with manifests.

    A reader of a published table sees a slice's replacement whole or not at all.
    """

    root: str
    published: bool = False

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def put(self, df: DataFrame, table: str, part: Slice) -> int:
        return (publish_slice if self.published else replace_slice)(df, self.path(table), part)

    def get(self, spark: SparkSession, table: str, part: Slice) -> DataFrame:
        return (read_published if self.published else read_slice)(spark, self.path(table), part)


BRONZE = "bronze/mbo_envelope"
NORMALIZED = "silver/mbo_normalized"
BARS = "silver/bar_5s"
ORDERBOOK = "silver/orderbook_state"
PRIMITIVES = "silver/feature_primitives"
SETUP = "gold/setup_vectors"
LABELS = "gold/labels"
TRAINING = "gold/training_view"


def raw_to_bronze(
    raw: DataFrame,
    lake: Lake,
    part: Slice,
    *,
    venue: str,
    start_time: str = "09:30",
    end_time: str = "11:30",
    tz: str = EXCHANGE_TZ,
    price_scale: float = 1.0,
) -> int:
    """One session window of outright order events into its bronze slice."""
    kept = outright_only(symbol_present(record_type(raw)))
    kept = session_window(
        kept, part.session_date, start_time, end_time, tz, time_col="ts_event"
    )
    guard_nonempty(kept, f"raw {part}")
    rows = raw_to_envelope(
        kept,
        venue=venue,
        underlier=part.underlier,
        instrument_type=part.instrument_type,
        session_date=part.session_date,
        price_scale=price_scale,
    )
    return lake.put(rows, BRONZE, part)


def bronze_to_silver(
    spark: SparkSession, lake: Lake, part: Slice, *, width_ns: int = BAR_NS
) -> None:
    """Normalised events, bars, order-book state and feature primitives of one slice.

    Events are aggregated once: the two narrow tables are cut from the bars as written.
    """
    events = guard_nonempty(lake.get(spark, BRONZE, part), f"bronze {part}")
    normalized = normalize(events)
    lake.put(normalized, NORMALIZED, part)
    lake.put(bars(normalized, width_ns=width_ns), BARS, part)
    written = lake.get(spark, BARS, part)
    lake.put(orderbook_state(written), ORDERBOOK, part)
    lake.put(feature_primitives(written), PRIMITIVES, part)


def silver_to_gold(spark: SparkSession, lake: Lake, part: Slice, **options) -> None:
    """Setup vectors, labels and training view of one slice; the windows run once."""
    primitives = lake.get(spark, PRIMITIVES, part)
    guard_nonempty(primitives, f"silver {part}")
    lake.put(setup_vectors(primitives, **options), SETUP, part)
    written = lake.get(spark, SETUP, part)
    lake.put(labels(written), LABELS, part)
    lake.put(written, TRAINING, part)


def training_snapshot(
    spark: SparkSession,
    lake: Lake,
    part: Slice,
    datasets: str,
    run_date: str,
    *,
    model_suffix: str = "_MODEL",
) -> str:
    """Export one slice of the training view; returns the dataset's path."""
    if not run_date:
        raise ValueError("Missing value: run_date")
    rows = guard_nonempty(lake.get(spark, TRAINING, part), f"training {part}")
    return export_snapshot(rows, datasets, f"{part.underlier}{model_suffix}", run_date)


def train_and_score(
    broker: DataFrame,
    *,
    events_table: str,
    registry_table: str,
    scores_table: str,
    model_path: str,
    checkpoint: str,
    min_records: int = 10,
    inputs: Sequence[str] = ("price", "size"),
    location: str | None = None,
    timeout_s: int | None = None,
) -> None:
    """Bounded stream intake, then train on it, register the run and score it.

    ``location`` is the folder for tables that do not exist yet; unset, the warehouse.
    """
    spark = broker.sparkSession

    def at(table: str) -> str | None:
        return location and f"{location}/{table}"

    stamped = valid_rows(decode_envelope(broker)).withColumn("bronze_ingest_time", F.current_timestamp())
    intake = append_stream(stamped, events_table, checkpoint, location=at(events_table))
    finish(intake, timeout_s)
    used = ["contract_id", "event_time", "sequence", *inputs]
    rows = training.training_rows(spark.table(events_table).select(*dict.fromkeys(used)))
    guard_training_set(rows, min_records=min_records)
    model = training.train_model(rows, model_path, tuple(inputs))
    metrics = training.model_accuracy(model, rows)
    registry = training.registry_row(spark, model_path, metrics)
    append_table(registry, registry_table, at(registry_table))
    append_table(training.score_table(rows, model_path), scores_table, at(scores_table))
