"""Streaming jobs. Each returns its started query; run-once unless ``every`` is set.

Every job is one query with a fan-out, so parsing, state and scoring happen once per micro-batch
however many sinks there are. Sinks own one folder per batch and can be read with ``read_batches``.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.vectors import message
from tickloom.operators.bars import normalize, stream_bars
from tickloom.operators.ingest import dead_letters, valid_rows
from tickloom.operators.scoring import Scorer, score_vectors
from tickloom.functions.clock import ns_to_timestamp
from tickloom.schemas import SCORE_MESSAGE, VECTOR_MESSAGE
from tickloom.sources.broker import decode_envelope
from tickloom.sources.sinks import Sink, append_batches, append_stream, fan_out, write_messages
from tickloom.streaming.ingest import DELAY, dedup_decoded
from tickloom.streaming.book import book_stream, late_rows, stream_primitives
from tickloom.streaming.gold import gold_stream


def _cut(cut: Callable[[DataFrame], DataFrame], sink: Sink) -> Sink:
    return lambda batch, batch_id: sink(cut(batch), batch_id)


def _messages(target: str | dict[str, str], columns: list[str]) -> Sink:
    def write(batch: DataFrame, batch_id: int) -> None:
        to = f"{target}/batch_id={batch_id}" if isinstance(target, str) else target
        write_messages(batch.select(message(columns)), to)

    return write


def _stamped(decoded: DataFrame) -> DataFrame:
    return valid_rows(decoded).withColumn("bronze_ingest_time", F.current_timestamp())


def broker_to_bronze(
    broker: DataFrame,
    bronze: str,
    dead: str,
    checkpoint: str,
    *,
    delay: str = DELAY,
    every: str | None = None,
) -> StreamingQuery:
    """Decode, split and de-duplicate; usable rows to bronze, the rest to the dead-letter table."""
    decoded = dedup_decoded(decode_envelope(broker), delay=delay)
    sinks = [_cut(_stamped, append_batches(bronze)), _cut(dead_letters, append_batches(dead))]
    return fan_out(decoded, sinks, checkpoint, every=every)


def bronze_to_bars(
    bronze: DataFrame, bars: str, checkpoint: str, *, delay: str = DELAY, every: str | None = None
) -> StreamingQuery:
    """Native windowed bars, appended once complete."""
    return append_stream(
        stream_bars(normalize(bronze), delay=delay), bars, checkpoint, every=every
    )


def bronze_to_silver(
    bronze: DataFrame,
    primitives: str,
    late: str,
    checkpoint: str,
    *,
    every: str | None = None,
    **options,
) -> StreamingQuery:
    """Order book and bars per contract; late events to a side table."""
    book = book_stream(normalize(bronze), **options)
    sinks = [_cut(stream_primitives, append_batches(primitives)),
             _cut(late_rows, append_batches(late))]
    return fan_out(book, sinks, checkpoint, every=every)


def silver_to_gold(
    primitives: DataFrame,
    vectors: str,
    topic: str | dict[str, str],
    checkpoint: str,
    *,
    every: str | None = None,
    **options,
) -> StreamingQuery:
    """Feature vectors to a table and as messages."""
    sinks = [append_batches(vectors), _messages(topic, VECTOR_MESSAGE)]
    return fan_out(gold_stream(primitives, **options), sinks, checkpoint, every=every)


def gold_to_scores(
    vectors: DataFrame,
    make_scorer: Callable[[], Scorer],
    scores: str,
    topic: str | dict[str, str],
    checkpoint: str,
    *,
    delay: str = DELAY,
    every: str | None = None,
    **options,
) -> StreamingQuery:
    """Scores to a table and as messages."""
    timed = vectors.withColumn("vector_ts", ns_to_timestamp("vector_time")).withWatermark(
        "vector_ts", delay
    )
    scored = score_vectors(timed, make_scorer, **options)
    sinks = [append_batches(scores), _messages(topic, SCORE_MESSAGE)]
    return fan_out(scored, sinks, checkpoint, every=every)
