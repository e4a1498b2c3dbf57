"""Late rows beside native stateful operators.

Spark's own aggregation and de-duplication drop rows behind the watermark without a word. Here a
keyed step ahead of them, which sees the watermark, numbers such rows and gives them a clock that is
not late. So they pass through the native operator in the same query, each in a group of its own,
and come out whole: what is kept and what is late are all that came in.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.functions.clock import BAR_NS
from tickloom.operators.bars import stream_bars
from tickloom.schemas import DEDUP_KEYS, SERIES_KEYS
from tickloom.streaming.packs import CLOCK, ROWS, packer, unpack

DELAY = "10 minutes"
# Names of the columns that ``mark_late`` adds; null in LATE_ROW is on time.
TIME, LATE_ROW = "row_clock", "late_row"

_SHARD = "late_shard"
_SHARD_BITS = 40


class _LateProcessor(StatefulProcessor):
    """Number of late rows that a shard has seen, so that each gets another number."""

    def __init__(self, schema: T.StructType, clock: str, width_ns: int) -> None:
        self.columns = [f.name for f in schema]
        self.clock, self.width_us = clock, width_ns // 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "late_rows LONG")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        watermark_us = timerValues.getCurrentWatermarkInMs() * 1000
        table = unpack(bytes(p) for frame in rows for p in frame[ROWS])
        out = table.to_pandas(integer_object_nulls=True)
        micros = table[self.clock].cast(pa.timestamp("us", "UTC")).cast(pa.int64()).to_pandas(integer_object_nulls=True)
        missing = micros.isna().to_numpy()
        at = micros.where(~missing, 0).to_numpy().astype(np.int64)
        end = at // self.width_us * self.width_us + self.width_us if self.width_us else at
        # A row without a clock belongs to no window and is handed on with the late ones.
        late = missing | (end <= watermark_us)
        before = self.seen.get()[0] if self.seen.exists() else 0
        count = int(late.sum())
        if count:
            self.seen.update((before + count,))
        number = (int(key[0]) << _SHARD_BITS) + before + np.cumsum(late)
        # An open window can hold times behind the watermark; its last instant never is.
        at = np.where(late, watermark_us + 1000, end - 1 if self.width_us else at)
        out[TIME] = pd.DatetimeIndex(at.astype("datetime64[us]"), tz="UTC")
        out[LATE_ROW] = pd.arrays.IntegerArray(number.astype(np.int64), ~late)
        yield out[[*self.columns, TIME, LATE_ROW]]

    def close(self) -> None:
        pass


def mark_late(
    df: DataFrame, clock: str, *, delay: str = DELAY, width_ns: int = 0, shards: int | None = None
) -> DataFrame:
    """``df`` with a clock that is never late, and a number in ``late_row`` for late rows.

    A row is late if the watermark, ``delay`` behind the latest ``clock`` of earlier micro-batches,
    has passed it, or with ``width_ns`` the end of its window; so is one without a clock. The new
    clock is the stream's event time from here on. Rows travel as packs, a few to a task; ``shards``
    is the number of keys, by default four per shuffle partition.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = shards or 4 * partitions
    # All fields may be null: a pack's rows come back through pandas.
    plain = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    layout = T.StructType([T.StructField(_SHARD, T.IntegerType()), T.StructField(CLOCK, T.TimestampType()), T.StructField(ROWS, T.BinaryType())])
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(shards)).cast("int")
    rows = df.select(spread.alias(_SHARD), F.col(clock).alias(CLOCK), "*")
    packed = rows.mapInArrow(packer([_SHARD]), layout).withWatermark(CLOCK, delay)
    marked = T.StructType([*plain, T.StructField(TIME, T.TimestampType()), T.StructField(LATE_ROW, T.LongType())])
    return (
        # A test of another column would run ahead of the watermark and take the clocks away.
        packed.where(F.col(CLOCK).isNull())
        .groupBy(_SHARD)
        .transformWithStateInPandas(
            _LateProcessor(plain, clock, width_ns),
            outputStructType=marked,
            outputMode="append",
            timeMode="EventTime",
            eventTimeColumnName=TIME,
        )
    )


def dedup_with_late(
    df: DataFrame,
    keys: Sequence[str] = DEDUP_KEYS,
    *,
    clock: str = "enqueued_time",
    delay: str = DELAY,
) -> DataFrame:
    """First row per key within the watermark, and every late row, told by ``late_row``."""
    marked = mark_late(df, clock, delay=delay)
    return marked.dropDuplicatesWithinWatermark([*keys, LATE_ROW]).drop(TIME)


def bars_with_late(
    df: DataFrame,
    keys: Sequence[str] = SERIES_KEYS,
    width_ns: int = BAR_NS,
    *,
    delay: str = DELAY,
) -> DataFrame:
    """Bars of normalised events, and a row for each late event with all of it in ``late``."""
    marked = mark_late(df, "event_ts", delay=delay, width_ns=width_ns)
    event = F.when(F.col(LATE_ROW).isNotNull(), F.struct(*df.columns))
    return stream_bars(
        marked, [*keys, LATE_ROW], width_ns, delay=None, clock=TIME, also=[F.first(event).alias("late")]
    )
