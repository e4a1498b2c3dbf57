"""Feature vectors of streamed bars, with the last mid of each contract in the state store.

Within a micro-batch a contract's bars are put in order and handled column-wise; what must outlive
the batch is one row of typed state.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.functions.vectors import FEATURES, feature_vector
from tickloom.schemas import DOUBLE, LONG, STREAM_VECTOR, STRING, struct
from tickloom.streaming.book import IDLE_MS


class _ChangeProcessor(StatefulProcessor):
    """Last mid of one contract."""

    def __init__(self, idle_ms: int, ttl_ms: int | None) -> None:
        self.idle_ms, self.ttl_ms = idle_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "bucket_ns LONG, mid DOUBLE", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        pdf = pd.concat(list(rows), ignore_index=True).sort_values("bucket_ns", ignore_index=True)
        pdf["mid"] = pdf["mid"].astype("float64")
        behind = pd.Series(False, index=pdf.index)
        bucket, mid = self.last.get() if self.last.exists() else (None, None)
        if bucket is not None:
            behind = pdf["bucket_ns"] <= bucket
        change = pdf["mid"] - pdf["mid"].shift(1)
        ahead = np.flatnonzero(~behind)
        if len(ahead):
            first = ahead[0]
            last_mid = np.nan if mid is None else mid
            change[first] = 0.0 if bucket is None else pdf["mid"][first] - last_mid
        known = pdf["bucket_ns"].where(~behind)
        gap = known - known.shift(1).fillna(np.nan if bucket is None else bucket)
        change[gap >= self.idle_ms * 1_000_000] = 0.0
        change[behind] = np.nan  # a bar behind its contract has no known predecessor
        final = pdf.iloc[-1]
        if bucket is None or final["bucket_ns"] > bucket:
            mid = None if pd.isna(final["mid"]) else float(final["mid"])
            self.last.update((int(final["bucket_ns"]), mid))
        yield pdf.assign(mid_change=change.astype("float64"))[self.OUTPUT.fieldNames()]

    def close(self) -> None:
        pass

    OUTPUT = struct(
        bucket_ns=LONG,
        session_date=STRING,
        underlier=STRING,
        instrument_type=STRING,
        ofi_ratio=DOUBLE,
        spread=DOUBLE,
        mid_change=DOUBLE,
        vwap=DOUBLE,
        event_count=LONG,
        contract_id=STRING,
    )


def gold_stream(
    df: DataFrame,
    *,
    model_id: str = "ES_MODEL",
    idle_ms: int = IDLE_MS,
    ttl_ms: int | None = None,
) -> DataFrame:
    """Feature vectors of streamed bars; a contract's first bar has a change of zero.

    Every bar gives one row: one that comes behind a later bar of its contract, however late, has
    no known predecessor and a change of null. There is no watermark to lose it.

    A contract's state is one row. It is kept for ever unless ``ttl_ms`` is set: then a contract
    without bars for that long on the wall clock is forgotten, by the store itself and without
    timers. Spark keeps a query with such state going by empty micro-batches, so that a run-once
    query has to be started in a session without them, as of
    ``stateful_session(spark, idle_batches=False)``.
    Measures stay null where the bar has none; the vector holds zeros there.
    """
    columns = ["contract_id", "bucket_ns", "session_date", "underlier", "instrument_type",
               "ofi_ratio", "spread", "mid", "vwap", "event_count"]
    changed = (
        df.select(*columns)
        .groupBy("contract_id")
        .transformWithStateInPandas(
            _ChangeProcessor(idle_ms, ttl_ms),
            outputStructType=_ChangeProcessor.OUTPUT,
            outputMode="append",
            timeMode="None" if ttl_ms is None else "ProcessingTime",
        )
    )
    return (
        changed.withColumnRenamed("bucket_ns", "vector_time")
        .withColumn("feature_vector", feature_vector(FEATURES))
        .select(
            *STREAM_VECTOR.fieldNames(),
            F.lit(model_id).alias("model_id"),
            F.current_timestamp().alias("gold_ingest_time"),
        )
    )
