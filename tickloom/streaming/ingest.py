"""Streaming forms of the ingest operators."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.ingest import reject_reason
from tickloom.schemas import DEDUP_KEYS

DELAY = "10 minutes"


def dedup_stream(
    df: DataFrame,
    keys: Sequence[str] = DEDUP_KEYS,
    *,
    clock: str = "enqueued_time",
    delay: str = DELAY,
) -> DataFrame:
    return df.withWatermark(clock, delay).dropDuplicatesWithinWatermark(list(keys))


def dedup_decoded(decoded: DataFrame, *, delay: str = DELAY) -> DataFrame:
    """De-duplicate usable rows; unusable ones pass beside the watermark, so none is ever late."""
    reason = reject_reason()
    keys = {f"_{k}": F.col(f"data.{k}") for k in DEDUP_KEYS}
    usable = decoded.where(reason.isNull()).withColumns(keys)
    fresh = dedup_stream(usable, list(keys), delay=delay).drop(*keys)
    return fresh.unionByName(decoded.where(reason.isNotNull()))
