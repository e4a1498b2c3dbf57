"""Raw records and broker rows to clean envelope rows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.clock import EXCHANGE_TZ, local_day, session_bounds
from tickloom.schemas import DEDUP_KEYS, ENVELOPE_COLUMNS
from tickloom.sources.broker import CORRUPT

# Fixed value: record type of market-by-order records.
MBO_RTYPE = 160

# Reasons in the dead-letter table.
PARSE_FAILURE = "JSON parse failure"
MISSING_FIELD = "Missing required field"
REQUIRED = ["event_time", "contract_id", "action"]
SOURCE_COLUMNS = ["enqueued_time", "source_offset", "source_sequence"]


def record_type(df: DataFrame, rtype: int = MBO_RTYPE) -> DataFrame:
    return df.where(F.col("rtype") == rtype)


def symbol_present(df: DataFrame) -> DataFrame:
    return df.where(F.col("symbol").isNotNull())


def outright_only(df: DataFrame) -> DataFrame:
    """Drop spreads, whose symbols contain a hyphen."""
    return df.where(~F.col("symbol").contains("-"))


def session_window(
    df: DataFrame,
    session_date: str,
    start_time: str,
    end_time: str,
    tz: str = EXCHANGE_TZ,
    *,
    time_col: str = "event_time",
) -> DataFrame:
    """Rows in the local ``[start, end)``; two literal bounds, so the scan can skip row groups."""
    start, end = session_bounds(session_date, start_time, end_time, tz)
    return df.where((F.col(time_col) >= start) & (F.col(time_col) < end))


def reject_reason() -> Column:
    """Null for a usable row of ``decode_envelope``, else why it is not."""
    malformed = F.col("data").isNull() | F.col(f"data.{CORRUPT}").isNotNull()
    for name in REQUIRED:
        missing = F.col(f"data.{name}").isNull()
        incomplete = missing if name == REQUIRED[0] else incomplete | missing
    return F.when(malformed, PARSE_FAILURE).when(incomplete, MISSING_FIELD)


def valid_rows(decoded: DataFrame) -> DataFrame:
    """Envelope columns, source position and New York session date of the usable rows."""
    return (
        decoded.where(reject_reason().isNull())
        .select(*[f"data.{c}" for c in ENVELOPE_COLUMNS], *SOURCE_COLUMNS)
        .withColumn("session_date", local_day("event_time"))
    )


def dead_letters(decoded: DataFrame) -> DataFrame:
    """The unusable rows in the layout of the dead-letter table."""
    return decoded.where(reject_reason().isNotNull()).select(
        F.col("body").alias("raw_record"),
        reject_reason().alias("error_message"),
        "source_partition",
        "source_offset",
        F.current_timestamp().alias("ingestion_timestamp"),
        F.lit(0).alias("retry_count"),
    )


def split_valid(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    return valid_rows(decoded), dead_letters(decoded)


def dedup_batch(
    df: DataFrame, keys: Sequence[str] = DEDUP_KEYS, order: Sequence[str] = ("sequence",)
) -> DataFrame:
    """First row per key by ``order``, then by the remaining columns so that reruns agree.

    Spark limits each key to one row before the shuffle, so copies of a hot key do not travel.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")
