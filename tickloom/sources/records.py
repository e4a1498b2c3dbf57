"""Decoded feed records to envelope rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.guards import require_columns
from tickloom.schemas import ENVELOPE_COLUMNS, PAYLOAD_FIELDS


def payload_json() -> F.Column:
    """The raw fields without an envelope column, packed as compact JSON with nulls kept."""
    return F.to_json(F.struct(*PAYLOAD_FIELDS), {"ignoreNullFields": "false"})


def raw_to_envelope(
    df: DataFrame,
    *,
    venue: str,
    underlier: str,
    instrument_type: str,
    session_date: str | None = None,
    price_scale: float = 1.0,
) -> DataFrame:
    """Envelope rows; a fixed-point price needs ``price_scale=1e9``."""
    require_columns(df, PAYLOAD_FIELDS, "raw columns")
    out = df.select(
        F.col("ts_event").cast("long").alias("event_time"),
        F.col("ts_recv").cast("long").alias("ingest_time"),
        F.lit(venue).alias("venue"),
        F.col("symbol").cast("string").alias("symbol"),
        F.lit(instrument_type).alias("instrument_type"),
        F.lit(underlier).alias("underlier"),
        F.col("symbol").cast("string").alias("contract_id"),
        F.col("action").cast("string").alias("action"),
        F.col("order_id").cast("long").alias("order_id"),
        F.col("side").cast("string").alias("side"),
        (F.col("price").cast("double") / F.lit(float(price_scale))).alias("price"),
        F.col("size").cast("long").alias("size"),
        F.col("sequence").cast("long").alias("sequence"),
        payload_json().alias("payload"),
    ).select(*ENVELOPE_COLUMNS)
    return out if session_date is None else out.withColumn("session_date", F.lit(session_date))
