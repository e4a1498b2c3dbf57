"""Small hand-made event tables."""

from pyspark.sql import functions as F

from tickloom.operators.bars import normalize
from tickloom.schemas import ENVELOPE

T0 = 1_704_132_000_000_000_000
SECOND = 1_000_000_000

DEFAULTS = {
    "ingest_time": 0,
    "venue": "X",
    "symbol": "C1",
    "instrument_type": "FUT",
    "underlier": "U",
    "contract_id": "C1",
    "action": "A",
    "order_id": 0,
    "side": "B",
    "price": 100.0,
    "size": 1,
    "sequence": 0,
    "payload": None,
}


def events(spark, rows):
    """Rows as dicts; what is left out takes a default, and sequence counts up."""
    full = []
    for i, r in enumerate(rows):
        row = {**DEFAULTS, "sequence": i, "order_id": i, "event_time": T0, **r}
        row["ingest_time"] = row["ingest_time"] or row["event_time"]
        full.append(tuple(row[n] for n in ENVELOPE.fieldNames()))
    df = spark.createDataFrame(full, ENVELOPE)
    return df.withColumn("session_date", F.lit("2024-01-01"))


def normalized(spark, rows):
    return normalize(events(spark, rows))
