"""Feature arrays, their hashes, and JSON messages."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Order of the entries in a feature vector.
FEATURES = ["ofi_ratio", "spread", "mid_change", "vwap", "event_count"]


def feature_vector(columns: Sequence[str] = FEATURES) -> Column:
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns])


def json_hash(vector: Column | str) -> Column:
    """SHA-256 of the vector's JSON text."""
    return F.sha2(F.to_json(vector), 256)


def canonical_hash(vector: Column | str, scale: int = 1_000_000) -> Column:
    """SHA-256 over entries scaled to longs: the same text in every engine."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    text = F.transform(vector, lambda x: F.floor(x * F.lit(float(scale)) + 0.5).cast("string"))
    return F.sha2(F.array_join(text, ","), 256)


def message(columns: Sequence[str]) -> Column:
    """One JSON ``value`` column for a message sink."""
    return F.to_json(F.struct(*columns)).alias("value")
