"""Lagged and leading features, labels and training vectors over bars.

Windows run per session and contract: a day holds at most as many bars as it has buckets, however
many events a contract has.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.clock import BAR_NS
from tickloom.functions.vectors import FEATURES, canonical_hash, feature_vector, json_hash
from tickloom.schemas import LABEL_COLUMNS, SERIES_KEYS, SETUP_COLUMNS

LABEL_STEPS = 24

# Lineage of training vectors.
MODEL_SUFFIX = "_MODEL"
LOOKBACK_SPEC = "5s"
DATA_VERSION = "silver.feature_primitives"


def _series(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy("bucket_ns")


def mid_change(
    df: DataFrame, keys: Sequence[str] = SERIES_KEYS, *, first: float | None = None
) -> DataFrame:
    """``mid`` minus the previous bar's; ``first`` is the value of a series' first bar."""
    w = _series(keys)
    change = F.col("mid") - F.lag("mid").over(w)
    if first is not None:
        change = F.when(F.row_number().over(w) == 1, F.lit(float(first))).otherwise(change)
    return df.withColumn("mid_change", change)


def mid_future(
    df: DataFrame,
    n: int = LABEL_STEPS,
    keys: Sequence[str] = SERIES_KEYS,
    *,
    by: str = "rows",
    width_ns: int = BAR_NS,
) -> DataFrame:
    """``mid`` n bars ahead (``by="rows"``), or exactly n bucket widths ahead (``by="time"``).

    Both use the sort that ``mid_change`` already needs; the time form is null where that bar is
    missing.
    """
    w = _series(keys)
    if by == "rows":
        future = F.lead("mid", n).over(w)
    elif by == "time":
        ahead = n * width_ns
        future = F.first("mid").over(w.rangeBetween(ahead, ahead))
    else:
        raise ValueError(f"by must be 'rows' or 'time', not {by!r}")
    return df.withColumn("mid_future", future)


def label(*, strict: bool = False) -> Column:
    """1 when the future mid is higher, else 0; null without a future.

    A missing present mid gives 0, or null when ``strict``.
    """
    future, mid = F.col("mid_future"), F.col("mid")
    unknown = future.isNull() | mid.isNull() if strict else future.isNull()
    return F.when(unknown, None).when(future > mid, 1).otherwise(0)


def forward_label(
    df: DataFrame,
    n: int = LABEL_STEPS,
    keys: Sequence[str] = SERIES_KEYS,
    *,
    by: str = "rows",
    strict: bool = False,
    width_ns: int = BAR_NS,
) -> DataFrame:
    future = mid_future(df, n, keys, by=by, width_ns=width_ns)
    return future.withColumn("label", label(strict=strict))


def vectors(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    return df.withColumn("feature_vector", feature_vector(columns))


def hashes(df: DataFrame, *, canonical: bool = False) -> DataFrame:
    make = canonical_hash if canonical else json_hash
    return df.withColumn("feature_hash", make("feature_vector"))


def setup_vectors(
    df: DataFrame,
    *,
    model_suffix: str = MODEL_SUFFIX,
    lookback_spec: str = LOOKBACK_SPEC,
    data_version: str = DATA_VERSION,
    n: int = LABEL_STEPS,
    by: str = "rows",
    strict: bool = False,
    canonical: bool = False,
) -> DataFrame:
    """Feature primitives to labelled training vectors, with one shuffle and one sort."""
    labelled = forward_label(mid_change(df), n, by=by, strict=strict)
    return (
        hashes(vectors(labelled), canonical=canonical)
        .withColumns(
            {
                "vector_time": F.col("bucket_ns"),
                "model_id": F.concat("underlier", F.lit(model_suffix)),
                "lookback_spec": F.lit(lookback_spec),
                "data_version": F.lit(data_version),
            }
        )
        .select(*SETUP_COLUMNS)
    )


def labels(setup: DataFrame) -> DataFrame:
    return setup.select(*LABEL_COLUMNS)
