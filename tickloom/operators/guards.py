"""Contracts checked before work is done."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, names: Sequence[str], what: str = "columns") -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"Missing {what}: {missing}")
    return df


def guard_nonempty(df: DataFrame, what: str) -> DataFrame:
    """Fail when there is no row; reads at most one."""
    if df.isEmpty():
        raise ValueError(f"No {what} rows found")
    return df


def guard_training_set(
    df: DataFrame, *, min_records: int = 10, min_classes: int = 2, label: str = "label"
) -> DataFrame:
    """Fail on too few rows or label classes; one pass, and the counts come back as one row."""
    stats = df.agg(
        F.count(F.lit(1)).alias("record_count"), F.count_distinct(label).alias("class_count")
    )
    row = stats.first()
    if row["record_count"] < min_records:
        raise ValueError(f"{row['record_count']} rows are under the minimum of {min_records}")
    if row["class_count"] < min_classes:
        raise ValueError(f"{row['class_count']} of {min_classes} label classes present")
    return df.sparkSession.createDataFrame([row], stats.schema)


def optional_columns(df: DataFrame, defaults: dict[str, F.Column]) -> DataFrame:
    """Add each named column that is not there yet; defaults must be typed."""
    return df.withColumns({n: c for n, c in defaults.items() if n not in df.columns})
