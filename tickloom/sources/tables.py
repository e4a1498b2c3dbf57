"""Batch and streaming scans of the partitioned tables."""

import re
from dataclasses import asdict, dataclass, fields

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Slice:
    """One ``(session_date, underlier, instrument_type)`` partition; every part is required."""

    session_date: str
    underlier: str
    instrument_type: str

    def __post_init__(self) -> None:
        for f in fields(self):
            if not getattr(self, f.name):
                raise ValueError(f"Missing value: {f.name}")

    def predicate(self) -> Column:
        day, underlier, kind = (F.col(k) == v for k, v in asdict(self).items())
        return day & underlier & kind

    def folder(self) -> str | None:
        """Where a table keeps the slice, below its root; None for values that Spark escapes."""
        parts = asdict(self)
        if not all(re.fullmatch(r"[A-Za-z0-9_.-]+", v) for v in parts.values()):
            return None
        return "/".join(f"{k}={v}" for k, v in parts.items())


# Spark's error conditions for a missing and for an empty folder.
NO_FILES = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


# Spark guesses the type of a partition value ("1" becomes an int); the keys are strings.
def _string_keys(schema: T.StructType) -> T.StructType:
    keys = {f.name for f in fields(Slice)}
    return T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in keys else f.dataType) for f in schema]
    )


def checked_slice(df: DataFrame, part: Slice) -> DataFrame:
    """The same rows; one outside the slice fails whatever job reads them."""
    outside = F.raise_error(F.lit(f"row outside of {part}")).cast("boolean")
    return df.where(F.when(part.predicate(), True).otherwise(outside))


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """A partitioned parquet table with string slice keys, or a catalogue table by its name.

    A given ``schema`` saves a look at the files to find it.
    """
    if "/" not in path:
        return spark.table(path)
    schema = schema or spark.read.parquet(path).schema
    return spark.read.schema(_string_keys(schema)).parquet(path)


def read_slice(
    spark: SparkSession, path: str, part: Slice, schema: T.StructType | None = None
) -> DataFrame:
    """Scan of one slice; its own folder is listed, not the whole table.

    The table is listed where the folder cannot be named or is missing or empty.
    """
    folder = part.folder()
    if "/" in path and folder:
        reader = spark.read.option("basePath", path)
        own = f"{path.rstrip('/')}/{folder}"
        try:
            known = _string_keys(schema or reader.parquet(own).schema)
            return reader.schema(known).parquet(own).where(part.predicate())
        except AnalysisException as e:
            if e.getCondition() not in NO_FILES:
                raise
    return read_table(spark, path, schema).where(part.predicate())


def table_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    max_files: int | None = None,
    max_bytes: str | None = None,
) -> DataFrame:
    """A table as a stream, with an optional intake cap per trigger."""
    if max_files is not None and max_bytes is not None:
        raise ValueError("max_files and max_bytes exclude each other")
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if "/" not in path:
        return reader.table(path)
    return reader.schema(schema or read_table(spark, path).schema).parquet(path)
