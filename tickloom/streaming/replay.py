"""Replay of a table as a bounded stream, in time order."""

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.sources.stage import materialize, shared_dir
from tickloom.sources.tables import table_stream

# Key of a closing row that only moves the watermark; drop it from the output.
FAR_FUTURE_KEY = "__end__"

# Bytes of a file of a span, about, and files that a span has at least.
FILE_BYTES, LEAST_FILES = 128 << 20, 4


_FAR_FUTURE = datetime.datetime(2100, 1, 1, tzinfo=datetime.timezone.utc)


def closing_row(df: DataFrame, key: str = "contract_id") -> DataFrame:
    """One row whose timestamps lie far ahead, so that all before it counts as complete."""
    ns = int(_FAR_FUTURE.timestamp()) * 1_000_000_000
    values = []
    for f in df.schema:
        if f.name == key:
            values.append(FAR_FUTURE_KEY)
        elif f.name in ("event_time", "ingest_time", "bucket_ns", "vector_time"):
            values.append(ns)
        elif f.dataType == T.TimestampType():
            values.append(_FAR_FUTURE)
        else:
            values.append(None)
    open_schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    return df.sparkSession.createDataFrame([tuple(values)], open_schema)


@dataclass(frozen=True)
class Replayed:
    """A staged table: each micro-batch of its stream is one span, as ``files`` files."""

    path: str
    files: int

    def stream(self, session: SparkSession) -> DataFrame:
        return table_stream(session, self.path, max_files=self.files)


def stage(df: DataFrame, by: str, slices: int = 4, *, files: int | None = None, closing: bool = False) -> Replayed:
    """Write equal spans of ``by`` one after another, each as ``files`` files.

    A file stream takes files by age, so with as many a trigger every micro-batch is one span. The
    spans' bounds are one row of the table, which is evaluated once. Unset, ``files`` follows from
    the table's size: a file, and so a task of a micro-batch, holds about ``FILE_BYTES``.
    """
    df = materialize(df, "replay-input")
    if files is None:
        # What Spark's planner knows of the files, without a look at their rows.
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        files = max(LEAST_FILES, -(-size // (slices * FILE_BYTES)))
    low, high = df.agg(F.min(by), F.max(by)).first()
    path = shared_dir(df.sparkSession, "replay")
    step = (high - low) // slices + 1
    for i in range(slices):
        start = low + i * step
        part = df.where((F.col(by) >= start) & (F.col(by) < start + step))
        if closing and i == slices - 1:
            # It moves the watermark after its micro-batch and so needs none of its own.
            part = part.unionByName(closing_row(df))
        part.repartition(files).write.mode("append").parquet(path)
        written = len(df.sparkSession.read.schema(df.schema).parquet(path).inputFiles())
        # A span with few rows or none gives fewer files; empty ones keep micro-batches whole.
        for _ in range(files * (i + 1) - written):
            df.limit(0).coalesce(1).write.mode("append").parquet(path)
    return Replayed(path, files)


def stage_slices(df: DataFrame, by: str, slices: int = 4, *, files: int = 1, closing: bool = False) -> str:
    """The path of a table staged with so many files a span."""
    return stage(df, by, slices, files=files, closing=closing).path
