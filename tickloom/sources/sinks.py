"""Batch and streaming writes."""

from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tickloom.schemas import SLICE_KEYS
from tickloom.sources.tables import Slice, checked_slice, read_slice


def replace_slice(df: DataFrame, path: str, part: Slice) -> int:
    """Replace exactly one slice of a partitioned table; returns the rows written.

    A row outside the slice fails the write job itself, so there is no separate checking pass and
    the old data stays. Dynamic overwrite leaves a slice alone when nothing was written for it, so
    an empty result is followed by emptying the slice's folder.
    """
    seen = Observation()
    checked = checked_slice(df, part).observe(seen, F.count(F.lit(1)).alias("rows"))
    # As literals the checked keys need no sort ahead of a partitioned write.
    constant = checked.withColumns({k: F.lit(v) for k, v in asdict(part).items()})
    (
        constant.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*SLICE_KEYS)
        .parquet(path)
    )
    rows = seen.get["rows"]
    if rows == 0:
        _empty_slice(df, path, part)
    return rows


def _empty_slice(df: DataFrame, path: str, part: Slice) -> None:
    spark = df.sparkSession
    try:
        old = read_slice(spark, path, part)
    except Exception as e:  # a table with no data file at all has no schema to read
        if "UNABLE_TO_INFER_SCHEMA" in str(e) or "PATH_NOT_FOUND" in str(e):
            return
        raise
    # All files of a slice share one folder, so one row of the distinct list is the whole list.
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    for row in old.select(folder.alias("folder")).distinct().take(1):
        df.drop(*SLICE_KEYS).limit(0).write.mode("overwrite").parquet(row["folder"])


def export_snapshot(df: DataFrame, root: str, model_id: str, run_date: str) -> str:
    """Overwrite the dataset of one model and run date."""
    path = f"{root}/{model_id}/{run_date}"
    df.withColumn("model_id", F.lit(model_id)).write.mode("overwrite").parquet(path)
    return path


def append_table(df: DataFrame, name: str, location: str | None = None) -> None:
    """Append to a catalogue table, created at ``location`` or in the warehouse."""
    writer = df.write.mode("append").format("parquet")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)


def trigger(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def append_stream(
    df: DataFrame,
    target: str,
    checkpoint: str,
    *,
    every: str | None = None,
    fmt: str = "parquet",
    location: str | None = None,
) -> StreamingQuery:
    """Append to a table by path or name; runs once over what is there unless ``every`` is set."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if location:
        writer = writer.option("path", location)
    writer = trigger(writer, every)
    return writer.start(target) if "/" in target else writer.toTable(target)


def finish(query: StreamingQuery, timeout_s: int | None = None) -> None:
    """Wait for a run-once query; stop it and fail when it overruns."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"query {query.name or query.id} took more than {timeout_s} s")


Sink = Callable[[DataFrame, int], None]


def append_batches(path: str, columns: list[str] | None = None) -> Sink:
    """A sink that owns one folder per micro-batch: a replayed batch replaces itself."""

    def write(df: DataFrame, batch_id: int) -> None:
        out = df.select(*columns) if columns else df
        out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch_id")


def write_messages(df: DataFrame, target: str | dict[str, str]) -> None:
    """Append one ``value`` column to a topic (options with ``topic``) or to a text table."""
    writer: DataFrameWriter = df.select("value").write
    if isinstance(target, dict):
        writer.format("kafka").options(**target).save()
    else:
        writer.mode("overwrite").text(target)


def fan_out(
    df: DataFrame,
    sinks: list[Callable[[DataFrame, int], None]],
    checkpoint: str,
    *,
    every: str | None = None,
) -> StreamingQuery:
    """Feed several sinks from one query: state, parsing and scoring run once per batch.

    Each sink gets ``(batch, batch_id)`` and must be idempotent per batch id.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    writer = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return trigger(writer, every).start()
