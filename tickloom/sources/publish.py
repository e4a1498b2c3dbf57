"""Atomic publication: rows first, then one small manifest that makes them count.

Rows go to a fresh folder that nobody reads yet. The manifest, a file of one line that names the
folder, is put in place last, by a single rename. A reader follows manifests and never lists rows'
folders, so that it sees all of a publication or nothing of it; what a killed writer leaves is never
read. Earlier versions stay readable until their folders are cleared.

Below a root: ``rows/<name>`` has the rows of one publication, ``slices/...`` the manifests of one
slice each, ``batches`` those of micro-batches. One writer at a time may publish to a slice.
"""

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom.sources.sinks import Sink, trigger
from tickloom.sources.tables import NO_FILES, Slice, checked_slice

_MANIFEST = "name STRING, version LONG, folder STRING, row_count LONG, row_schema STRING"


def _read_manifests(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(_MANIFEST).json(path)
    except AnalysisException as e:
        if e.getCondition() in NO_FILES:
            return None
        raise


def _latest(manifests: DataFrame | None, upto: int | None = None) -> list:
    """The manifest that counts for each name: that of the highest version, up to a given one."""
    if manifests is None:
        return []
    if upto is not None:
        manifests = manifests.where(F.col("version") <= upto)
    newest = F.max_by(F.struct("*"), F.struct("version", "folder")).alias("m")
    return manifests.groupBy("name").agg(newest).select("m.*").collect()


def _write_rows(df: DataFrame, root: str) -> tuple[str, int]:
    """Rows into a folder of their own; its name below the root, and their number."""
    seen = Observation()
    folder = f"rows/{uuid.uuid4().hex}"
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{root}/{folder}")
    return folder, seen.get["rows"]


def _write_manifest(df: DataFrame, path: str, name: str, version: int, folder: str, rows: int) -> None:
    """One row from one task is one file, which the commit of the job renames into place."""
    row = (name, version, folder, rows, df.schema.json())
    spark = df.sparkSession
    spark.createDataFrame([row], _MANIFEST).coalesce(1).write.mode("append").json(path)


def _read_rows(spark: SparkSession, root: str, found: list) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(found[-1]["row_schema"]))
    folders = [f"{root}/{m['folder']}" for m in found if m["row_count"]]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def _slice_path(root: str, part: Slice) -> str:
    """The folder of a slice's manifests; a hash, since a slice's name need not do as a path."""
    return f"{root}/slices/{hashlib.sha256(repr(part).encode()).hexdigest()[:32]}"


def publish_slice(df: DataFrame, root: str, part: Slice) -> int:
    """Replace one slice at once; returns the rows written.

    A row outside the slice fails the job that writes the rows, and the old slice stays, as it does
    whenever the writer ends before the manifest is in place. An empty result empties the slice.
    """
    root, spark = root.rstrip("/"), df.sparkSession
    path = _slice_path(root, part)
    folder, rows = _write_rows(checked_slice(df, part), root)
    known = _latest(_read_manifests(spark, path))
    _write_manifest(df, path, repr(part), known[0]["version"] + 1 if known else 0, folder, rows)
    return rows


def read_published(
    spark: SparkSession, root: str, part: Slice | None = None, *, version: int | None = None
) -> DataFrame:
    """One slice, or all, as last published or as of a version; only their manifests are listed."""
    root = root.rstrip("/")
    path = _slice_path(root, part) if part else f"{root}/slices/*"
    found = _latest(_read_manifests(spark, path), version)
    if not found:
        raise ValueError(f"nothing published in {root}" + (f" for {part}" if part else ""))
    return _read_rows(spark, root, found)


def publish_batches(root: str) -> Sink:
    """A sink that publishes each micro-batch once: a replayed one that is there already is left out."""
    root = root.rstrip("/")

    def write(df: DataFrame, batch_id: int) -> None:
        path = f"{root}/batches"
        known = _read_manifests(df.sparkSession, path)
        if known is not None and not known.where(F.col("version") == batch_id).isEmpty():
            return
        folder, rows = _write_rows(df, root)
        _write_manifest(df, path, str(batch_id), batch_id, folder, rows)

    return write


def read_published_batches(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all published micro-batches."""
    root = root.rstrip("/")
    found = _latest(_read_manifests(spark, f"{root}/batches"))
    if not found:
        raise ValueError(f"nothing published in {root}")
    return _read_rows(spark, root, found)


def follow_batches(
    spark: SparkSession,
    root: str,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    max_batches: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """A stream over what ``publish_batches`` has published; ``each`` gets rows and a batch number.

    It follows manifests, so a batch that its writer has replayed, or died over, is seen once. What
    reaches the driver is the list of new folders, ``max_batches`` a trigger where that is set.
    """
    root = root.rstrip("/")
    reader = spark.readStream.schema(_MANIFEST)
    if max_batches is not None:
        reader = reader.option("maxFilesPerTrigger", max_batches)

    def hand_on(manifests: DataFrame, batch_id: int) -> None:
        found = sorted(manifests.collect(), key=lambda m: m["version"])
        if found:
            each(_read_rows(manifests.sparkSession, root, found), batch_id)

    writer = reader.json(f"{root}/batches").writeStream.foreachBatch(hand_on).option("checkpointLocation", checkpoint)
    return trigger(writer, every).start()
