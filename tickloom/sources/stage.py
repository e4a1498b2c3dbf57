"""Intermediate tables in the shared folder that ``spark.checkpoint.dir`` names.

A written table cuts lineage and outlives lost executors, and column pruning still applies when it
is read back. Files stay until the folder's owner clears them, as checkpoint files do.
"""

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_LET_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unused path for ``name`` below the session's shared folder.

    Where neither the setting nor the session names one, it is below the session's warehouse, which
    executors share as well.
    """
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shared"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def shuffles_let_go(spark: SparkSession):
    """Queries within leave no shuffle files behind; the session's setting comes back afterwards."""
    before = spark.conf.get(_LET_GO, None)
    spark.conf.set(_LET_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(_LET_GO) if before is None else spark.conf.set(_LET_GO, before)


def materialize(df: DataFrame, name: str, compression: str | None = None, let_go: bool = False) -> DataFrame:
    """Write ``df`` once and return the written table.

    With ``let_go`` its shuffles go at once, not when the driver happens to collect its garbage,
    which may be long after the disk is full.
    """
    path = shared_dir(df.sparkSession, name)
    with shuffles_let_go(df.sparkSession) if let_go else contextlib.nullcontext():
        df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
