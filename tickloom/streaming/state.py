"""Reading what a streaming query holds in its state store, from its checkpoint."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _operator(spark: SparkSession, checkpoint: str, name: str) -> int:
    """Number of the query's operator that has a variable of this name."""
    for row in spark.read.format("state-metadata").load(checkpoint).collect():
        variables = json.loads(row["operatorProperties"] or "{}").get("stateVariables", [])
        if any(v["stateName"] == name for v in variables):
            return row["operatorId"]
    raise ValueError(f"no state variable {name} in {checkpoint}")


def state_variable(
    spark: SparkSession, checkpoint: str, name: str, *, batch_id: int | None = None
) -> DataFrame:
    """The key of each entry and its fields, as of the last committed batch or an earlier one.

    A list gives a row per element. Each partition of the store is read by a task of its own.
    """
    reader = (
        spark.read.format("statestore")
        .option("operatorId", _operator(spark, checkpoint, name))
        .option("stateVarName", name)
    )
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    rows = reader.load(checkpoint)
    fields = ["key.*"]
    if "user_map_key" in rows.columns:
        fields += ["user_map_key.*", "user_map_value.*"]
    elif "list_element" in rows.columns:
        fields += ["list_element.*"]
    else:
        fields += ["value.*"]
    return rows.select(*fields, "partition_id")


def book_levels(spark: SparkSession, checkpoint: str, *, batch_id: int | None = None) -> DataFrame:
    """The live levels of every contract in the state of a ``book_stream`` query."""
    levels = state_variable(spark, checkpoint, "levels", batch_id=batch_id)
    return levels.select(
        "contract_id",
        F.col("side").alias("side_sign"),
        "price",
        F.col("size").alias("level_size"),
    )
