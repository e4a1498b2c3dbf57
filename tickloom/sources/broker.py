"""Kafka-protocol source and the decoding of its rows."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.schemas import ENVELOPE

CORRUPT = "_corrupt_record"


def broker_options(
    servers: str,
    topic: str,
    *,
    group: str | None = None,
    starting_offsets: str = "latest",
    max_offsets: int | None = None,
    request_timeout_ms: int = 60_000,
    session_timeout_ms: int = 30_000,
    security: dict[str, str] | None = None,
) -> dict[str, str]:
    """Source options; ``security`` holds protocol and login settings and passes through."""
    for name, value in (("servers", servers), ("topic", topic)):
        if not value:
            raise ValueError(f"{name} is required")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "kafka.request.timeout.ms": str(request_timeout_ms),
        "kafka.session.timeout.ms": str(session_timeout_ms),
        **(security or {}),
    }
    if group:
        options["kafka.group.id"] = group
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_broker(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Needs Spark's Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**options).load()


def parse_json(body: str, schema: T.StructType = ENVELOPE) -> F.Column:
    """Parsed struct; text that does not fit ``schema`` is kept in its corrupt-record field."""
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return F.from_json(
        body, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )


def decode_envelope(df: DataFrame, schema: T.StructType = ENVELOPE) -> DataFrame:
    """Body text, parsed ``data`` and source position of rows shaped like a broker's.

    The parsed struct comes out of a one-element explode: what is asked of its fields further up
    then reads the result, where a plain projection would be copied into each such expression and
    parse the text again.
    """
    return df.select(
        F.col("value").cast("string").alias("body"),
        F.col("timestamp").alias("enqueued_time"),
        F.col("offset").cast("string").alias("source_offset"),
        F.col("offset").alias("source_sequence"),
        F.col("partition").alias("source_partition"),
    ).select("*", F.explode(F.array(parse_json("body", schema))).alias("data"))
