"""Column layouts of the tables and messages the operators exchange.

All names, types and orders below are fixed values: tables and messages of other writers have them.
"""

from pyspark.sql import types as T

SLICE_KEYS = ["session_date", "underlier", "instrument_type"]
SERIES_KEYS = SLICE_KEYS + ["contract_id"]
BAR_KEYS = SERIES_KEYS + ["bucket_ns", "bucket_ts"]
DEDUP_KEYS = ["contract_id", "order_id", "event_time"]


STRING = T.StringType()
LONG = T.LongType()
INT = T.IntegerType()
DOUBLE = T.DoubleType()
DOUBLES = T.ArrayType(DOUBLE)
TIMESTAMP = T.TimestampType()
BINARY = T.BinaryType()


def struct(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


ENVELOPE = struct(
    event_time=LONG,
    ingest_time=LONG,
    venue=STRING,
    symbol=STRING,
    instrument_type=STRING,
    underlier=STRING,
    contract_id=STRING,
    action=STRING,
    order_id=LONG,
    side=STRING,
    price=DOUBLE,
    size=LONG,
    sequence=LONG,
    payload=STRING,
)
ENVELOPE_COLUMNS = ENVELOPE.fieldNames()

# Row shape of a Kafka-protocol source, as far as the decoder needs it.
BROKER = struct(
    value=BINARY,
    timestamp=TIMESTAMP,
    offset=LONG,
    partition=INT,
)

DEAD_LETTER_COLUMNS = [
    "raw_record",
    "error_message",
    "source_partition",
    "source_offset",
    "ingestion_timestamp",
    "retry_count",
]

PAYLOAD_FIELDS = [
    "instrument_id",
    "publisher_id",
    "flags",
    "channel_id",
    "ts_in_delta",
    "rtype",
]

ORDERBOOK_COLUMNS = BAR_KEYS + [
    "best_bid",
    "best_ask",
    "mid",
    "spread",
    "buy_size",
    "sell_size",
]
PRIMITIVE_COLUMNS = BAR_KEYS + [
    "event_count",
    "size_total",
    "buy_size",
    "sell_size",
    "ofi",
    "ofi_ratio",
    "vwap",
    "mid",
    "spread",
]
SETUP_COLUMNS = [
    "vector_time",
    "model_id",
    "contract_id",
    "lookback_spec",
    "feature_vector",
    "feature_hash",
    "label",
    "data_version",
] + SLICE_KEYS
LABEL_COLUMNS = ["vector_time", "model_id", "contract_id", "feature_hash", "label"] + SLICE_KEYS

STREAM_BAR = struct(
    contract_id=STRING,
    bucket_ns=LONG,
    bucket_ts=TIMESTAMP,
    session_date=STRING,
    underlier=STRING,
    instrument_type=STRING,
    event_count=LONG,
    size_total=LONG,
    buy_size=LONG,
    sell_size=LONG,
    vwap=DOUBLE,
    ofi=LONG,
    ofi_ratio=DOUBLE,
    mid=DOUBLE,
    spread=DOUBLE,
    best_bid=DOUBLE,
    best_ask=DOUBLE,
)
STREAM_VECTOR = struct(
    contract_id=STRING,
    vector_time=LONG,
    session_date=STRING,
    underlier=STRING,
    instrument_type=STRING,
    ofi_ratio=DOUBLE,
    spread=DOUBLE,
    mid_change=DOUBLE,
    vwap=DOUBLE,
    event_count=LONG,
    feature_vector=DOUBLES,
)
SCORE_RESULT = struct(
    prediction=INT,
    prob_0=DOUBLE,
    prob_1=DOUBLE,
    error_message=STRING,
)

VECTOR_MESSAGE = [
    "contract_id",
    "vector_time",
    "model_id",
    "ofi_ratio",
    "spread",
    "mid_change",
    "vwap",
    "event_count",
]
SCORE_MESSAGE = [
    "contract_id",
    "vector_time",
    "model_id",
    "model_version",
    "close_price",
    "prediction",
    "prob_0",
    "prob_1",
    "inference_error",
    "inference_time",
]
