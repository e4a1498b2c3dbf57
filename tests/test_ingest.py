import json

import pytest
from events import T0, events
from pyspark.sql import functions as F

from tickloom.operators import ingest
from tickloom.operators.guards import (
    guard_nonempty,
    guard_training_set,
    optional_columns,
    require_columns,
)
from tickloom.schemas import BROKER, ENVELOPE_COLUMNS
from tickloom.sources import broker_options, decode_envelope, raw_to_envelope

GOOD = {"event_time": 1, "contract_id": "C1", "action": "A", "price": 1.5, "size": 2}


def broker(spark, bodies):
    rows = [(None if v is None else v.encode(), None, i, i % 2) for i, v in enumerate(bodies)]
    return decode_envelope(spark.createDataFrame(rows, BROKER))


@pytest.mark.parametrize(
    "body, reason",
    [
        ("not json", ingest.PARSE_FAILURE),
        ('{"event_time":1', ingest.PARSE_FAILURE),
        ("[1]", ingest.PARSE_FAILURE),
        ('""', ingest.PARSE_FAILURE),
        ("", ingest.PARSE_FAILURE),
        (None, ingest.PARSE_FAILURE),
        (json.dumps({**GOOD, "size": "many"}), ingest.PARSE_FAILURE),
        ("{}", ingest.MISSING_FIELD),
        (json.dumps({**GOOD, "action": None}), ingest.MISSING_FIELD),
        (json.dumps(GOOD), None),
        (json.dumps({**GOOD, "unknown": [1]}), None),
    ],
)
def test_rows_are_valid_or_dead_but_never_both(spark, body, reason):
    valid, dead = ingest.split_valid(broker(spark, [body]))
    found = dead.collect()
    assert (valid.count(), len(found)) == ((1, 0) if reason is None else (0, 1))
    if found:
        (row,) = found
        assert (row["raw_record"], row["error_message"]) == (body, reason)
        assert (row["source_partition"], row["source_offset"], row["retry_count"]) == (0, "0", 0)
        assert row["ingestion_timestamp"] is not None


def test_dedup_keeps_the_first_by_sequence(spark):
    rows = [{"order_id": 1, "sequence": s} for s in (5, 3, 4)] + [{"order_id": 2}]
    df = events(spark, rows)
    found = ingest.dedup_batch(df).orderBy("order_id").collect()
    assert [(r["order_id"], r["sequence"]) for r in found] == [(1, 3), (2, 3)]


def test_session_window_is_half_open(spark):
    start, end = T0 - 5 * 3600 * 10**9, T0  # 08:00 and 13:00 in New York
    df = events(spark, [{"event_time": t} for t in (start - 1, start, end - 1, end)])
    found = ingest.session_window(df, "2024-01-01", "08:00", "13:00").collect()
    assert [r["event_time"] for r in found] == [start, end - 1]


def test_outright_takes_the_hyphen_literally(spark):
    df = spark.createDataFrame([("ESZ4",), ("ESZ4-ESH5",), (".",), ("A_B",)], "symbol STRING")
    assert {r["symbol"] for r in ingest.outright_only(df).collect()} == {"ESZ4", ".", "A_B"}


def test_raw_to_envelope_scales_prices_and_packs_nulls(spark):
    df = spark.createDataFrame(
        [(1, 2, 160, "C1", "A", "B", 7, 4_000_250_000_000, 3, 9, 11, 12, None, 14, 15)],
        "ts_event LONG, ts_recv LONG, rtype INT, symbol STRING, action STRING, side STRING,"
        " order_id LONG, price LONG, size LONG, sequence LONG, instrument_id INT,"
        " publisher_id INT, flags INT, channel_id INT, ts_in_delta INT",
    )
    options = {"venue": "V", "underlier": "U", "instrument_type": "FUT", "price_scale": 1e9}
    out = raw_to_envelope(df, **options)
    assert out.columns == ENVELOPE_COLUMNS
    row = out.first()
    assert row["price"] == 4000.25
    assert row["payload"] == (
        '{"instrument_id":11,"publisher_id":12,"flags":null,"channel_id":14,"ts_in_delta":15,'
        '"rtype":160}'
    )
    with pytest.raises(ValueError, match="Missing raw columns"):
        raw_to_envelope(df.drop("flags"), **options)


def test_guards(spark):
    empty = spark.createDataFrame([], "label INT")
    with pytest.raises(ValueError, match="No bronze rows"):
        guard_nonempty(empty, "bronze")
    with pytest.raises(ValueError, match="minimum of 10"):
        guard_training_set(empty)
    with pytest.raises(ValueError, match="two|2 label classes"):
        guard_training_set(spark.range(20).select(F.lit(1).alias("label")))
    with pytest.raises(ValueError, match="x"):
        require_columns(empty, ["x"])
    assert optional_columns(empty, {"label": F.lit("no"), "y": F.lit(None).cast("int")}).dtypes == [
        ("label", "int"), ("y", "int")
    ]


def test_broker_options():
    options = broker_options("h:9093", "t", group="g", max_offsets=5, security={"a": "b"})
    assert options["subscribe"] == "t" and options["maxOffsetsPerTrigger"] == "5"
    assert options["kafka.group.id"] == "g" and options["a"] == "b"
    assert options["startingOffsets"] == "latest"
    with pytest.raises(ValueError, match="topic is required"):
        broker_options("h", "")
