import hashlib

import pytest
from pyspark.sql import functions as F

from tickloom.operators import features, training

WIDTH = 5_000_000_000
KEYS = ["contract_id"]


def series(spark, mids, *, contract="C1", skip=()):
    rows = [(contract, i * WIDTH, m) for i, m in enumerate(mids) if i not in skip]
    return spark.createDataFrame(rows, "contract_id STRING, bucket_ns LONG, mid DOUBLE")


def values(df, column):
    return [r[column] for r in df.orderBy("contract_id", "bucket_ns").collect()]


def test_mid_change(spark):
    df = series(spark, [1.0, 3.0, None, 4.0])
    assert values(features.mid_change(df, KEYS), "mid_change") == [None, 2.0, None, None]
    assert values(features.mid_change(df, KEYS, first=0), "mid_change") == [0.0, 2.0, None, None]


def test_future_by_rows_and_by_time(spark):
    df = series(spark, [1.0, 2.0, 3.0, 4.0], skip=[1])
    assert values(features.mid_future(df, 2, KEYS), "mid_future") == [4.0, None, None]
    by_time = features.mid_future(df, 2, KEYS, by="time")
    assert values(by_time, "mid_future") == [3.0, None, None]
    with pytest.raises(ValueError):
        features.mid_future(df, 2, KEYS, by="luck")


def test_label(spark):
    df = series(spark, [1.0, 2.0, 2.0, 1.0, None, 5.0])
    assert values(features.forward_label(df, 1, KEYS), "label") == [1, 0, 0, None, 0, None]
    strict = features.forward_label(df, 1, KEYS, strict=True)
    assert values(strict, "label") == [1, 0, 0, None, None, None]


def test_sessions_do_not_reach_into_each_other(spark):
    days = series(spark, [1.0, 2.0]).withColumn("session_date", F.lit("d1")).unionByName(
        series(spark, [7.0]).withColumn("session_date", F.lit("d2"))
    )
    found = features.mid_change(days, ["session_date", *KEYS])
    assert found.where("session_date = 'd2'").first()["mid_change"] is None


def test_vector_and_hash(spark):
    df = spark.createDataFrame(
        [(None, 1.5, None, 4000.25, 3)],
        "ofi_ratio DOUBLE, spread DOUBLE, mid_change DOUBLE, vwap DOUBLE, event_count LONG",
    )
    row = features.hashes(features.vectors(df)).first()
    assert row["feature_vector"] == [0.0, 1.5, 0.0, 4000.25, 3.0]
    text = b"[0.0,1.5,0.0,4000.25,3.0]"
    assert row["feature_hash"] == hashlib.sha256(text).hexdigest()
    canonical = features.hashes(features.vectors(df), canonical=True).first()["feature_hash"]
    assert canonical == hashlib.sha256(b"0,1500000,0,4000250000,3000000").hexdigest()


def test_global_row_number(spark):
    n = 5000
    df = spark.range(n, numPartitions=7).select(
        ((F.col("id") * 7919) % 1000).alias("event_time"), F.col("id").alias("sequence")
    )
    found = training.global_row_number(df).orderBy("row_id").collect()
    assert [r["row_id"] for r in found] == list(range(1, n + 1))
    assert [tuple(r)[:2] for r in found] == sorted(tuple(r)[:2] for r in found)
