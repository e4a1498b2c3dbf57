"""Bounded runs: intake stamp of the training job, and the end of queries that overrun."""

import pytest
from events import events
from pyspark.sql import functions as F

from tickloom import fixtures as fx
from tickloom.plans import batch
from tickloom.sources import append_stream, finish, table_stream


def test_training_job_stamps_its_intake(spark, sf_dir, tmp_path):
    source = str(tmp_path / "broker")
    fx.broker_rows(spark, sf_dir).write.parquet(source)
    tables = {f"{t}_table": f"jobs_{t}" for t in ("events", "registry", "scores")}
    batch.train_and_score(
        table_stream(spark, source), model_path=str(tmp_path / "model"), checkpoint=str(tmp_path / "mark"),
        location=str(tmp_path / "tables"), timeout_s=120, **tables,
    )
    stamped = spark.table("jobs_events")
    assert dict(stamped.dtypes)["bronze_ingest_time"] == "timestamp"
    assert stamped.where(F.col("bronze_ingest_time").isNull()).isEmpty()
    assert spark.table("jobs_scores").count() == stamped.count() == spark.table("jobs_registry").first()["record_count"]


def test_an_overrunning_query_is_stopped(spark, tmp_path):
    events(spark, [{}]).write.parquet(str(tmp_path / "in"))
    rows = table_stream(spark, str(tmp_path / "in"))
    query = append_stream(rows, str(tmp_path / "out"), str(tmp_path / "mark"), every="1 second")
    query.processAllAvailable()
    with pytest.raises(TimeoutError, match="took more than 2 s"):
        finish(query, 2)
    assert not query.isActive
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
