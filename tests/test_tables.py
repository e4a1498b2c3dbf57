import pytest
from events import events
from pyspark.sql import functions as F

from tickloom.operators.bars import normalize
from tickloom.plans import batch
from tickloom.sources import Slice, read_slice, read_table, replace_slice, shared_dir

A = Slice("2024-01-01", "U", "FUT")
B = Slice("2024-01-02", "U", "FUT")


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = events(spark, [{}, {}])
    replace_slice(rows, path, A)
    replace_slice(rows.withColumn("session_date", F.lit("2024-01-02")), path, B)
    return path


def counts(spark, path):
    return {r["session_date"]: r["count"] for r in
            read_table(spark, path).groupBy("session_date").count().collect()}


def test_replacing_twice_equals_once(spark, table):
    for _ in range(2):
        assert replace_slice(events(spark, [{}] * 5), table, A) == 5
        assert counts(spark, table) == {"2024-01-01": 5, "2024-01-02": 2}


def test_a_row_outside_the_slice_fails_and_keeps_the_table(spark, table):
    rows = events(spark, [{}, {"underlier": "OTHER"}])
    with pytest.raises(Exception, match="row outside"):
        replace_slice(rows, table, A)
    assert counts(spark, table) == {"2024-01-01": 2, "2024-01-02": 2}


def test_empty_result_empties_only_its_slice(spark, table):
    assert replace_slice(events(spark, []), table, A) == 0
    assert counts(spark, table) == {"2024-01-02": 2}
    assert replace_slice(events(spark, [{}]), table, A) == 1
    assert counts(spark, table) == {"2024-01-01": 1, "2024-01-02": 2}


def test_empty_result_into_no_table(spark, tmp_path):
    assert replace_slice(events(spark, []), str(tmp_path / "none"), A) == 0


def test_slice_can_be_rewritten_from_itself(spark, table):
    rows = read_slice(spark, table, A).withColumn("size", F.col("size") + 1)
    replace_slice(rows, table, A)
    assert [r["size"] for r in read_slice(spark, table, A).collect()] == [2, 2]


def test_keys_stay_strings(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = events(spark, [{"underlier": "1"}])
    replace_slice(rows, path, Slice("2024-01-01", "1", "FUT"))
    found = read_slice(spark, path, Slice("2024-01-01", "1", "FUT")).first()
    assert (found["underlier"], found["session_date"]) == ("1", "2024-01-01")


def test_slice_parts_are_required():
    with pytest.raises(ValueError, match="underlier"):
        Slice("2024-01-01", "", "FUT")


def test_shared_dir_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = shared_dir(spark, "x")
    assert root is None or path.startswith(root)
    assert path != shared_dir(spark, "x")


def test_batch_jobs_end_to_end(spark, tmp_path):
    lake = batch.Lake(str(tmp_path / "lake"))
    with pytest.raises(Exception):
        batch.bronze_to_silver(spark, lake, A)
    replace_slice(events(spark, [{"side": s} for s in "BSBS"]), lake.path(batch.BRONZE), A)
    with pytest.raises(ValueError, match="No bronze"):
        batch.bronze_to_silver(spark, lake, B)
    for _ in range(2):
        batch.bronze_to_silver(spark, lake, A)
        batch.silver_to_gold(spark, lake, A)
    snapshot = batch.training_snapshot(spark, lake, A, str(tmp_path / "sets"), "2024-01-03")
    assert snapshot.endswith("/sets/U_MODEL/2024-01-03")
    found = spark.read.parquet(snapshot)
    assert found.count() == 1 and found.first()["model_id"] == "U_MODEL"
    norm = read_slice(spark, lake.path(batch.NORMALIZED), A)
    assert set(normalize(events(spark, [{}])).columns) == set(norm.columns)
    assert read_slice(spark, lake.path(batch.LABELS), A).count() == 1
    with pytest.raises(ValueError, match="run_date"):
        batch.training_snapshot(spark, lake, A, str(tmp_path), "")
