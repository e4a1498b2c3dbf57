"""Scans of single slices."""

from pyspark.sql import functions as F

from tickloom.sources import Slice, read_slice, shared_dir
from tickloom.sources.stage import materialize

KEYS = ("session_date", "underlier", "instrument_type")


def _table(spark, kinds=("FUT", "a b")):
    path = shared_dir(spark, "slices")
    kind = F.element_at(F.array(*map(F.lit, kinds)), (F.col("id") % 2 + 1).cast("int"))
    days = F.concat(F.lit("2024-01-0"), (F.col("id") % 3 + 1).cast("string"))
    rows = spark.range(12).withColumns(
        {"session_date": days, "underlier": F.lit("SYN"), "instrument_type": kind}
    )
    rows.write.partitionBy(*KEYS).parquet(path)
    return path


def test_only_the_folder_of_the_slice_is_listed(spark):
    path = _table(spark)
    found = read_slice(spark, path, Slice("2024-01-01", "SYN", "FUT"))
    own = "session_date=2024-01-01/underlier=SYN/instrument_type=FUT/"
    plan = found._jdf.queryExecution().optimizedPlan()
    assert all(own in f for f in found.inputFiles()), plan
    assert sorted(r["id"] for r in found.collect()) == [0, 6]
    assert dict(found.dtypes)["session_date"] == "string"


def test_a_value_that_spark_escapes_and_a_missing_slice(spark):
    path = _table(spark)
    spaced = read_slice(spark, path, Slice("2024-01-02", "SYN", "a b"))
    assert sorted(r["id"] for r in spaced.collect()) == [1, 7]
    assert read_slice(spark, path, Slice("2030-01-01", "SYN", "FUT")).isEmpty()


def test_replay_stages_its_input_once(spark, monkeypatch):
    from tickloom.streaming import replay

    staged = []
    monkeypatch.setattr(
        replay, "materialize", lambda df, name: staged.append(name) or materialize(df, name)
    )
    path = replay.stage_slices(spark.range(100), "id", slices=2, files=3)
    assert staged == ["replay-input"]
    assert len(spark.read.parquet(path).inputFiles()) == 6
    assert spark.read.parquet(path).distinct().count() == 100


def test_sparse_spans_have_as_many_files_as_full_ones(spark):
    from tickloom.streaming.replay import stage_slices

    ends = spark.range(2).withColumn("at", F.col("id") * 1000)
    path = stage_slices(ends, "at", slices=4, files=3)
    assert len(spark.read.parquet(path).inputFiles()) == 12
    assert spark.read.parquet(path).count() == 2


def test_a_larger_table_is_replayed_from_more_files(spark, monkeypatch):
    from tickloom.streaming import replay

    monkeypatch.setattr(replay, "FILE_BYTES", 1 << 10)
    small = replay.stage(spark.range(40), "id")
    large = replay.stage(spark.range(40_000), "id")
    assert small.files == replay.LEAST_FILES < large.files
    rows = large.stream(spark)
    assert rows.isStreaming
    assert len(spark.read.parquet(large.path).inputFiles()) == 4 * large.files
