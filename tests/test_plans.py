"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from tickloom import fixtures as fx
from tickloom.operators import bars as b
from tickloom.operators import book, features, ingest
from tickloom.sources import Slice, decode_envelope, read_slice, replace_slice


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ran(df):
    """The final adaptive plan."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def norm(spark, sf_dir):
    return b.normalize(fx.mbo(spark, sf_dir))


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


def test_slice_scan_prunes_partitions_and_columns(spark, sf_dir, tmp_path):
    path = str(tmp_path / "t")
    fx.mbo_daily(spark, sf_dir).write.partitionBy(
        "session_date", "underlier", "instrument_type"
    ).parquet(path)
    text = plan(read_slice(spark, path, Slice("2024-01-15", "SYN", "FUT")).select("price"))
    for key in ("session_date", "underlier", "instrument_type"):
        assert f"({key}#" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert "ReadSchema: struct<price:double>" in text


def test_session_window_reaches_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "t")
    fx.mbo(spark, sf_dir).write.parquet(path)
    text = plan(ingest.session_window(spark.read.parquet(path), "2024-01-01", "13:00", "13:10"))
    assert "GreaterThanOrEqual(event_time," in text and "LessThan(event_time," in text


def test_bars_combine_before_their_only_shuffle(norm):
    text = plan(b.bars(norm))
    assert exchanges(text) == 1
    assert text.count("partial_count") == 1
    assert "bucket_ts" not in text.split("Exchange")[1]


def test_setup_vectors_sort_once(norm, spark, sf_dir, tmp_path):
    path = str(tmp_path / "p")
    b.feature_primitives(b.bars(norm)).write.parquet(path)
    text = plan(features.setup_vectors(spark.read.parquet(path)))
    assert exchanges(text) == 1
    assert len(re.findall(r"\bSort \[", text)) == 1


def test_time_label_needs_no_join(norm, spark, tmp_path):
    path = str(tmp_path / "p")
    b.feature_primitives(b.bars(norm)).write.parquet(path)
    rows = features.mid_change(spark.read.parquet(path))
    text = plan(features.forward_label(rows, by="time"))
    assert "Join" not in text and exchanges(text) == 1


def test_dedup_limits_groups_before_the_shuffle(norm):
    text = plan(ingest.dedup_batch(norm))
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_book_shuffles_its_events_once(norm, no_broadcast):
    text = ran(book.book_levels(norm))
    assert text.count("FileScan parquet") == 1
    assert "ReusedExchange" in text


@pytest.mark.parametrize("make", [b.bars, book.book_levels, book.book_top, book.book_snapshot,
                                  book.trade_stats])
def test_no_python_and_no_cartesian(norm, make):
    text = plan(make(norm))
    for word in ("Python", "Cartesian", "NestedLoop"):
        assert word not in text
    # A single partition is only ever one aggregated row.
    for piece in text.split("Exchange SinglePartition")[1:]:
        assert "HashAggregate(keys=[]" in piece[:400]


def test_row_numbers_come_without_a_single_partition_window(spark, sf_dir):
    from tickloom.operators.training import global_row_number

    text = plan(global_row_number(fx.mbo(spark, sf_dir)))
    assert "Window" not in text and "SinglePartition" not in text


def last_written_plan(spark):
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    return found.apply(found.size() - 1).physicalPlanDescription()


def test_slice_write_needs_no_sort(spark, sf_dir, tmp_path):
    """Rows of one slice need not be sorted by their constant keys."""
    rows = fx.mbo(spark, sf_dir).where(F.col("session_date") == "2024-01-01")
    replace_slice(rows, str(tmp_path / "t"), Slice("2024-01-01", "SYN", "FUT"))
    text = last_written_plan(spark)
    assert "InsertIntoHadoopFsRelationCommand" in text and "Sort" not in text


def test_json_is_parsed_once_per_row(spark, sf_dir):
    decoded = decode_envelope(fx.broker_rows(spark, sf_dir))
    for part in ingest.split_valid(decoded):
        assert plan(part).count("from_json(") == 1
