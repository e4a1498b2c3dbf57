"""Broker segments as a stream: offsets, start position and intake cap."""

import json
import time

import pytest
from pyspark.sql import functions as F

from tickloom.schemas import BROKER
from tickloom.sources import append_batches, fan_out, finish, read_segments, write_segments


def broker(spark, low, high, partitions=2):
    rows = spark.range(low, high).select(
        F.col("id").cast("string").cast("binary").alias("value"),
        F.timestamp_micros(F.col("id")).alias("timestamp"),
        F.col("id").alias("offset"),
        (F.col("id") % partitions).cast("int").alias("partition"),
    )
    return rows.to(BROKER)


class Run:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.source, self.out, self.mark = f"{root}/segments", f"{root}/out", f"{root}/mark"

    def start(self, every=None, **options):
        rows = read_segments(self.spark, self.source, **options)
        return fan_out(rows, [append_batches(self.out)], self.mark, every=every)

    def drain(self, **options):
        query = self.start(every="0 seconds", **options)
        query.processAllAvailable()
        query.stop()

    def batches(self):
        got = {}
        for r in self.spark.read.parquet(self.out).select("batch_id", "offset").collect():
            got.setdefault(r["batch_id"], []).append(r["offset"])
        return [sorted(got[k]) for k in sorted(got)]


@pytest.fixture
def run(spark, tmp_path):
    made = Run(spark, str(tmp_path))
    assert write_segments(broker(spark, 0, 40), made.source, 8) == 10
    return made


def test_earliest_reads_all_and_later_runs_only_what_is_new(spark, run):
    finish(run.start(starting_offsets="earliest"), 120)
    write_segments(broker(spark, 40, 50), run.source, 8)
    finish(run.start(starting_offsets="earliest"), 120)
    assert run.batches() == [list(range(40)), list(range(40, 50))]
    row = spark.read.parquet(run.out).where("offset = 7").first()
    assert (bytes(row["value"]), row["partition"]) == (b"7", 1)


def test_latest_begins_behind_what_is_there(spark, run):
    query = run.start(every="0 seconds", starting_offsets="latest")
    query.processAllAvailable()
    write_segments(broker(spark, 40, 44), run.source, 8)
    query.processAllAvailable()
    query.stop()
    assert sum(run.batches(), []) == [40, 41, 42, 43]


def test_a_position_inside_a_segment(spark, run):
    finish(run.start(starting_offsets=json.dumps({"0": 30, "1": 39})), 120)
    assert sum(run.batches(), []) == [30, 32, 34, 36, 38, 39]


def test_the_cap_holds_for_every_batch_and_after_a_restart(spark, run):
    options = dict(starting_offsets="earliest", max_offsets=20, position=f"{run.root}/position")
    finish(run.start(**options), 120)  # a run-once query takes one capped batch
    assert run.batches() == [list(range(0, 10))] or [len(b) for b in run.batches()] == [10]
    run.drain(**options)
    assert [len(b) for b in run.batches()] == [10, 10, 10, 10]
    assert sorted(sum(run.batches(), [])) == list(range(40))


def test_a_segment_written_again_replaces_itself(spark, run):
    write_segments(broker(spark, 0, 40), run.source, 8)
    finish(run.start(starting_offsets="earliest"), 120)
    assert run.batches() == [list(range(40))]


def test_a_cap_needs_a_position(spark, tmp_path):
    with pytest.raises(ValueError, match="go together"):
        read_segments(spark, str(tmp_path), max_offsets=5)


def test_a_timed_query_goes_on_until_it_is_stopped(spark, run):
    """The continuous trigger: two batches of one query, a second apart or more."""
    query = run.start(every="1 second", starting_offsets="earliest")
    query.processAllAvailable()
    write_segments(broker(spark, 40, 42), run.source, 8)
    deadline = time.time() + 60
    while len(run.batches()) < 2 and time.time() < deadline:
        time.sleep(0.2)
    assert query.isActive
    query.stop()
    assert [len(b) for b in run.batches()] == [40, 2]
