"""Publication by manifests: all of a replacement or nothing of it."""

import pytest
from events import events
from pyspark.sql import functions as F

from tickloom.sources import (
    Slice,
    append_batches,
    finish,
    follow_batches,
    publish,
    publish_batches,
    publish_slice,
    read_batches,
    read_published,
    read_published_batches,
)

A = Slice("2024-01-01", "U", "FUT")
B = Slice("2024-01-02", "U", "FUT")


def rows(spark, n, part=A):
    made = events(spark, [{"order_id": i} for i in range(n)])
    return made.withColumn("session_date", F.lit(part.session_date))


def count(spark, root, *args, **options):
    return read_published(spark, root, *args, **options).count()


@pytest.fixture
def root(spark, tmp_path):
    path = str(tmp_path / "table")
    publish_slice(rows(spark, 2), path, A)
    publish_slice(rows(spark, 3, B), path, B)
    return path


class Killed(Exception):
    pass


def test_a_slice_is_replaced_and_others_stay(spark, root):
    assert publish_slice(rows(spark, 5), root, A) == 5
    assert (count(spark, root, A), count(spark, root, B), count(spark, root)) == (5, 3, 8)
    assert count(spark, root, A, version=0) == 2  # what was there before


def test_a_writer_killed_ahead_of_the_manifest_changes_nothing(spark, root, monkeypatch):
    def killed(*args):
        raise Killed

    monkeypatch.setattr(publish, "_write_manifest", killed)
    with pytest.raises(Killed):
        publish_slice(rows(spark, 7), root, A)
    assert count(spark, root, A) == 2 and count(spark, root) == 5
    monkeypatch.undo()
    publish_slice(rows(spark, 1), root, A)
    assert count(spark, root, A) == 1


def test_a_reader_keeps_what_it_has_begun_with(spark, root):
    before = read_published(spark, root, A)
    publish_slice(rows(spark, 9), root, A)
    assert before.count() == 2


def test_a_row_outside_fails_and_keeps_the_slice(spark, root):
    with pytest.raises(Exception, match="row outside"):
        publish_slice(rows(spark, 1, B), root, A)
    assert count(spark, root, A) == 2


def test_an_empty_result_empties_the_slice(spark, root):
    assert publish_slice(rows(spark, 0), root, A) == 0
    assert count(spark, root, A) == 0 and count(spark, root) == 3
    assert read_published(spark, root, A).columns == rows(spark, 0).columns


def test_a_slice_can_be_made_from_itself(spark, root):
    publish_slice(read_published(spark, root, A).withColumn("size", F.lit(77)), root, A)
    assert [r["size"] for r in read_published(spark, root, A).collect()] == [77, 77]


def test_names_that_are_no_paths(spark, root):
    odd = Slice("2024-01-01", "a/b;c=é", "FUT")
    publish_slice(rows(spark, 2).withColumn("underlier", F.lit(odd.underlier)), root, odd)
    assert count(spark, root, odd) == 2 and count(spark, root, A) == 2


def test_nothing_published(spark, tmp_path):
    with pytest.raises(ValueError, match="nothing published"):
        read_published(spark, str(tmp_path / "none"), A)


def test_followers_see_a_replayed_batch_once(spark, tmp_path, monkeypatch):
    root, out, mark = (str(tmp_path / n) for n in ("root", "out", "mark"))
    sink = publish_batches(root)
    follow = lambda: finish(follow_batches(spark, root, append_batches(out), mark), 120)
    sink(rows(spark, 4), 0)
    follow()
    sink(rows(spark, 4), 0)  # replayed whole

    def killed(*args):
        raise Killed

    monkeypatch.setattr(publish, "_write_manifest", killed)
    with pytest.raises(Killed):
        sink(rows(spark, 5), 1)
    follow()
    assert read_batches(spark, out).count() == 4
    monkeypatch.undo()
    sink(rows(spark, 5), 1)
    sink(rows(spark, 5), 1)
    follow()
    assert read_batches(spark, out).count() == read_published_batches(spark, root).count() == 9
