"""Every registered query against its SQL twin."""

import compare
import pytest

import __spark_entry__ as spark_entry


@pytest.mark.parametrize("name", list(spark_entry.queries()))
def test_query_matches_sql(spark, sf_dir, name):
    verdict = compare.compare(spark, sf_dir, name)
    assert verdict.startswith(("ok", "rows")), verdict


def test_every_sql_twin_has_a_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry_has_rows_and_a_stable_schema(spark):
    first, second = spark_entry.entry(spark), spark_entry.entry(spark)
    assert first.schema == second.schema
    assert first.count() == 371
