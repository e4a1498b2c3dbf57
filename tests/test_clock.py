from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickloom.functions import clock


def one(spark, column, ns):
    return spark.createDataFrame([(ns,)], "ns LONG").select(column.alias("v")).first()["v"]


BAR = 5_000_000_000


@pytest.mark.parametrize(
    "ns, start",
    [
        (0, 0),
        (BAR - 1, 0),
        (BAR, BAR),
        (-1, -BAR),
        (-BAR, -BAR),
        # A double cannot tell these two apart from the next bucket.
        (340_826_400 * BAR - 1, 340_826_399 * BAR),
        (340_826_400 * BAR, 340_826_400 * BAR),
    ],
)
def test_bucket_floor(spark, ns, start):
    assert one(spark, clock.bucket_floor("ns"), ns) == start


def test_last_nanosecond_stays_in_its_second(spark):
    ns = 1_704_132_000_999_999_999
    assert one(spark, clock.ns_to_utc("ns"), ns) == datetime(2024, 1, 1, 18, 0, 0, 999_999)
    assert one(spark, F.unix_micros(clock.ns_to_timestamp("ns")), ns) == 1_704_132_000_999_999


@pytest.mark.parametrize(
    "ns, wall",
    [
        # Clocks go from 02:00 to 03:00 on 2025-03-09 and from 02:00 back to 01:00 on 2025-11-02.
        (1_741_503_599_000_000_000, datetime(2025, 3, 9, 1, 59, 59)),
        (1_741_503_600_000_000_000, datetime(2025, 3, 9, 3, 0)),
        (1_762_063_199_000_000_000, datetime(2025, 11, 2, 1, 59, 59)),
        (1_762_063_200_000_000_000, datetime(2025, 11, 2, 1, 0)),
    ],
)
def test_local_time_over_clock_changes(spark, ns, wall):
    assert one(spark, clock.ns_to_local("ns"), ns) == wall


def test_local_day_differs_from_utc_day(spark):
    assert one(spark, clock.local_day("ns"), 1_704_164_399_000_000_000) == "2024-01-01"
    assert one(spark, clock.local_day("ns", "UTC"), 1_704_164_399_000_000_000) == "2024-01-02"


def test_session_bounds():
    start, end = clock.session_bounds("2025-10-01", "09:30", "11:30")
    assert start == 1_759_325_400_000_000_000
    assert end - start == 7_200 * 1_000_000_000
    start, end = clock.session_bounds("2025-03-09", "01:00", "04:00")
    assert end - start == 7_200 * 1_000_000_000
    with pytest.raises(ValueError, match="not later than"):
        clock.session_bounds("2025-10-01", "11:30", "11:30")
