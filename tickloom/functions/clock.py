"""Epoch-nanosecond arithmetic. A long of nanoseconds is the truth; timestamps are derived from it.

Every expression here is independent of the session time zone and stays in long arithmetic, so the
last nanosecond of a bucket never rounds into the next one.
"""

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

EXCHANGE_TZ = "America/New_York"
SECOND_NS = 1_000_000_000
BAR_NS = 5 * SECOND_NS
_DAY_MICROS = 86_400_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def bucket_floor(ns: Column | str, width_ns: int = BAR_NS) -> Column:
    """Start of the bucket holding ``ns``; floors towards minus infinity."""
    ns = _col(ns)
    return ns - F.pmod(ns, F.lit(width_ns).cast("long"))


def bucket_index(ns: Column | str, width_ns: int) -> Column:
    return F.call_function("div", bucket_floor(ns, width_ns), F.lit(width_ns).cast("long"))


def _micros(ns: Column | str) -> Column:
    return bucket_index(ns, 1000)


def ns_to_timestamp(ns: Column | str) -> Column:
    """Instant (``TIMESTAMP``) with microsecond precision."""
    return F.timestamp_micros(_micros(ns))


def ns_to_utc(ns: Column | str) -> Column:
    """UTC wall clock (``TIMESTAMP_NTZ``), the same in every session zone."""
    return F.timestamp_add("MICROSECOND", _micros(ns), _epoch())


def _local_micros(ns: Column | str, tz: str) -> Column:
    # Plain arithmetic on microseconds, with the zone looked up once per query and not per row.
    return F.unix_micros(F.from_utc_timestamp(ns_to_timestamp(ns), tz))


def ns_to_local(ns: Column | str, tz: str = EXCHANGE_TZ) -> Column:
    """Wall clock of ``tz`` (``TIMESTAMP_NTZ``)."""
    return F.timestamp_add("MICROSECOND", _local_micros(ns, tz), _epoch())


def local_day(ns: Column | str, tz: str = EXCHANGE_TZ) -> Column:
    """Calendar day of ``ns`` in ``tz`` as ``yyyy-MM-dd``."""
    day = bucket_index(_local_micros(ns, tz), _DAY_MICROS)
    return F.date_from_unix_date(day.cast("int")).cast("string")


def session_bounds(
    session_date: str, start_time: str, end_time: str, tz: str = EXCHANGE_TZ
) -> tuple[int, int]:
    """Half-open ``[start, end)`` of a local session in epoch nanoseconds, DST aware."""
    zone = ZoneInfo(tz)
    start, end = (
        int(datetime.fromisoformat(f"{session_date}T{t}:00").replace(tzinfo=zone).timestamp())
        * SECOND_NS
        for t in (start_time, end_time)
    )
    if end <= start:
        raise ValueError(f"Empty session: {end_time} is not later than {start_time}")
    return start, end
