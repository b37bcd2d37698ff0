"""Date and time rules.  Dates travel as ``yyyyMMdd`` strings at the table edges."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's output formats and defaults).
DAY_FORMAT = "yyyyMMdd"
RELEASE_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME14_DEFAULT = "19700101000000"
TIME14_PAD = "000000"


def check_day(day: str) -> str:
    """Validate a ``yyyyMMdd`` job argument before any Spark work starts."""
    if not isinstance(day, str) or len(day) != 8 or not day.isdigit():
        raise ValueError(f"analysis date must be yyyyMMdd, got {day!r}")
    datetime.strptime(day, "%Y%m%d")
    return day


def day_minus(day: str, n: int) -> str:
    """Calendar days back from a ``yyyyMMdd`` argument (driver-side, a scalar)."""
    d = datetime.strptime(check_day(day), "%Y%m%d") - timedelta(days=n)
    return d.strftime("%Y%m%d")


def day_minus_col(day: Column | str, n: int) -> Column:
    """Column form of :func:`day_minus`."""
    c = F.col(day) if isinstance(day, str) else day
    return F.date_format(F.date_sub(F.to_date(c, DAY_FORMAT), n), DAY_FORMAT)


def day_of(ts: Column | str) -> Column:
    """``yyyyMMdd`` of a timestamp column."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c.cast("date"), DAY_FORMAT)


def split_timestamp(ts14: Column | str) -> tuple[Column, Column]:
    """``yyyyMMddHHmmss`` -> (``yyyyMMdd``, ``HHmmss``) by position."""
    c = F.col(ts14) if isinstance(ts14, str) else ts14
    return F.substring(c, 1, 8), F.substring(c, 9, 6)


def normalise_time14(s: Column | str) -> Column:
    """14 characters kept; 8 characters padded with ``000000``; anything else (NULL too) the default."""
    c = F.col(s) if isinstance(s, str) else s
    n = F.length(c)
    return (F.when(n == 14, c)
            .when(n == 8, F.concat(c, F.lit(TIME14_PAD)))
            .otherwise(F.lit(TIME14_DEFAULT)))


_DATETIME_PREFIX = r"^(\d{1,4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2})"


def release_time(s: Column | str) -> Column:
    """Release time text.

    1. a leading ``y-M-d H:m:s`` date-time is normalised to ``yyyy-MM-dd HH:mm:ss``
       (trailing text ignored, impossible dates fall through);
    2. else a number is read as epoch milliseconds (``1577145600000``, ``1.5771456E12``), UTC;
    3. else ``''``.
    """
    c = F.col(s) if isinstance(s, str) else s
    prefix = F.regexp_extract(c, _DATETIME_PREFIX, 1)
    parsed = F.try_to_timestamp(F.nullif(prefix, F.lit("")), F.lit("y-M-d H:m:s"))
    as_dt = F.date_format(parsed, RELEASE_FORMAT)
    # Plain decimal text only (no padding): what Java's BigDecimal accepts.
    numeric = c.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    millis = F.when(numeric, c.try_cast("decimal(38,6)").try_cast("bigint"))
    epoch = F.timestamp_add("MILLISECOND", millis, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    as_epoch = F.date_format(epoch, RELEASE_FORMAT)
    return F.coalesce(as_dt, as_epoch, F.lit(""))
