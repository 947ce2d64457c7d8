"""Conversions between epoch milliseconds, timestamps and text.

All of them follow ``spark.sql.session.timeZone``: there is one zone setting
for parsing and for printing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of the data model.
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_FORMAT = "yyyyMMdd"

MS_PER_YEAR = 365 * 24 * 60 * 60 * 1000


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ms_to_timestamp(ms: Column | str) -> Column:
    return F.timestamp_millis(col(ms))


def ms_to_day(ms: Column | str) -> Column:
    """Epoch milliseconds to ``yyyyMMdd`` text."""
    return F.date_format(ms_to_timestamp(ms), DAY_FORMAT)


def ms_to_date(ms: Column | str) -> Column:
    """Epoch milliseconds to a date; cheaper to compare than text."""
    return F.to_date(ms_to_timestamp(ms))


def text_to_timestamp(text: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to a timestamp, null where malformed."""
    return F.try_to_timestamp(col(text), F.lit(SECOND_FORMAT))


def text_to_ms(text: Column | str) -> Column:
    return F.unix_millis(text_to_timestamp(text))


def timestamp_to_text(ts: Column | str) -> Column:
    return F.date_format(col(ts), SECOND_FORMAT)


def age_in_years(birthday: Column | str, as_of: Column | None = None) -> Column:
    """Whole 365-day years from a birthday until ``as_of`` (default: now)."""
    as_of = F.current_timestamp() if as_of is None else as_of
    elapsed = F.unix_millis(as_of.cast("timestamp")) - F.unix_millis(col(birthday).cast("timestamp"))
    # Integral division truncates toward zero, so an unborn user is 0, not -1.
    return F.call_function("div", elapsed, F.lit(MS_PER_YEAR)).cast("int")
