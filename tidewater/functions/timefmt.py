"""Time conversions.

The session time zone is UTC (``session.ensure_scale_conf``); wall-clock
text is read and written in an explicit zone, by default the reference's
UTC+8.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT_TS = "yyyy-MM-dd HH:mm:ss"
DEFAULT_ZONE = "+08:00"  # fixed value: the reference parses and prints at UTC+8


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def millis_to_text(ms, zone: str = DEFAULT_ZONE) -> Column:
    """epoch millis -> ``yyyy-MM-dd HH:mm:ss`` wall time in ``zone``."""
    return F.date_format(F.from_utc_timestamp(F.timestamp_millis(_c(ms)), zone), TEXT_TS)


def text_to_millis(text, zone: str = DEFAULT_ZONE) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` wall time in ``zone`` -> epoch millis."""
    return F.unix_millis(F.to_utc_timestamp(F.try_to_timestamp(_c(text), F.lit(TEXT_TS)), zone))


def numeric_text_to_millis(text) -> Column:
    """epoch millis written as text -> number (null when not numeric)."""
    return _c(text).try_cast("long")


def date_and_hour(ts) -> tuple[Column, Column]:
    """``yyyy-MM-dd`` and ``HH`` of a timestamp."""
    t = _c(ts)
    return F.date_format(t, "yyyy-MM-dd"), F.date_format(t, "HH")
