"""Date column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Offsets are dropped before parsing so that the date stays the one written.
_RFC_DATE = r"(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2})"
_ISO_DATE_TIME = r"^\s*(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})"
_ISO_DATE = r"^\s*(\d{4}-\d{2}-\d{2})\s*$"


def as_timestamp(column) -> Column:
    """Lenient parse: unparsable text becomes NULL."""
    return F.try_to_timestamp(_c(column))


def feed_date(column) -> Column:
    """Date of a feed item from RFC-822, ISO date-time or ISO date text; NULL otherwise."""
    column = _c(column)
    forms = [(_RFC_DATE, "d MMM yyyy HH:mm:ss"),
             (_ISO_DATE_TIME, "yyyy-MM-dd'T'HH:mm:ss"),
             (_ISO_DATE, "yyyy-MM-dd")]
    # Parsing is tried on the matching form only: a failed parse is an exception inside.
    parsed = F
    for pattern, form in forms:
        parsed = parsed.when(F.rlike(column, F.lit(pattern)),
                             F.try_to_timestamp(F.regexp_extract(column, pattern, 1), F.lit(form)))
    return F.to_date(parsed)


def date_parts(column, prefix: str = "") -> list[Column]:
    """Year, month and day columns."""
    column = _c(column)
    return [F.year(column).alias(f"{prefix}year"),
            F.month(column).alias(f"{prefix}month"),
            F.dayofmonth(column).alias(f"{prefix}day")]


def epoch_seconds(column) -> Column:
    return F.unix_timestamp(_c(column).cast("timestamp"))


def within_hours(column, anchor, hours: int) -> Column:
    """Strictly newer than ``hours`` before the anchor."""
    return _c(column) > anchor - F.make_dt_interval(hours=F.lit(hours))


def within_days(column, anchor, days: int) -> Column:
    """Not older than ``days`` before the anchor."""
    return _c(column) >= anchor - F.make_dt_interval(days=F.lit(days))


def _c(column) -> Column:
    return F.col(column) if isinstance(column, str) else column
