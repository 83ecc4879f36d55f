"""Timestamp column functions (all built-in expressions, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Hours are counted from here; it lies before all times that are rounded.
FIRST_HOUR = "TIMESTAMP_NTZ'-9999-01-01 00:00:00'"

#: A text that begins with a whole date, alone or followed by a time.
DATED = r"^\s*\d{4}-\d{2}-\d{2}([T ].*)?$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_iso(text) -> Column:
    """ISO-8601 text -> ``timestamp_ntz`` (UTC wall time); NULL on junk.

    Accepts ``...Z``, ``...+hh:mm`` offsets and date-only text, but always a
    full date first: a time alone would take the day the query runs on.
    ANSI-safe: ``try_to_timestamp`` never raises. Offsets are converted to the
    (UTC) session zone before dropping the zone.
    """
    t = _c(text).cast("string")
    return F.when(t.rlike(DATED), F.try_to_timestamp(t)).cast("timestamp_ntz")


def coalesce_timestamp(*texts) -> Column:
    """First non-NULL *text*, then parsed.

    The choice is made on NULL text, not on parse failure: a present but
    unparseable first value yields NULL rather than falling through.
    """
    return parse_iso(F.coalesce(*[_c(t) for t in texts]))


def round_to_hour(ts) -> Column:
    """Nearest hour: add 30 minutes, truncate to the hour (``timestamp_ntz``).

    ``hh:29:59.999999`` stays in ``hh``; ``hh:30:00`` goes to ``hh+1``; a row
    at 23:30 or later lands on the next day. Built on NTZ arithmetic so the
    result does not depend on the session time zone; ``ts`` stands in it once,
    so it is computed once (it is often the parse of a text).
    """
    t = _c(ts).cast("timestamp_ntz") + F.expr("INTERVAL 30 MINUTES")
    first = F.expr(FIRST_HOUR)
    return first + (t - first).cast("interval day to hour")


def day_of(ts) -> Column:
    """Calendar day of a timestamp (what ``datediff(a, b) = 0`` compares)."""
    return F.to_date(_c(ts))


def same_day(ts, day) -> Column:
    """``ts`` falls on ``day`` - written as a half-open range so it prunes."""
    d = F.to_date(day if isinstance(day, Column) else F.lit(str(day)))
    start = d.cast("timestamp_ntz")
    end = F.date_add(d, 1).cast("timestamp_ntz")
    c = _c(ts)
    return (c >= start) & (c < end)


def iso_text(ts, with_zone: bool = True) -> Column:
    """``timestamp_ntz`` -> ISO text (``yyyy-MM-ddTHH:mm:ssZ``)."""
    fmt = "yyyy-MM-dd'T'HH:mm:ss" + ("'Z'" if with_zone else "")
    return F.date_format(_c(ts), fmt)


def is_iso_datetime(text) -> Column:
    """Validity flag: the text parses as an ISO date or date-time."""
    return parse_iso(text).isNotNull()
