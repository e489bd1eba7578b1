"""ISO date/time text helpers (``Column -> Column``), all JVM-side built-ins.

Registry dates are kept as ISO *text* (``YYYY-MM-DD``, ``YYYY-MM-DDTHH:MM:SSZ``)
and compared lexicographically. The helpers here never round-trip a value
through a zone-aware timestamp: parsing is used only to *validate* a shape,
normalised outputs are built from the validated text, elapsed times come from
day numbers and time-of-day fields, and ``as_of`` stamps are computed once on
the driver. The results are therefore the same in any session time zone.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted text shapes and their output formats.
DATE_SHAPES = {10: "yyyy-MM-dd", 7: "yyyy-MM", 4: "yyyy"}
DATE_PADDING = {10: "", 7: "-01", 4: "-01-01"}
TIME_SHAPE = "yyyy-MM-dd'T'HH:mm:ss"
SECONDS_PER_DAY = 86400

# A time string SQL date() accepts after the day part.
_SQL_TIME_SUFFIX = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?(Z|[+-]\d{2}:\d{2})?$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def _valid(c: Column, pattern: str) -> Column:
    """Does ``c`` parse with ``pattern``? (validation only; the value is not used)"""
    return F.try_to_timestamp(c, F.lit(pattern)).isNotNull()


def _normalised_day(c: Column) -> Column:
    """``YYYY-MM-DD`` for a valid 10/7/4-character date text, else NULL."""
    n = F.length(c)
    out = None
    for length, pattern in DATE_SHAPES.items():
        branch = (n == length) & _valid(c, pattern)
        value = F.concat(c, F.lit(DATE_PADDING[length]))
        out = F.when(branch, value) if out is None else out.when(branch, value)
    return out


def _finish(c: Column, out: Column, strict: bool) -> Column:
    if strict:
        out = F.coalesce(out, F.raise_error(F.concat(F.lit("not a date this column can hold: "), c)).cast("string"))
    return F.when(_blank(c), F.lit("")).otherwise(out)


def normalise_date(c, strict: bool = True) -> Column:
    """``YYYY-MM-DD`` / ``YYYY-MM`` / ``YYYY`` -> ``YYYY-MM-DD`` (first of month/year).

    Blank or NULL gives ``''``. Any other shape aborts the job when ``strict``
    (the reference exits), else yields NULL so callers can quarantine it.
    """
    c = _col(c)
    return _finish(c, _normalised_day(c), strict)


def normalise_timestamp(c, strict: bool = True) -> Column:
    """ISO text -> ``YYYY-MM-DDTHH:MM:SSZ``.

    Text of 20 or more characters keeps its first 19 (fraction and UTC offset
    are discarded, not applied); 10/7/4 characters are a date at midnight.
    Length 19 (no zone marker) is not an accepted shape.
    """
    c = _col(c)
    head = F.substring(c, 1, 19)
    out = (F.when((F.length(c) >= 20) & _valid(head, TIME_SHAPE), F.concat(head, F.lit("Z")))
           .otherwise(F.concat(_normalised_day(c), F.lit("T00:00:00Z"))))
    return _finish(c, out, strict)


def date_part(c) -> Column:
    """First ten characters of an ISO text (no parsing)."""
    return F.substring(_col(c), 1, 10)


def sql_day(c) -> Column:
    """Day of an ISO date/time text as DATE, NULL when it is not one.

    Follows SQL ``date(text)``: ``'2020-01'`` or ``''`` give NULL (a bare cast
    would accept them).
    """
    c = _col(c)
    return F.when(c.rlike(_SQL_TIME_SUFFIX), F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd"))


def epoch_seconds(c) -> Column:
    """Seconds since 1970-01-01T00:00:00 of an ISO text read as UTC wall-clock
    (``YYYY-MM-DD[THH:MM:SS...]``; any suffix after the seconds is ignored).
    NULL when the text is not such a date/time."""
    c = _col(c)
    day = F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd")
    has_time = (F.length(c) >= 19) & (_valid(F.substring(c, 1, 19), TIME_SHAPE)
                                      | _valid(F.substring(c, 1, 19), "yyyy-MM-dd HH:mm:ss"))
    part = lambda start: F.substring(c, start, 2).try_cast("int")
    seconds_of_day = F.when(has_time, part(12) * 3600 + part(15) * 60 + part(18)) \
        .when(F.length(c) == 10, F.lit(0))
    return F.unix_date(day).cast("bigint") * SECONDS_PER_DAY + seconds_of_day


def now() -> str:
    """The current UTC time as ``as_of`` text (the command line's default; the
    library itself has no clock)."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def _as_of(as_of: str) -> datetime:
    """``as_of`` ISO text (date or date-time, optional ``Z``) as a UTC datetime."""
    text = as_of.rstrip("Z").replace(" ", "T")
    dt = datetime.fromisoformat(text)
    return dt.replace(tzinfo=timezone.utc) if dt.tzinfo is None else dt.astimezone(timezone.utc)


def elapsed_days(c, as_of: str) -> Column:
    """Whole days from an ISO timestamp text to ``as_of``, truncated toward zero."""
    secs = F.lit(int(_as_of(as_of).timestamp())) - epoch_seconds(c)
    return (secs / F.lit(SECONDS_PER_DAY)).cast("int")


def report_date(as_of: str) -> Column:
    """The report stamp ``dd-mm-yyyy`` of ``as_of``."""
    return F.lit(_as_of(as_of).strftime("%d-%m-%Y"))


def hour_version(ts) -> Column:
    """Epoch seconds of a timestamp's hour (cache version); the wall-clock
    value is read as UTC, as for ISO text."""
    ts = _col(ts)
    return F.unix_date(F.to_date(ts)).cast("bigint") * SECONDS_PER_DAY + F.hour(ts).cast("bigint") * 3600


def hour_version_of(as_of: str) -> Column:
    t = int(_as_of(as_of).timestamp())
    return F.lit(t - t % 3600)
