"""Date parsing and shifting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, TimestampNTZType, TimestampType

# Date formats tried in order; the first that parses wins.  ``d/M/yyyy`` also
# accepts zero-padded days and months; no text fits both.
DAY_FIRST_FORMATS = ["d/M/yyyy", "yyyy-M-d"]

# date part, then a valid "H:m", "H:m:s" or "H:m:s.f" time; a zone is read over, the wall clock counts
_DATE_TIME = (r"^\s*(\S+?)[ T]([01]?\d|2[0-3]):([0-5]?\d)(?::([0-5]?\d(?:\.\d{1,6})?)\d*)?"
              r"\s*(?:Z|[+-]\d{2}:?\d{2})?\s*$")


# Shapes that most cells have; a cast reads them as the formats above would.
# Years of four digits from 0001, and nothing around.
_DAY_FIRST = r"^[0-9]{1,2}/[0-9]{1,2}/(?!0000)[0-9]{4}\z"
_ISO = r"^(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?:[ T](?:[01]?[0-9]|2[0-3]):[0-5]?[0-9]:[0-5]?[0-9](?:[.][0-9]{1,6})?)?\z"


def parse_day_first(c: Column, formats: list[str] | None = None) -> Column:
    """Text -> wall-clock timestamp (``TIMESTAMP_NTZ``), day first; anything
    unparseable (31/02, plain numbers) becomes NULL.  ISO dates and date-times
are read too.

    Cells of the usual shapes are cast (day-first ones with their parts turned
    round); the others go through the formats, each of which is an exception
    where it doesn't fit.

    Order independent: every row is parsed on its own, never with a format
    guessed from the first row.  Zone free: the date part goes through
    ``try_to_date``, and the time of cells that have one (a ``:``) is added to
    it as an interval, so no session time zone (or its daylight-saving gaps)
    can move the value."""
    timed = F.instr(c, ":") > 0

    def part(i: int, kind: str = "int") -> Column:
        return F.coalesce(F.regexp_extract(c, _DATE_TIME, i).try_cast(kind), F.lit(0).cast(kind))

    date_txt = F.when(timed, F.regexp_extract(c, _DATE_TIME, 1)).otherwise(F.trim(c))
    day = F.coalesce(*[F.try_to_date(date_txt, f) for f in formats or DAY_FIRST_FORMATS])
    zero = F.lit(0)
    time = F.when(timed, F.make_dt_interval(zero, part(2), part(3), part(4, "decimal(18,6)"))).otherwise(
        F.make_dt_interval(zero, zero, zero, zero.cast("decimal(18,6)")))
    general = day.cast("timestamp_ntz") + time
    if formats:
        return general
    turned = F.concat_ws("-", F.substring(c, -4, 4), F.substring_index(F.substring_index(c, "/", 2), "/", -1),
                         F.substring_index(c, "/", 1))
    return (F.when(c.rlike(_DAY_FIRST), turned.try_cast("date").cast("timestamp_ntz"))
            .when(c.rlike(_ISO), c.try_cast("timestamp_ntz")).otherwise(general))


def to_day_first_timestamp(c: Column, dtype: DataType, formats: list[str] | None = None) -> Column:
    """Type a date-named column whatever it holds: text is parsed, dates are
    widened, timestamps pass through."""
    if isinstance(dtype, StringType):
        return parse_day_first(c, formats)
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        return c.cast("timestamp_ntz")
    return F.lit(None).cast("timestamp_ntz")


def minus_one_day(c: Column) -> Column:
    """``c - 1 day`` for a DATE or TIMESTAMP column (type preserved)."""
    return c - F.expr("INTERVAL 1 DAY")
