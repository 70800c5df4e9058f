"""Date parsing and calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: day zero of spreadsheet serial dates.
SERIAL_EPOCH = "1899-12-30"


def _parsed(text: Column, pattern: str) -> Column:
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


def serial_date(days: Column) -> Column:
    return F.date_add(F.lit(SERIAL_EPOCH).cast("date"), days.try_cast("int"))


def strict_date(text: Column) -> Column:
    """ISO, d/M/yyyy, ISO with midnight, or a whole serial day; anything else is NULL."""
    return (
        F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), _parsed(text, "yyyy-M-d"))
        .when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), _parsed(text, "d/M/yyyy"))
        .when(text.rlike(r"^\d{4}-\d{2}-\d{2}T00:00:00$"), _parsed(F.substring(text, 1, 10), "yyyy-MM-dd"))
        .when(text.rlike(r"^\d{1,6}(\.0+)?$"), serial_date(F.regexp_replace(text, r"\.0+$", "")))
    )


def date_error(text: Column) -> Column:
    """True where a non-empty cell is not an acceptable date."""
    return (F.coalesce(text, F.lit("")) != "") & strict_date(text).isNull()


def report_date(text: Column) -> Column:
    """Mixed report dates: yyMMdd, six text layouts, serial days 38718..100000."""
    cell = F.trim(text)
    serial = cell.try_cast("int")
    return (
        F.when(cell.rlike(r"^\d{6}$"), _parsed(F.concat(F.lit("20"), cell), "yyyyMMdd"))
        .when(cell.rlike(r"^\d{5}$") & serial.between(38718, 100000), serial_date(cell))
        .when(cell.rlike(r"^\d{8}$"), _parsed(cell, "yyyyMMdd"))
        .when(cell.rlike(r"^\d{4}-\d{1,2}-\d{1,2}( 00:00:00)?$"), _parsed(F.substring_index(cell, " ", 1), "yyyy-M-d"))
        .when(cell.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), _parsed(cell, "M/d/yyyy"))
        .when(cell.rlike(r"^\d{1,2}/\d{1,2}/\d{2}$"), _parsed(cell, "M/d/yy"))
        .when(cell.rlike(r"^\d{4}/\d{1,2}/\d{1,2}$"), _parsed(cell, "yyyy/M/d"))
    )


def observation_month(text: Column) -> Column:
    """First day of the month a cell names; serial 1..80000, ISO, yyyy-MM, then day-first."""
    cell = F.trim(text)
    serial = cell.try_cast("int")
    day = (
        F.when(cell.rlike(r"^\d{1,5}$") & serial.between(1, 80000), serial_date(cell))
        .when(cell.rlike(r"^\d{4}-\d{2}$"), _parsed(F.concat(cell, F.lit("-01")), "yyyy-MM-dd"))
        .when(cell.rlike(r"^\d{4}-\d{2}-\d{2}"), _parsed(F.substring(cell, 1, 10), "yyyy-MM-dd"))
        .when(cell.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), _parsed(cell, "d/M/yyyy"))
    )
    return F.trunc(day, "MM")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_end(day: Column) -> Column:
    return F.last_day(day)


def shift_months(day: Column, months: int | Column) -> Column:
    """Month shift with the day clamped to the target month."""
    return F.add_months(day, months)


def same_day_last_year(day: Column) -> Column:
    """29 February maps to 28 February."""
    return F.add_months(day, -12)


def nth_weekday(day: Column, weekday: str, n: int) -> Column:
    """The n-th given weekday of the month of ``day``."""
    first = F.next_day(F.date_sub(F.trunc(day, "MM"), 1), weekday)
    return F.date_add(first, 7 * (n - 1))


def last_weekday(day: Column, weekday: str) -> Column:
    """The last given weekday of the month of ``day``."""
    return F.next_day(F.date_sub(F.last_day(day), 7), weekday)


def recent_months(day: Column, n: int) -> Column:
    """Array of the n month starts ending with the month of ``day``."""
    return F.sequence(F.add_months(F.trunc(day, "MM"), 1 - n), F.trunc(day, "MM"), F.expr("interval 1 month"))


def to_utc(text: Column, zone: str = "America/New_York") -> Column:
    """Acceptance time: with an offset it is absolute, without one it is local to ``zone``."""
    has_zone = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    absolute = F.to_utc_timestamp(F.try_to_timestamp(text), F.current_timezone())
    wall = F.to_utc_timestamp(F.to_timestamp_ntz(F.when(~has_zone, text)).cast("string"), zone)
    return F.when(has_zone, absolute).otherwise(wall).cast("timestamp_ntz")
