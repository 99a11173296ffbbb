"""Date parsing and calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_YEAR, _MONTH, _DAY = "([0-9]{4})", "(0?[1-9]|1[0-2])", "(0?[1-9]|[12][0-9]|3[01])"

# The formats tried, in this order, on a whole fact column.
COLUMN_FORMATS = ("M/d/yyyy", "d/M/yyyy", "yyyy-M-d")

# The numeric formats as patterns, with the order that turns them into yyyy-M-d. Cells of
# another format fail the pattern; a formatter would raise an exception inside for each.
_PATTERNS = {
    "M/d/yyyy": (f"{_MONTH}/{_DAY}/{_YEAR}", "$3-$1-$2"),
    "d/M/yyyy": (f"{_DAY}/{_MONTH}/{_YEAR}", "$3-$2-$1"),
    "yyyy-M-d": (f"{_YEAR}-{_MONTH}-{_DAY}", "$1-$2-$3"),
    "yyyy/M/d": (f"{_YEAR}/{_MONTH}/{_DAY}", "$1-$2-$3"),
    "d-M-yyyy": (f"{_DAY}-{_MONTH}-{_YEAR}", "$3-$2-$1"),
    "yyyyMMdd": ("([0-9]{4})([0-9]{2})([0-9]{2})", "$1-$2-$3"),
}

# The formats the lenient parser tries on each cell, a time of day may follow.
LENIENT_FORMATS = ("yyyy-M-d", "yyyy/M/d", "M/d/yyyy", "d/M/yyyy", "d-M-yyyy", "yyyyMMdd")

_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_NAME = "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\\.?"
# A time of day, with or without seconds, half of the day and zone; the zone is not applied.
_ANY_TIME = "(?:[ t]+[0-9]{1,2}:[0-9]{1,2}(?::[0-9]{1,2}(?:\\.[0-9]+)?)?(?: ?[ap]m)?(?: ?(?:z|utc|[+-][0-9]{2}:?[0-9]{2}))?)?"
# Month names: the parts are day, month, year by their numbers.
_NAMED = (
    (f"^{_DAY}[-/. ]+{_NAME}[-/., ]+([0-9]{{4}}|[0-9]{{2}}){_ANY_TIME}$", 1, 2, 3),
    (f"^{_NAME}[-/. ]+{_DAY}(?:st|nd|rd|th)?[-/., ]+([0-9]{{4}}|[0-9]{{2}}){_ANY_TIME}$", 2, 1, 3),
)


def parse_date(c: Column, fmt: str) -> Column:
    """Date of a cell in one of the formats above, else NULL."""
    pattern, order = _PATTERNS[fmt]
    pattern = f"^{pattern}$"
    return F.when(c.rlike(pattern), F.regexp_replace(c, pattern, order).try_cast("date"))


def to_date_lenient(c: Column) -> Column:
    """First format that fits the cell, NULL when none does.

    Blanks around the cell and letter case don't matter; dots separate as slashes do. A
    two-digit year is of the 1900s from 69 on, else of the 2000s. A zone is left as it is:
    the date is the one written. Month names are English.
    """
    cell = F.lower(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")))
    dated = F.regexp_replace(cell, r"^(\d{1,4})\.(\d{1,2})\.(\d{1,4})(?=$|[ t])", "$1/$2/$3")
    for century, decades in (("20", r"[0-5]\d|6[0-8]"), ("19", r"69|[7-9]\d")):
        short = rf"^(\d{{1,2}})([/-])(\d{{1,2}})[/-]({decades})(?=$|[ t])"
        dated = F.regexp_replace(dated, short, f"$1$2$3$2{century}$4")
    return F.coalesce(*[_parse_any_time(dated, fmt) for fmt in LENIENT_FORMATS], *[_parse_named(cell, *n) for n in _NAMED])


def _century(two_digits: Column) -> Column:
    return F.concat(F.when(two_digits >= "69", F.lit("19")).otherwise(F.lit("20")), two_digits)


def _parse_any_time(c: Column, fmt: str) -> Column:
    pattern, order = _PATTERNS[fmt]
    pattern = f"^{pattern}{_ANY_TIME}$"
    return F.when(c.rlike(pattern), F.regexp_replace(c, pattern, order).try_cast("date"))


def _parse_named(c: Column, pattern: str, day: int, month: int, year: int) -> Column:
    def part(k: int) -> Column:
        return F.regexp_extract(c, pattern, k)

    number = F.array_position(F.array(*[F.lit(m) for m in _MONTHS]), part(month))
    full = F.when(F.length(part(year)) == 2, _century(part(year))).otherwise(part(year))
    return F.when(c.rlike(pattern), F.concat_ws("-", full, number.cast("string"), part(day)).try_cast("date"))


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def year_start(c: Column) -> Column:
    return F.trunc(c, "YEAR")


def month_index(c: Column) -> Column:
    """Months since year 0, so that neighbouring months differ by one."""
    return F.year(c) * 12 + F.month(c)
