"""Date parsing and week arithmetic, all built-in expressions.

Weeks start on Monday.  Three year/week numbering rules are in use for the
same Monday-based week (see ``WEEK_RULES``):

* ``iso_week_cal_year``  calendar year of the Monday + ISO week number
* ``day_count_week``     calendar year + 7-day blocks counted from 1 January
                         ((day-of-year - 1) div 7 + 1)
* ``iso_week_end_year``  ISO week-numbering year + ISO week number
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from hebdo.functions.casts import _col

MS_PER_DAY = 86_400_000

# Accepted layouts for the parsers below (Spark datetime patterns).
MONTH_FIRST_FORMATS = ("M/d/yyyy", "M-d-yyyy", "MMMM d, yyyy", "MMM d, yyyy", "M/d/yy", "M-d-yy")
DAY_FIRST_FORMATS = ("d/M/yyyy", "d-M-yyyy", "d.M.yyyy")


# --- D1-D4 and the ISO year -------------------------------------------------

def week_start(c: Column | str) -> Column:
    """The Monday on or before the date (``floor_date(unit='week', week_start=1)``)."""
    return F.trunc(_col(c).cast("date"), "week")


def calendar_year(c: Column | str) -> Column:
    """D2."""
    return F.year(_col(c))


def iso_week(c: Column | str) -> Column:
    """D3: ISO-8601 week number (week 1 holds the first Thursday)."""
    return F.weekofyear(_col(c))


def iso_year(c: Column | str) -> Column:
    """ISO-8601 week-numbering year (2024-12-30 -> 2025)."""
    return F.extract(F.lit("YEAROFWEEK"), _col(c))


def day_count_week(c: Column | str) -> Column:
    """7-day blocks from 1 January: days 1-7 -> 1, 8-14 -> 2, ... 365/366 -> 53."""
    return (F.floor((F.dayofyear(_col(c)) - 1) / 7) + 1).cast("int")


WEEK_RULES = {
    "iso_week_cal_year": (calendar_year, iso_week),
    "day_count_week": (calendar_year, day_count_week),
    "iso_week_end_year": (iso_year, iso_week),
}


def week_numbers(c: Column | str, rule: str) -> tuple[Column, Column]:
    """(year, week) columns for a Monday under one of ``WEEK_RULES``."""
    try:
        year_fn, week_fn = WEEK_RULES[rule]
    except KeyError:
        raise ValueError(f"unknown week rule {rule!r}; choose from {sorted(WEEK_RULES)}") from None
    return year_fn(c).cast("int"), week_fn(c).cast("int")


# --- D7-D10: parsing --------------------------------------------------------

def parse_date_leading(c: Column | str) -> Column:
    """A date written ``yyyy-m-d`` or ``yyyy/m/d`` at the start of the text.

    Trailing text (``T00:00:00.000``, a time zone) is ignored, as R's
    ``as.Date`` does; the separator must be the same twice and the year must
    have four digits, so ``15/01/2023`` fails closed (NULL) instead of
    becoming year 15.  Text without that shape never reaches the formatter.
    """
    text = _col(c).cast("string")
    token = F.regexp_extract(text, r"^\s*(\d{4}([-/])\d{1,2}\2\d{1,2})", 1)
    return F.when(token != "", F.try_to_date(F.translate(token, "/", "-"), "yyyy-M-d"))


def pattern_shape(fmt: str) -> str | None:
    """A regular expression that every text a Spark date pattern can parse
    matches (it may accept more).  Used to skip the formatter -- whose
    failures are exceptions inside the JVM -- on text of another shape.
    None for patterns with optional sections (``[...]``): no guard then."""
    if "[" in fmt.replace("'['", "") or "]" in fmt.replace("']'", ""):
        return None
    out, i = [], 0
    while i < len(fmt):
        ch = fmt[i]
        if ch == "'":
            j = fmt.index("'", i + 1)
            out.append(re.escape(fmt[i + 1:j]) if j > i + 1 else "'")
            i = j + 1
            continue
        j = i
        while j < len(fmt) and fmt[j] == ch:
            j += 1
        n = j - i
        if ch in "yu":
            out.append(r"\d{2}" if n == 2 else rf"[+-]?\d{{{n},9}}")
        elif ch in "ML":
            out.append(r"\d{1,2}" if n <= 2 else r"\p{L}+\.?")
        elif ch in "dHhmsD":
            out.append(r"\d{1,3}")
        elif ch in "Ea":
            out.append(r"\p{L}+\.?")
        elif ch.isalpha():
            out.append(".+?")
        else:
            out.append(re.escape(fmt[i:j]))
        i = j
    return "^" + "".join(out) + "$"


def parse_date_formats(c: Column | str, formats: tuple[str, ...] | list[str]) -> Column:
    """The first of ``formats`` that matches the whole (trimmed) text."""
    text = F.trim(_col(c).cast("string"))

    def attempt(fmt: str) -> Column:
        shape = pattern_shape(fmt)
        parsed = F.try_to_date(text, fmt)
        if re.search("(?<!y)yy(?!y)", fmt):          # two digits: 69-99 are of the last century
            parsed = F.when(F.year(parsed) >= 2069, F.add_months(parsed, -1200)).otherwise(parsed)
        return parsed if shape is None else F.when(text.rlike(shape), parsed)

    return F.coalesce(*[attempt(fmt) for fmt in formats])


def parse_month_first(c: Column | str) -> Column:
    """``mdy`` -- month-first dates, NULL when nothing matches."""
    return parse_date_formats(c, MONTH_FIRST_FORMATS)


def parse_day_first(c: Column | str) -> Column:
    """Day-first dates such as ``31/12/2022``."""
    return parse_date_formats(c, DAY_FIRST_FORMATS)


def epoch_ms_to_date(c: Column | str) -> Column:
    """Epoch milliseconds -> UTC calendar date (independent of session zone)."""
    days = F.floor(_col(c).try_cast("double") / MS_PER_DAY)
    return F.date_from_unix_date(days.try_cast("int"))


def wall_clock_epoch_ms(c: Column | str) -> Column:
    """Epoch milliseconds of a ``timestamp_ntz`` read as UTC wall-clock time,
    whatever the session time zone (truncated to the millisecond)."""
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    return F.timestamp_diff("MILLISECOND", epoch, _col(c).cast("timestamp_ntz"))


# --- D5/D6: year+week codes ---------------------------------------------------

def week_code_year(c: Column | str) -> Column:
    """The ``yyyy`` part of a ``yyyyww`` code, as text."""
    return F.substring(_col(c).cast("string"), 1, 4)


def week_code_week(c: Column | str) -> Column:
    """The ``ww`` part of a ``yyyyww`` code, as text."""
    return F.substring(_col(c).cast("string"), 5, 2)


def _valid_year_week(year: Column, week: Column) -> Column:
    return year.between(1, 9998) & week.between(1, 53)


def date_of_monday_week(year: Column | str, week: Column | str, weekday: Column | str | int = 1) -> Column:
    """``as.Date(x, "%Y%W%u")`` -- week 1 starts on the first Monday of the
    year; ``weekday`` 1 = Monday ... 7 = Sunday."""
    y = _col(year).try_cast("int")
    w = _col(week).try_cast("int")
    u = F.lit(weekday) if isinstance(weekday, int) else _col(weekday).try_cast("int")
    first_monday = F.next_day(F.make_date(y - 1, F.lit(12), F.lit(31)), "Mon")
    valid = _valid_year_week(y, w) & u.between(1, 7)
    return F.when(valid, F.date_add(first_monday, (w - 1) * 7 + (u - 1)))


def monday_of_monday_week(year: Column | str, week: Column | str) -> Column:
    """D5 for weekday 1 (the Monday of ``%W`` week ``week``)."""
    return date_of_monday_week(year, week, 1)


def monday_of_iso_week(year: Column | str, week: Column | str) -> Column:
    """Monday of ISO week ``week`` of ISO year ``year``; NULL for a week the year lacks."""
    y = _col(year).try_cast("int")
    w = _col(week).try_cast("int")
    week1 = F.trunc(F.make_date(y, F.lit(1), F.lit(4)), "week")
    monday = F.date_add(week1, (w - 1) * 7)
    return F.when(_valid_year_week(y, w) & (F.weekofyear(monday) == w), monday)
