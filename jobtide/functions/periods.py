"""Calendar and historical-phase expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtide.codes import LAST_PHASE, MONTHS, NOT_INFORMED, SEASONS
from jobtide.functions.lookup import decode
from jobtide.functions.text import strip

# The first and the last month whose first day fits into nanoseconds from 1970.
MONTH_RANGE = ("167710", "226204")


def parse_month(text: Column) -> Column:
    """``yyyyMM`` as the first day of that month, NULL where it is no month.

    Months whose first day a 64-bit count of nanoseconds from 1970 cannot hold are
    none. Impossible months are told apart by comparison first: a failing cast is slow.
    """
    digits = F.when(F.length(text) == 6, text).otherwise(strip(text))
    year, month = F.substring(digits, 1, 4), F.substring(digits, 5, 2)
    possible = (F.length(digits) == 6) & digits.between(*MONTH_RANGE) & month.between("01", "12")
    return F.when(possible, F.concat(year, F.lit("-"), month, F.lit("-01")).try_cast("date"))


def month_text(date: Column) -> Column:
    """``yyyyMM`` of a date; a year of four digits needs no formatter."""
    digits = (F.year(date) * 100 + F.month(date)).cast("string")
    return F.when(F.year(date).between(1000, 9999), digits).otherwise(F.date_format(date, "yyyyMM"))


def quarter_label(month: Column) -> Column:
    """``T1`` .. ``T4``."""
    return F.concat(F.lit("T"), (F.floor((month - 1) / 3) + 1).cast("int").cast("string"))


def year_quarter_label(year: Column, quarter: Column) -> Column:
    """``2020-T1``."""
    return F.concat(year.cast("string"), F.lit("-"), quarter)


def year_month_number(year: Column, month: Column) -> Column:
    """``202001``."""
    return year * 100 + month


def season(month: Column) -> Column:
    """Three-month season of a month number."""
    names = {month_no: SEASONS[(month_no - 1) // 3] for month_no in range(1, 13)}
    return decode(month, names, NOT_INFORMED)


def month_name(month: Column) -> Column:
    """Short month name of a month number."""
    return decode(month, dict(enumerate(MONTHS, start=1)))


def month_label(year: Column, month: Column) -> Column:
    """``Abr/2020``."""
    return F.concat(month_name(month), F.lit("/"), year.cast("string"))


def phase(year: Column, month: Column, phases: list[tuple], first_year: int) -> Column:
    """Label of the first matching phase; a missing or other date takes the last phase."""
    label = F.lit(LAST_PHASE)
    for offset, from_month, to_month, name in reversed(phases):
        matches = year == first_year + offset
        if (from_month, to_month) != (1, 12):
            matches = matches & month.between(from_month, to_month)
        label = F.when(matches, F.lit(name)).otherwise(label)
    return label
