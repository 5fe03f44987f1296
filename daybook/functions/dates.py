"""Date columns, date keys and date-range planners.

"Today" is always an argument. Day keys are ISO strings of one fixed form, so that
comparing them as text is comparing them as dates.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text forms of the day, month and time keys.
DAY_KEY_FORMAT = "yyyy-MM-dd'T'00:00:00"
DATE_FORMAT = "yyyy-MM-dd"
MONTH_KEY_FORMAT = "yyyyMM"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
HOUR_FORMAT = "yyyy-MM-dd HH:00:00"

_NO_DATES = "cast(array() as array<date>)"


def day_key(column: Column | str) -> Column:
    return F.date_format(column, DAY_KEY_FORMAT)


def month_key(column: Column | str) -> Column:
    return F.date_format(column, MONTH_KEY_FORMAT)


def day_text(day: dt.date) -> str:
    return f"{day:%Y-%m-%d}T00:00:00"


def month_text(day: dt.date) -> str:
    return f"{day:%Y%m}"


# --- ranges as columns: one array per row, to be exploded -------------------

def date_series(low: Column, high: Column) -> Column:
    """Every day from low to high, both included; empty when reversed."""
    return F.when(low <= high, F.sequence(low, high, F.expr("interval 1 day"))).otherwise(
        F.expr(_NO_DATES)
    )


def last_n_days(today: Column, days: int) -> Column:
    """The last ``days`` days, ending yesterday."""
    return date_series(F.date_sub(today, days), F.date_sub(today, 1))


def month_series(low: Column, high: Column) -> Column:
    """``yyyyMM`` keys of every month from low to high, both included."""
    first, last = F.trunc(low, "month"), F.trunc(high, "month")
    months = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month"))).otherwise(
        F.expr(_NO_DATES)
    )
    return F.transform(months, month_key)


def month_ranges(low: Column, high: Column) -> Column:
    """Month-long ranges that cover low..high without gap or overlap.

    A range ends one calendar month after its start (clamped to the month's end);
    the next one starts a day later, and the last one ends at ``high``. Starts
    drift by a day per range and by clamping, so they are folded, not computed
    from an index.
    """
    months = F.ceil(F.months_between(high, low)).cast("int")
    steps = F.sequence(F.lit(0), F.greatest(months, F.lit(0)))

    def next_start(starts: Column, _step: Column) -> Column:
        previous = F.try_element_at(starts, F.lit(-1))
        start = F.coalesce(F.date_add(F.add_months(previous, 1), 1), low)
        return F.when(start <= high, F.array_append(starts, start)).otherwise(starts)

    starts = F.aggregate(steps, F.expr(_NO_DATES), next_start)
    return F.transform(starts, lambda s: F.struct(
        s.alias("start"), F.least(F.add_months(s, 1), high).alias("end")
    ))


def request_windows(begin: Column, finish: Column, step: int = 60) -> Column:
    """Windows of ``step`` days from ``begin``, as long as they start before ``finish``."""
    last_start = F.date_sub(finish, 1)
    starts = F.when(
        begin <= last_start, F.sequence(begin, last_start, F.expr(f"interval {step} day"))
    ).otherwise(F.expr(_NO_DATES))
    return F.transform(
        starts, lambda s: F.struct(s.alias("from_date"), F.date_add(s, step - 1).alias("to_date"))
    )


# --- the same windows as short driver-side lists (partition values) ---------

def last_n_day_texts(today: dt.date, days: int) -> list[str]:
    return [day_text(today - dt.timedelta(days=n)) for n in range(days, 0, -1)]


def day_texts(low: dt.date, high: dt.date) -> list[str]:
    return [day_text(low + dt.timedelta(days=n)) for n in range((high - low).days + 1)]


def month_texts(low: dt.date, high: dt.date) -> list[str]:
    first, last = low.year * 12 + low.month - 1, high.year * 12 + high.month - 1
    return [f"{m // 12:04d}{m % 12 + 1:02d}" for m in range(first, last + 1)]


def shift_month(day: dt.date, months: int) -> dt.date:
    """First day of the month ``months`` away from the month of ``day``."""
    index = day.year * 12 + day.month - 1 + months
    return dt.date(index // 12, index % 12 + 1, 1)


# --- scalar helpers ----------------------------------------------------------

def date_text(column: Column) -> Column:
    return F.date_format(column, DATE_FORMAT)


def yesterday_text(today: Column) -> Column:
    return date_text(F.date_sub(today, 1))


def tomorrow_text(today: Column) -> Column:
    return date_text(F.date_add(today, 1))


def next_day_text(year: Column, month: Column, day: Column) -> Column:
    """The day after y-m-d; a month or day out of range rolls over."""
    january = F.make_date(year, F.lit(1), F.lit(1))
    return date_text(F.date_add(F.add_months(january, month - 1), day))


def add_days_text(text: Column, days: int) -> Column:
    """Shift the date in the first ten characters of a text by some days."""
    return date_text(F.date_add(F.substring(text, 1, 10).cast("date"), days))


def hour_text(column: Column) -> Column:
    return F.date_format(column, HOUR_FORMAT)


def epoch_text(seconds: Column) -> Column:
    """Epoch seconds held as text to a time text; blank gives the text ``null``."""
    return F.when(seconds == "", F.lit("null")).otherwise(
        F.from_unixtime(seconds.try_cast("bigint"), TIME_FORMAT)
    )


def millis_between(left: Column, right: Column) -> Column:
    return F.unix_millis(left.cast("timestamp")) - F.unix_millis(right.cast("timestamp"))


def time_on_day(day: Column, hour: Column, minute: Column, second: Column) -> Column:
    return F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day), hour, minute, second)
