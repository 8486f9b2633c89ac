"""Date and time expressions.  ``now`` is a Column or a literal given by the caller."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Days allowed since the last update for a stated frequency,
# day numbers of month ends without leap days, and label formats.
ALLOWED_DAYS = {"daily": 4, "weekly": 10, "monthly": 45, "annual": 410, "varies": 15}
ALLOWED_SUB_DAILY = 1
ALLOWED_DEFAULT = 2
MONTH_END_DAYS = [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]
LABEL_DATE = "MMMM dd, yyyy"
LABEL_MONTH = "MMMM yyyy"
LABEL_HOUR = "MMMM dd, yyyy HH:mm"


def as_time(value) -> Column:
    """A literal time text or a Column as a time without zone."""
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp_ntz")


_ZONE = re.compile("[zZVOXx]")


def _since_epoch(micros: Column) -> Column:
    """Time without zone so many microseconds after 1970 began in UTC."""
    seconds = (micros.cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def parse_ts(col: Column, *formats: str) -> Column:
    """First format that fits; null if none does.

    A text with an offset becomes UTC time; one without is taken as it stands.
    Neither depends on the session's zone.
    """
    def parsed(form: str) -> Column:
        if _ZONE.search(re.sub("'[^']*'", "", form)):
            return F.try_to_timestamp(col, F.lit(form))
        return F.try_to_timestamp(F.concat(col, F.lit(" +0000")), F.lit(f"{form} Z"))

    return _since_epoch(F.unix_micros(F.coalesce(*[parsed(f) for f in formats])))


def from_epoch(col: Column, unit: str = "s", zero_fill: bool = False) -> Column:
    """Epoch seconds or milliseconds to a time; ``zero_fill`` makes null 1970-01-01."""
    number = col.cast("bigint")
    if zero_fill:
        number = F.coalesce(number, F.lit(0).cast("bigint"))
    return _since_epoch(number * (1000 if unit == "ms" else 1_000_000))


def from_decimal_year(col: Column) -> Column:
    """2016.5 to the middle of 2016, leap years included, cut to whole seconds."""
    value = col.cast("double")
    year = F.floor(value).cast("int")
    days = F.datediff(F.make_date(year + 1, F.lit(1), F.lit(1)), F.make_date(year, F.lit(1), F.lit(1)))
    seconds = F.floor((value - year) * days * F.lit(86400)).cast("bigint")
    start = F.make_date(year, F.lit(1), F.lit(1)).cast("timestamp_ntz")
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def from_day_of_year(col: Column) -> Column:
    """``yyyyDDD HHmm`` text to a time.

    Minutes are the last two characters and hours what is before them; the day
    number may run past the end of the year.
    """
    day, clock = F.split_part(col, F.lit(" "), F.lit(1)), F.split_part(col, F.lit(" "), F.lit(2))
    year = F.substring(day, 1, 4).try_cast("int")
    number = F.substring(day, 5, 10).try_cast("int")
    hours = F.substring(clock, F.lit(1), F.length(clock) - 2).try_cast("int")
    minutes = F.right(clock, F.lit(2)).try_cast("int")
    start = F.date_add(F.make_date(year, F.lit(1), F.lit(1)), number - 1).cast("timestamp_ntz")
    return start + F.make_dt_interval(F.lit(0), hours, minutes)


def iso_year(date: Column) -> Column:
    """Year to which the ISO week of ``date`` belongs: the year of its Thursday."""
    return F.year(F.date_add(date, F.lit(3) - F.weekday(date)))


def iso_week_key(date: Column, infix: str = "0") -> Column:
    """ISO year, ``infix`` and two-digit ISO week, such as ``2024001``."""
    week = F.lpad(F.weekofyear(date).cast("string"), 2, "0")
    return F.concat(iso_year(date).cast("string"), F.lit(infix), week)


def iso_week_date(key: Column, weekday: int = 1) -> Column:
    """Date of the given ISO weekday (1 is Monday) in the week of ``key``."""
    year = F.substring(key, 1, 4).try_cast("int")
    week = F.right(key, F.lit(2)).try_cast("int")
    fourth = F.make_date(year, F.lit(1), F.lit(4))
    monday = F.date_sub(fourth, F.weekday(fourth))
    return F.date_add(monday, (week - 1) * 7 + (weekday - 1))


def cf_time(offset: Column, units: Column) -> Column:
    """``days since yyyy-MM-dd`` units plus an offset, cut to whole days."""
    reference = F.to_date(F.regexp_extract(units, r"since (\d{4}-\d{1,2}-\d{1,2})", 1), "yyyy-M-d")
    return F.date_add(reference, F.floor(offset).cast("int"))


def month_bounds(date: Column) -> tuple[Column, Column]:
    """First and last day of the month of ``date``."""
    return F.trunc(date, "MM"), F.last_day(date)


def mid_next_month(date: Column) -> Column:
    """The 15th of the month after ``date``."""
    return F.date_add(F.add_months(F.trunc(date, "MM"), 1), 14)


def step_forward(date: Column, months: int = 1) -> Column:
    return F.add_months(date, months)


def month_end_365(year: Column, month: Column) -> Column:
    """Month end with February always 28, as the monthly totals are labelled."""
    days = F.array(*[F.lit(d) for d in MONTH_END_DAYS])
    return F.make_date(year, month, F.element_at(days, month))


def year_start(year: Column) -> Column:
    y = year.cast("int")
    return F.when(y > 0, F.make_date(y, F.lit(1), F.lit(1)))


def year_end(year: Column) -> Column:
    y = year.cast("int")
    return F.when(y > 0, F.make_date(y, F.lit(12), F.lit(31)))


def repair_future(date: Column, year: Column, now) -> Column:
    """A date after ``now`` gets the record's own year; 29 February falls back to 28."""
    own = year.cast("int")
    start = F.make_date(own, F.lit(1), F.lit(1))
    last = F.dayofmonth(F.last_day(F.add_months(start, F.month(date) - 1)))
    moved = F.make_date(own, F.month(date), F.least(F.dayofmonth(date), last))
    return F.when(date > as_time(now), moved).otherwise(date)


def duration_text(start: Column, end: Column) -> Column:
    """Difference of two times as ``H:MM:SS``, with days in front where there are any."""
    total = F.timestamp_diff("SECOND", start, end)
    days, rest = F.floor(total / 86400), F.pmod(total, F.lit(86400))
    clock = F.concat_ws(
        ":",
        F.floor(rest / 3600).cast("string"),
        F.lpad(F.floor(F.pmod(rest, F.lit(3600)) / 60).cast("string"), 2, "0"),
        F.lpad(F.pmod(rest, F.lit(60)).cast("string"), 2, "0"),
    )
    plural = F.when(F.abs(days) == 1, " day, ").otherwise(" days, ")
    return F.when(days == 0, clock).otherwise(F.concat(days.cast("string"), plural, clock))


def scenario_interval(kind: Column, date: Column) -> tuple[Column, Column]:
    """Validity of a scenario: current on its date, near term the next four
    months, medium term the four after that."""
    start = F.when(kind == "ML2", F.add_months(date, 4)).when(kind.isin("CS", "ML1"), date)
    end = (
        F.when(kind == "CS", date)
        .when(kind == "ML1", F.add_months(date, 4))
        .when(kind == "ML2", F.add_months(date, 8))
    )
    return start, end


def range_label(end: Column, days: int, fmt: str = LABEL_DATE) -> Column:
    """``start - end`` text of the last ``days`` days."""
    return F.concat(F.date_format(F.date_sub(end, days), fmt), F.lit(" - "), F.date_format(end, fmt))


def month_range_label(start: Column, months: int) -> Column:
    last = F.add_months(start, months - 1)
    return F.concat(F.date_format(start, LABEL_MONTH), F.lit(" - "), F.date_format(last, LABEL_MONTH))


def hour_range_label(end: Column, hours: int) -> Column:
    start = end - F.make_dt_interval(F.lit(0), F.lit(hours))
    return F.concat(F.date_format(start, LABEL_HOUR), F.lit(" - "), F.date_format(end, LABEL_HOUR))


def lead_dates(created: Column, n: int) -> Column:
    """Array of the creation date and the next ``n`` dates."""
    day = created.cast("date")
    return F.sequence(day, F.date_add(day, n))


def lead_hour(created: Column, order: Column) -> Column:
    """Time ``order`` hours after creation."""
    return created + F.make_dt_interval(F.lit(0), order.cast("int"))


def parse_rfc822(col: Column) -> Column:
    """``Thu, 02 Jan 2020 03:04:05 +0000`` as a UTC time; the weekday is ignored."""
    text = F.trim(F.regexp_replace(col, r"^\s*[A-Za-z]{3,9},\s*", ""))
    text = F.regexp_replace(text, r"\b(GMT|UTC|UT)$", "+0000")
    formats = ["d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm Z", "d MMM yyyy HH:mm:ss"]
    return parse_ts(text, *formats)


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """Date of separate parts; null when they name no day."""
    text = F.format_string("%04d-%02d-%02d", *[p.try_cast("int") for p in (year, month, day)])
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")


def allowed_lag(frequency: Column) -> Column:
    """Days a dataset may be old before it is overdue, from its stated frequency."""
    text = F.lower(frequency)
    word = F.trim(text)
    count = F.regexp_extract(text, r"(\d+)", 1).try_cast("int")
    result = None
    for name, days in ALLOWED_DAYS.items():
        result = (F if result is None else result).when(word == name, days)
    return (
        result.when(text.contains("minutes") | text.contains("hours"), ALLOWED_SUB_DAILY)
        .when(text.contains("days"), count + 3)
        .when(text.contains("weeks"), count * 7 + 3)
        .when(text.contains("months"), count * 30 + 30)
        .otherwise(ALLOWED_DEFAULT)
    )


def date_parts(ts: Column) -> dict[str, Column]:
    """Date, hour, ISO weekday (0 is Monday) and year of a time."""
    return {"date": ts.cast("date"), "hour": F.hour(ts), "weekday": F.weekday(ts), "year": F.year(ts)}


def noon_day(ts: Column) -> Column:
    """Day whose window runs from noon the day before to noon of the day."""
    return (ts + F.expr("INTERVAL 12 HOURS")).cast("date")


def comparison_dates(day: Column) -> dict[str, Column]:
    """The day, a week earlier, and the same weekday on or after the date one
    month and one year earlier."""

    def same_weekday(base: Column) -> Column:
        return F.date_add(base, F.pmod(F.weekday(day) - F.weekday(base), F.lit(7)))

    return {
        "day": day,
        "last_week": F.date_sub(day, 7),
        "last_month": same_weekday(F.add_months(day, -1)),
        "last_year": same_weekday(F.add_months(day, -12)),
    }
