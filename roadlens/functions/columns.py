"""Scalar expressions over the text columns of the inputs."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Flow-level names and limits, speed-band names and lower bounds.
FLOW_LEVELS = ("A LEVEL", "B LEVEL", "C LEVEL", "D LEVEL")
FLOW_THRESHOLDS = (170, 160, 150)
SPEED_BANDS = (("low", 0), ("normal", 60), ("medium", 90), ("high", 120))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_int(c: Column | str) -> Column:
    """Whole number in the text, NULL when it is anything else (a plain cast raises in ANSI mode).

    The pattern comes first because a failing try_cast costs an exception, some 20 microseconds per row.
    """
    c = _col(c)
    return F.when(c.rlike("^[+-]?[0-9]+$"), c.try_cast("int"))


def zero_pad(c: Column | str, width: int) -> Column:
    """Left-pad with zeros; longer text is kept whole (plain lpad would cut it)."""
    c = _col(c)
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


# Day, hour of up to four digits, minute and second of a time text. Text that differs is no time to any helper.
TIME_PATTERN = "^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2}) ([0-9]{1,4}):([0-5]?[0-9]):([0-5]?[0-9])$"


# The usual form, whose parts stand at fixed places.
_USUAL = "^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-5][0-9]:[0-5][0-9]$"


def _from_parts(c: Column | str, make: Callable[[Column, Column, Column, Column], Column]) -> Column:
    """``make`` of day, hour, minute and second of a time text, NULL when it is none.

    A text in the usual form is matched once and its parts are cut out by place; only others are taken apart by the
    pattern, which costs a match for each part. ``make`` has to be NULL where the day isn't in the calendar.
    """
    c = _col(c)
    usual = [F.substring(c, at, n) for at, n in ((1, 10), (12, 2), (15, 2), (18, 2))]
    other = [F.regexp_extract(c, TIME_PATTERN, i) for i in (1, 2, 3, 4)]
    return F.when(c.rlike(_USUAL), make(*usual)).when(c.rlike(TIME_PATTERN), make(*other))


def _on_day(day: Column, value: Column) -> Column:
    return F.when(day.try_cast("date").isNotNull(), value)


def day_text(c: Column | str) -> Column:
    return _from_parts(c, lambda day, h, m, s: _on_day(day, day))


def lenient_seconds(c: Column | str) -> Column:
    """Wall-clock seconds since 1970-01-01 of a time text, letting hours past 23 run into the next day.

    A plain number: sorts, slices and buckets need no time zone, and the text may hold hours such as 26 that
    to_timestamp refuses. NULL when the text is malformed.
    """

    def seconds(day: Column, h: Column, m: Column, s: Column) -> Column:
        days = F.unix_date(day.try_cast("date")).cast("bigint")
        return days * 86400 + h.cast("int") * 3600 + m.cast("int") * 60 + s.cast("int")

    return _from_parts(c, seconds)


def lenient_ts(c: Column | str) -> Column:
    """The same instant as a timestamp in the session time zone (needed for stream windows)."""

    def instant(day: Column, h: Column, m: Column, s: Column) -> Column:
        clock = F.make_dt_interval(F.lit(0), h.cast("int"), m.cast("int"), s.cast("decimal(18,6)"))
        return day.try_cast("date").cast("timestamp") + clock

    return _from_parts(c, instant)


def hour_text(c: Column | str) -> Column:
    return _from_parts(c, lambda day, h, m, s: _on_day(day, h))


def date_hour(c: Column | str) -> Column:
    """'yyyy-MM-dd_HH', cut from the text as it stands (hour 26 stays 26); NULL when the text is malformed."""
    return _from_parts(c, lambda day, h, m, s: _on_day(day, F.concat(day, F.lit("_"), h)))


def range_label(c: Column | str, minutes: int = 5) -> Column:
    """Label of the bucket of the hour: 'day HH:mm~day HH:mm'; the last one of an hour ends at HH+1:00.

    NULL when the text is malformed.
    """
    # looked up by the minute: within a branch every use of a text, cut and cast, is computed anew
    begins = [minute - minute % minutes for minute in range(60)]
    begin = F.array(*[F.lit(f"{b:02d}") for b in begins])
    end = F.array(*[F.lit(f"{b + minutes:02d}") for b in begins])

    def label(day: Column, hour: Column, m: Column, s: Column) -> Column:
        until = F.get(end, m.cast("int"))
        next_hour = zero_pad((hour.cast("int") + 1).cast("string"), 2)
        end_clock = F.when(until == "60", F.concat(next_hour, F.lit(":00"))).otherwise(F.concat(hour, F.lit(":"), until))
        start = F.get(begin, m.cast("int"))
        return _on_day(day, F.concat(day, F.lit(" "), hour, F.lit(":"), start, F.lit("~"), day, F.lit(" "), end_clock))

    return _from_parts(c, label)


def field_from_concat(c: Column | str, key: str, sep: str = "|") -> Column:
    """Value of the first 'key=value' entry of a separated text; NULL when there is none."""
    s = re.escape(sep)
    found = F.regexp_extract(_col(c), rf"(?:^|{s})\Q{key}\E=([^={s}]+)=*(?={s}|$)", 1)
    return F.nullif(found, F.lit(""))


def map_from_concat(c: Column | str, sep: str = "|") -> Column:
    """All 'key=value' entries as a map; of a repeated key the last value stays."""
    pairs = F.transform(F.split(_col(c), re.escape(sep)), lambda e: F.split(F.regexp_replace(e, "=+$", ""), "="))
    pairs = F.filter(pairs, lambda p: F.size(p) == 2)
    keys = F.array_distinct(F.transform(pairs, lambda p: p[0]))
    last = lambda k: F.element_at(F.filter(pairs, lambda p: p[0] == k), -1)[1]
    return F.map_from_arrays(keys, F.transform(keys, last))


def flow_level(c: Column | str, thresholds: Sequence[int] = FLOW_THRESHOLDS) -> Column:
    """Level of a count: above the first threshold A, above the second B, above the third C, else D."""
    c = _col(c)
    top, *rest = zip(FLOW_LEVELS, thresholds)
    expr = F.when(c > top[1], top[0])
    for name, limit in rest:
        expr = expr.when(c > limit, name)
    return expr.otherwise(FLOW_LEVELS[len(thresholds)])


def speed_band(c: Column | str) -> Column:
    """Band of a speed; NULL for negative or missing speeds."""
    c = _col(c)
    name, lower = SPEED_BANDS[-1]
    expr = F.when(c >= lower, name)
    for name, lower in reversed(SPEED_BANDS[:-1]):
        expr = expr.when(c >= lower, name)
    return expr


def unit_half_up(c: Column | str) -> Column:
    """Two digits, half up, of a double between 0 and 1, decided on its exact binary value.

    A double such as 29/200 lies just below 0.145, so it rounds to 0.14; rounding its shortest decimal text would
    give 0.15. Scaling by a power of two is exact, and the rest is whole-number arithmetic.
    """
    scaled = (_col(c) * float(2**62)).cast("bigint").cast("decimal(20,0)")
    hundredths = F.floor((scaled * 200 + F.lit(2**62).cast("decimal(20,0)")) / F.lit(2).cast("decimal(1,0)"))
    return _div_floor(hundredths, 62)


def _div_floor(c: Column, bits: int) -> Column:
    """Whole part of a non-negative decimal divided by a power of two, then taken as hundredths."""
    half = F.lit(2 ** (bits // 2)).cast("decimal(20,0)")
    return F.floor(F.floor(c / half) / half).cast("double") / 100


def params_map(c: Column | str) -> Column:
    """A JSON job-parameter document as a map of arrays."""
    return F.from_json(_col(c), "map<string,array<string>>")


def first_element(c: Column | str, name: str) -> Column:
    """First element of the array a parsed document holds under a name."""
    return F.get(F.element_at(_col(c), name), F.lit(0))
