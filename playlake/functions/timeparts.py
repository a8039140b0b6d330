"""Epoch milliseconds to start times, and the parts of a start time.

Start times carry no zone (``timestamp_ntz``): results do not depend on the session time zone.
"""

from pyspark.sql import Column, functions as F

# Weekday names, Sunday first as ``dayofweek`` counts.
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
WEEKDAY_WIDTH = 9

_UNITS = {"second": ("SECOND", 1000), "milli": ("MILLISECOND", 1)}


def epoch() -> Column:
    """1970-01-01 00:00:00."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def start_time(ts_ms: Column, precision: str = "second") -> Column:
    """Epoch milliseconds as a timestamp, cut to whole seconds or keeping the milliseconds."""
    unit, divisor = _UNITS[precision]
    amount = ts_ms.cast("bigint") if divisor == 1 else F.call_function("div", ts_ms, F.lit(divisor))
    return F.timestamp_add(unit, amount, epoch())


def epoch_millis(ts: Column) -> Column:
    """Timestamp without zone to epoch milliseconds, rounded down."""
    seconds = (ts.cast("timestamp_ntz") - epoch()).cast("interval second").cast("decimal(20,6)")
    return F.floor(seconds * 1000).cast("bigint")


def weekday(start: Column, style: str = "number") -> Column:
    """Weekday as ``number`` (1 = Sunday), ``name``, or ``padded`` name of fixed width."""
    number = F.dayofweek(start)
    if style == "number":
        return number
    # ``element_at`` takes a null position in a constant array for the last one.
    name = F.get(F.array(*[F.lit(day) for day in WEEKDAYS]), number - 1)
    if style == "name":
        return name
    if style == "padded":
        return F.rpad(name, WEEKDAY_WIDTH, " ")
    raise ValueError(f"unknown weekday style: {style}")


def time_parts(start: Column, weekday_style: str = "number") -> list[Column]:
    """The six parts of a start time, named as in the ``time`` table. ``week`` is the ISO week."""
    return [
        F.hour(start).alias("hour"),
        F.dayofmonth(start).alias("day"),
        F.weekofyear(start).alias("week"),
        F.month(start).alias("month"),
        F.year(start).alias("year"),
        weekday(start, weekday_style).alias("weekday"),
    ]
