"""Zone-free time arithmetic on timestamps without time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000

# Position given to rows without a timestamp: after every real one.
NO_TIME = 1 << 62


def as_ntz(value: object) -> Column:
    """A literal timestamp without time zone from a datetime or ISO text."""
    return F.lit(str(value)).cast("timestamp_ntz")


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of a zone-free timestamp, as a long.

    Subtracting two zone-free timestamps gives an interval that does not depend
    on the session time zone; ``timestampdiff`` would go through it.
    """
    since_epoch = ts - as_ntz("1970-01-01 00:00:00")
    seconds = since_epoch.cast("interval second").cast("decimal(20,6)")
    return (seconds * F.lit(MICROS)).cast("long")


def event_position(ts: Column) -> Column:
    """``epoch_micros`` with missing timestamps placed last."""
    return F.coalesce(epoch_micros(ts), F.lit(NO_TIME))


def floor_div(value: Column, step: int) -> Column:
    """Exact integer floor division, also below zero."""
    return F.call_function("div", value - F.pmod(value, F.lit(step)), F.lit(step))


def minutes_between(earlier: Column, later: Column) -> Column:
    """Number of minute boundaries crossed from ``earlier`` to ``later``."""
    minute = 60 * MICROS
    return floor_div(epoch_micros(later), minute) - floor_div(epoch_micros(earlier), minute)
