"""Slot arithmetic on TIMESTAMP_NTZ, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _seconds_sql(name: str) -> str:
    # All parts are read off the zone-less wall clock.
    return (
        f"(cast(unix_date(cast(`{name}` as date)) as bigint) * 86400"
        f" + hour(`{name}`) * 3600 + minute(`{name}`) * 60 + second(`{name}`))"
    )


def _micros_sql(name: str) -> str:
    return f"cast(extract(SECOND FROM `{name}`) * 1000000 as bigint)"


def epoch_seconds(name: str) -> Column:
    """Whole seconds since 1970-01-01 of a zone-less timestamp."""
    return F.expr(_seconds_sql(name))


def epoch_seconds_exact(name: str) -> Column:
    """Seconds with their fraction."""
    return F.expr(f"{_seconds_sql(name)} - second(`{name}`) + {_micros_sql(name)} / 1000000D")


def slot_of(name: str, step: int) -> Column:
    """Number of the left-closed slot that holds the timestamp; slots start at midnight."""
    return F.expr(f"cast(floor({_seconds_sql(name)} / {step}D) as bigint)")


def slot_start(name: str, step: int) -> Column:
    """Left edge of a slot as TIMESTAMP_NTZ."""
    seconds = f"(`{name}` * {step})"
    return F.expr(
        "timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval("
        f"cast(floor({seconds} / 86400D) as int), 0, 0, cast(pmod({seconds}, 86400) as decimal(18,6)))"
    )


def minutes_between(start: str, end: str) -> Column:
    """``end - start`` in minutes, fractions kept."""
    micros = (
        f"({_seconds_sql(end)} - second(`{end}`) - {_seconds_sql(start)} + second(`{start}`)) * 1000000"
        f" + {_micros_sql(end)} - {_micros_sql(start)}"
    )
    return F.expr(f"({micros}) / 60000000D")


def fixed(c: Column | str, places: int = 6) -> Column:
    """Half-up rounding by plain double arithmetic, so that every engine agrees on it. Ties go up
    even where the order of a sum has cost the last bit."""
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10**places)
    # floor gives a 64-bit number; beyond its range a double has no places to round.
    return F.when(F.abs(c) < 9e18 / scale, F.floor(c * scale + 0.5001) / F.lit(scale)).when(~F.isnan(c), c)


def null_nan(c: Column) -> Column:
    """NaN becomes NULL; Spark orders NaN above every number, which no threshold wants."""
    return F.when(~F.isnan(c), c)
