"""Load times and range ends, all as timestamps without time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from histload.functions.names import named

# How extracts write timestamps, the end date that marks an open version, and the
# seconds added to the load time where a far horizon marks it.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
SENTINEL = "9999-12-31 23:59:59"
HORIZON_SECONDS = 999999999


def load_time(as_of: datetime | str) -> datetime:
    """A load time as a datetime. One with a time zone is refused, as its offset would be lost."""
    value = datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    if value.tzinfo is not None:
        raise ValueError(f"a load time has no time zone, but this one has: {as_of}")
    return value


def as_of_column(as_of: datetime | str | None = None) -> Column:
    """The load time as a literal; without one, the start of the query."""
    if as_of is None:
        return F.localtimestamp()
    return F.lit(str(load_time(as_of))).cast("timestamp_ntz")


def sentinel() -> Column:
    return F.to_timestamp_ntz(F.lit(SENTINEL), F.lit(TIMESTAMP_FORMAT))


def horizon(as_of: datetime | str | None = None) -> Column:
    return as_of_column(as_of) + F.make_dt_interval(secs=F.lit(HORIZON_SECONDS))


def parse_timestamp(column: str | Column, fmt: str | None = None, strict: bool = True) -> Column:
    """Text to timestamp. Bad text is an error, or null when not ``strict``.

    Timestamps pass through unchanged.
    """
    value = named(column) if isinstance(column, str) else column
    if fmt is None:
        return value.cast("timestamp_ntz") if strict else value.try_cast("timestamp_ntz")
    parsed = F.to_timestamp_ntz(value, F.lit(fmt))
    # try_to_timestamp yields a zoned value, which moves in a daylight-saving gap: it only decides
    # whether the text is valid.
    return parsed if strict else F.when(F.try_to_timestamp(value, F.lit(fmt)).isNotNull(), parsed)


def load_date(as_of: datetime | str | None = None) -> Column:
    return as_of_column(as_of).cast("date")


def load_date_text(as_of: datetime | str | None = None, fmt: str = "yyyy-MM-dd") -> Column:
    return F.date_format(load_date(as_of), fmt)
