from histload.functions.names import all_named, named, quoted
from histload.functions.predicates import (
    all_not_null,
    any_differs,
    any_null,
    none_blank,
)
from histload.functions.timestamps import (
    HORIZON_SECONDS,
    SENTINEL,
    TIMESTAMP_FORMAT,
    as_of_column,
    horizon,
    load_date,
    load_date_text,
    load_time,
    parse_timestamp,
    sentinel,
)

__all__ = [
    "HORIZON_SECONDS",
    "SENTINEL",
    "TIMESTAMP_FORMAT",
    "all_named",
    "all_not_null",
    "any_differs",
    "any_null",
    "as_of_column",
    "horizon",
    "load_date",
    "load_date_text",
    "load_time",
    "named",
    "none_blank",
    "parse_timestamp",
    "quoted",
    "sentinel",
]
