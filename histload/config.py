"""Parameters of the operators and jobs, checked when they are made."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from histload.functions.timestamps import load_time

OPEN_ENDS = ("null", "sentinel", "horizon")
MERGE_MODES = ("changed_only", "reversion_all")
DEDUP_MODES = ("rows", "latest")

# Bytes up to which a delta may be broadcast.
BROADCAST_BYTES = 128 << 20
# Fixed value: bits in one bitmap of Spark, in which a load notes the buckets it touches.
MOST_BUCKETS = 32768


def _names(value) -> tuple[str, ...]:
    """A comma list or a sequence of column names as a tuple."""
    if value is None:
        return ()
    parts = value.split(",") if isinstance(value, str) else value
    return tuple(p.strip() for p in parts if p.strip())


def _flag(value) -> bool:
    if isinstance(value, bool):
        return value
    return str(value).strip().upper() == "Y"


def _all_names(config, *fields: str) -> None:
    for name in fields:
        object.__setattr__(config, name, _names(getattr(config, name)))


@dataclass(frozen=True)
class GateConfig:
    """Which quality gates run, and on which columns."""

    columns: tuple[str, ...] = ()
    types: Mapping[str, str] = field(default_factory=dict)
    count_check: bool = True
    schema_check: bool = False
    null_check: bool = False
    null_columns: tuple[str, ...] = ()
    duplicate_check: bool = False
    duplicate_columns: tuple[str, ...] = ()
    duplicate_order: tuple[str, ...] = ()

    def __post_init__(self):
        _all_names(self, "columns", "null_columns", "duplicate_columns", "duplicate_order")
        if self.schema_check and not self.columns:
            raise ValueError("the schema gate needs the expected columns")
        if self.null_check and not self.null_columns:
            raise ValueError("the null gate needs columns")
        if self.duplicate_check and not self.duplicate_columns:
            raise ValueError("the duplicate gate needs key columns")

    @classmethod
    def from_options(cls, options: Mapping[str, str]) -> GateConfig:
        """Read Y/N flags and comma lists, as kept in one section of a job's settings file."""
        given = {k.lower(): v for k, v in options.items()}

        # The option names users have in their settings files.
        return cls(
            columns=given.get("cccolumns_schema_validation", given.get("cccolumns")),
            count_check=_flag(given.get("count_check", "N")),
            schema_check=_flag(given.get("cccolumns_schema_validation_flag", "N")),
            null_check=_flag(given.get("null_check", "N")),
            null_columns=given.get("null_check_columns"),
            duplicate_check=_flag(given.get("duplicate_check", "N")),
            duplicate_columns=given.get("duplicate_check_columns"),
            duplicate_order=given.get("duplicate_check_columns_order_by_column"),
        )


@dataclass(frozen=True)
class DriftConfig:
    """How far a load's columns may be from those of the load before.

    ``null_share``: by how much the share of nulls may rise or fall. ``distance``: the largest difference of the cumulative
    shares of values (for texts, of their lengths). ``new_share``: the part of distinct values that may not have been there
    before; 1 allows any.
    """

    columns: tuple[str, ...]
    null_share: float = 0.1
    distance: float = 0.2
    new_share: float = 1.0

    def __post_init__(self):
        _all_names(self, "columns")
        if not self.columns:
            raise ValueError("the drift gate needs columns")
        for name in ("null_share", "distance", "new_share"):
            if not 0 <= getattr(self, name) <= 1:
                raise ValueError(f"{name} is a share, from 0 to 1")


@dataclass(frozen=True)
class StampConfig:
    """The effective range of a version: its columns, the load time, and how an open end is written.

    Without ``as_of`` the time of the query is used, which is only right when one query does all the work.
    """

    as_of: datetime | None = None
    start: str = "start_date"
    end: str = "end_date"
    open_end: str = "null"

    def __post_init__(self):
        if self.as_of is not None:
            object.__setattr__(self, "as_of", load_time(self.as_of))
        if self.open_end not in OPEN_ENDS:
            raise ValueError(f"open_end must be one of {OPEN_ENDS}")
        if self.start == self.end:
            raise ValueError("start and end are two columns")


@dataclass(frozen=True)
class MergeConfig:
    """How versions of a key are compared, closed and opened. ``as_of`` both closes old versions and
    starts new ones."""

    key: tuple[str, ...]
    tracked: tuple[str, ...]
    as_of: datetime | None = None
    start: str = "start_date"
    end: str = "end_date"
    open_end: str = "null"
    null_safe: bool = True
    trim: bool = False
    broadcast_bytes: int = BROADCAST_BYTES

    def __post_init__(self):
        _all_names(self, "key", "tracked")
        if not self.key or not self.tracked:
            raise ValueError("key and tracked columns must be named")
        if set(self.key) & set(self.tracked):
            raise ValueError("a column cannot be both key and tracked")
        stamp = StampConfig(self.as_of, self.start, self.end, self.open_end)
        object.__setattr__(self, "as_of", stamp.as_of)


@dataclass(frozen=True)
class ExtractConfig:
    """A delimited extract: its columns, how it is read, which rows are whole, what is left out at the end.

    Without a ``schema`` it is inferred. ``csv`` goes to the reader: delimiter, quote, escape, multiLine, mode.
    ``audit`` columns can be used to order rows and are dropped after that.
    """

    required: tuple[str, ...]
    schema: str | None = None
    audit: tuple[str, ...] = ()
    gates: GateConfig | None = None
    csv: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        _all_names(self, "required", "audit")


@dataclass(frozen=True)
class Sink:
    """A table that a job overwrites: parquet at a path, or any format with a connector."""

    path: str | None = None
    fmt: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()

    def __post_init__(self):
        _all_names(self, "partition_by")


@dataclass(frozen=True)
class HistoryLoadConfig:
    """A load that meets a history. Of rows that share a key, the last by ``latest_order`` is loaded.

    Open versions are kept in ``buckets`` by key; a load reads and writes those that its delta touches. The number is
    fixed with the first load. The history is also written to ``sink``, if there is one. ``evolve`` lets an extract have
    columns that the history has not, and the other way round; without it such an extract is refused. ``drift`` holds an
    extract against the one loaded before it.
    """

    extract: ExtractConfig
    merge: MergeConfig
    latest_order: tuple[str, ...]
    mode: str = "changed_only"
    buckets: int = 64
    sink: Sink | None = None
    evolve: bool = True
    drift: DriftConfig | None = None

    def __post_init__(self):
        _all_names(self, "latest_order")
        if self.mode not in MERGE_MODES:
            raise ValueError(f"mode must be one of {MERGE_MODES}")
        if not self.merge.as_of:
            raise ValueError("a load runs several queries and needs one fixed as_of")
        if not self.latest_order:
            raise ValueError("latest_order must say which row of a key is the newest")
        if not 1 <= self.buckets <= MOST_BUCKETS:
            raise ValueError(f"there are 1 to {MOST_BUCKETS} buckets")
        if not set(self.merge.key) <= set(self.extract.required):
            raise ValueError("every key column must be required: rows without a key have no history")


@dataclass(frozen=True)
class DimensionLoadConfig:
    """A load without history: the rows of the extract, stamped with an open range, replace a table.

    Rows left out and reports go to the folder ``aside``. Without it they are beside a parquet table, and for a connector
    in the shared folder.
    """

    extract: ExtractConfig
    stamp: StampConfig
    sink: Sink
    dedup: str = "rows"
    latest_key: tuple[str, ...] = ()
    latest_order: tuple[str, ...] = ()
    aside: str | None = None

    def __post_init__(self):
        _all_names(self, "latest_key", "latest_order")
        if self.dedup not in DEDUP_MODES:
            raise ValueError(f"dedup must be one of {DEDUP_MODES}")
        if not self.stamp.as_of:
            raise ValueError("a load runs several queries and needs one fixed as_of")
        if (self.dedup == "latest") != bool(self.latest_key and self.latest_order):
            raise ValueError("latest_key and latest_order go with dedup='latest', both of them")
