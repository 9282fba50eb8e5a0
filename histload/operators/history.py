"""Versioned rows: stamping, change detection and merges of a delta into a history.

A version is valid in the half-open range [start, end); a null end marks the open version. The
sentinel and the horizon are other ways to write that, see ``decode_open`` and ``encode_open``.
All functions below those two expect null ends.

A sound history has at most one open version of a key, and any number of closed ones. Only open versions
with a whole key meet the delta; everything else passes by the joins, so a key with a long past costs nothing.
A merge takes a sound history and a delta with one row per key: ``settle`` makes the second,
``check_one_row_per_key`` tells of either. Its result is then sound, and the same whatever the delta's size.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histload.config import MergeConfig, StampConfig
from histload.functions import all_named, any_differs, any_null, as_of_column, horizon, named, sentinel
from histload.operators.dedup import latest_per_key

# ---------------------------------------------------------------- stamps and encodings


def stamp_open(df: DataFrame, config: MergeConfig | StampConfig) -> DataFrame:
    """Turn plain rows into open versions that start at the load time, in the configured encoding."""
    return df.withColumns(
        {config.start: as_of_column(config.as_of), config.end: _open_end(config)}
    )


def _open_end(config: MergeConfig | StampConfig) -> Column:
    if config.open_end == "sentinel":
        return sentinel()
    if config.open_end == "horizon":
        return horizon(config.as_of)
    return F.lit(None).cast("timestamp_ntz")


def decode_open(df: DataFrame, config: MergeConfig | StampConfig) -> DataFrame:
    """Write the end of open versions as null. A null end is open in every encoding."""
    end = named(config.end)
    if config.open_end == "sentinel":
        return df.withColumn(config.end, F.nullif(end, sentinel()))
    if config.open_end == "horizon":
        return df.withColumn(config.end, F.when(end <= as_of_column(config.as_of), end))
    return df


def encode_open(df: DataFrame, config: MergeConfig | StampConfig) -> DataFrame:
    """Write the end of open versions in the configured encoding."""
    return df.withColumn(config.end, F.coalesce(named(config.end), _open_end(config)))


def current_rows(hist: DataFrame, config: MergeConfig) -> DataFrame:
    return hist.where(named(config.end).isNull())


def closed_rows(hist: DataFrame, config: MergeConfig) -> DataFrame:
    return hist.where(named(config.end).isNotNull())


# ---------------------------------------------------------------- soundness


class Unsound(ValueError):
    """A history or delta holds a key more often than a merge allows."""


def open_key_violations(hist: DataFrame, config: MergeConfig) -> DataFrame:
    """Keys with more than one open version; a sound history has none."""
    return _repeated(current_rows(hist, config), config, "n_open")


def _repeated(rows: DataFrame, config: MergeConfig, name: str) -> DataFrame:
    counts = rows.groupBy(*all_named(config.key)).agg(F.count(F.lit(1)).alias(name))
    return counts.where(F.col(name) > 1)


def check_one_row_per_key(rows: DataFrame, config: MergeConfig, what: str) -> None:
    """Raise if a whole key comes more than once."""
    found = _repeated(rows.where(~any_null(config.key)), config, "n_rows").limit(3).collect()
    if found:
        raise Unsound(f"{what}: " + "; ".join(str(r.asDict()) for r in found))


def settle(delta: DataFrame, config: MergeConfig, order_by: Iterable[str]) -> DataFrame:
    """A delta with the last row of each whole key by ``order_by``; rows without a whole key stay."""
    whole = ~any_null(config.key)
    return latest_per_key(delta.where(whole), config.key, order_by).unionByName(delta.where(~whole))


# ---------------------------------------------------------------- joins by key


def _same_key(config: MergeConfig) -> Column:
    return reduce(and_, [named(c, "x") == named(c, "y") for c in config.key])


def _differs(config: MergeConfig) -> Column:
    return any_differs("x", "y", config.tracked, config.null_safe, config.trim)


def _small(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def _met(rows: DataFrame, others: DataFrame, config: MergeConfig, how: str = "left_semi", small: bool = False, differing: bool = False) -> DataFrame:
    """The rows for which there is (``left_anti``: is not) a row of the same key on the other side. No
    pairs are made, however often a key repeats."""
    on = _same_key(config) & _differs(config) if differing else _same_key(config)
    return rows.alias("x").join(_small(others, small).alias("y"), on, how)


def _keys(df: DataFrame, config: MergeConfig) -> DataFrame:
    return df.select(*all_named(config.key)).distinct()


def text_bytes(columns: Iterable[str]) -> Column:
    """Upper bound of the size of a delta with these columns, as an aggregate."""
    text = [F.coalesce(F.octet_length(named(c).cast("string")), F.lit(0)).cast("long") for c in columns]
    return F.coalesce(F.sum(reduce(add, text) + 64 + 16 * len(text)), F.lit(0))


def delta_size(delta: DataFrame) -> int:
    """Upper bound of the size of a delta, from one pass over it."""
    return delta.agg(text_bytes(delta.columns)).first()[0]


def _is_small(delta_bytes: int | None, config: MergeConfig) -> bool:
    """The delta was measured, and may be broadcast."""
    return delta_bytes is not None and delta_bytes <= config.broadcast_bytes


# ---------------------------------------------------------------- change detection

# ``delta_bytes`` is what ``delta_size`` measured; a small delta is broadcast and the history
# stays in place. Without it Spark decides by its own estimates.


#: A key is frequent if it has one in FREQUENT rows or more, and the sketch that finds it counts this many keys, so that
#: it is wrong by less than one in 4 * FREQUENT rows.
FREQUENT, TRACKED = 1000, 16000


def _key_hash(config: MergeConfig) -> Column:
    return F.xxhash64(*all_named(config.key))


def frequent_keys(rows: DataFrame, config: MergeConfig) -> list[int]:
    """Hashes of the keys that have one in a thousand rows or more, and of some that have nearly as many; at most 2,000.

    One pass reads the key columns. A mergeable sketch of frequent items counts them in bounded memory, within each input
    partition first, so no key is gathered. A null key is told like any other; a key that comes once is not frequent.
    """
    top = F.call_function("approx_top_k", _key_hash(config), F.lit(2 * FREQUENT), F.lit(TRACKED))
    found, n = rows.agg(top, F.count(F.lit(1))).first()
    return [item["item"] for item in found if item["count"] > 1 and item["count"] * FREQUENT >= n]


def new_keys(
    delta: DataFrame, hist: DataFrame, config: MergeConfig, delta_bytes: int | None = None, hot: Collection[int] = ()
) -> DataFrame:
    """Rows of the delta whose key is in no version of the history.

    The history's keys are made distinct before they meet the delta, and Spark cannot split a hot key of the delta against
    that. Rows of the keys in ``hot``, which ``frequent_keys`` found in the delta, stay where they are: which of these
    keys the history has is broadcast. That is a key for each hash, 2,000 at most but for keys that share a hash. It
    reads the history's key columns once more.
    """
    if _is_small(delta_bytes, config):
        hist = _met(hist, _keys(delta, config), config, small=True)
    if not hot:
        return _met(delta, _keys(hist, config), config, "left_anti")
    often = _key_hash(config).isin(*hot)
    rest = _met(delta.where(~often), _keys(hist.where(~often), config), config, "left_anti")
    whole = hist.where(often & ~any_null(config.key))
    return rest.unionByName(_met(delta.where(often), _keys(whole, config), config, "left_anti", small=True))


def changed_rows(
    delta: DataFrame, hist: DataFrame, config: MergeConfig, delta_bytes: int | None = None
) -> DataFrame:
    """Rows of the delta that differ from an open version of their key."""
    current = current_rows(hist, config)
    if _is_small(delta_bytes, config):
        current = _met(current, _keys(delta, config), config, small=True)
    return _met(delta, current, config, differing=True)


def rows_to_close(
    hist: DataFrame,
    delta: DataFrame,
    config: MergeConfig,
    only_changed: bool = False,
    delta_bytes: int | None = None,
) -> DataFrame:
    """Open versions whose key is in the delta (or changes in it), closed at the load time."""
    small = _is_small(delta_bytes, config)
    found = _met(current_rows(hist, config), delta, config, small=small, differing=only_changed)
    return found.withColumn(config.end, as_of_column(config.as_of))


def carry_forward(
    hist: DataFrame, delta: DataFrame, config: MergeConfig, delta_bytes: int | None = None
) -> DataFrame:
    """Every version the merge leaves as it is: closed ones, and open ones without a change."""
    current, beside = _split(hist, config)
    small = _is_small(delta_bytes, config)
    return _met(current, delta, config, "left_anti", small, differing=True).unionByName(beside)


# ---------------------------------------------------------------- merges


def _split(hist: DataFrame, config: MergeConfig) -> tuple[DataFrame, DataFrame]:
    """Open versions with a whole key, and the rest.

    The two filters exclude each other, so on a history partitioned by openness each reads its own
    files. Rows with a null key match nothing; in a join they would all land in one task.
    """
    meets = named(config.end).isNull() & ~any_null(config.key)
    return hist.where(meets), hist.where(~meets)


#: Bits of the filter per key of the delta; one in BITS open versions without a match passes it.
BITS = 16
_BITMAP = 32768  # fixed value: bits in one of Spark's bitmaps


def _bit(config: MergeConfig, n_bits: int) -> Column:
    return F.pmod(F.xxhash64(*[named(c).cast("string") for c in config.key]), F.lit(n_bits))


def key_filter(delta: DataFrame, config: MergeConfig, n_bits: int) -> DataFrame:
    """Which of ``n_bits`` bits a key of the delta sets, as bitmaps: (bits_of, bits). Partial bitmaps are made where the rows
    are, so a key's copies cost nothing."""
    bit = _bit(config, n_bits)
    of = F.floor(bit / _BITMAP)
    rows = delta.where(~any_null(config.key)).select(of.alias("bits_of"), (bit % _BITMAP).alias("bit"))
    return rows.groupBy("bits_of").agg(F.bitmap_construct_agg("bit").alias("bits"))


def _filter_bits(delta: DataFrame, config: MergeConfig, delta_bytes: int | None) -> int:
    """How many bits a filter of the delta's keys takes: 0 if the delta may be broadcast itself, if its filter may not, or if its
    size is unknown. Keys of a floating type have several texts for a value, and no filter."""
    if delta_bytes is None or _is_small(delta_bytes, config):
        return 0
    kinds = dict(delta.dtypes)
    if any(kinds[c] in ("float", "double") for c in config.key):
        return 0
    most_rows = delta_bytes // 64 + 1  # text_bytes counts more for a row
    n_bits = -(-BITS * most_rows // _BITMAP) * _BITMAP
    return n_bits if n_bits // 8 <= config.broadcast_bytes else 0


def _thinned(current: DataFrame, delta: DataFrame, config: MergeConfig, delta_bytes: int | None) -> tuple[DataFrame, DataFrame | None]:
    """Open versions that may meet the delta, and those that cannot, which need no shuffle. Between a delta that can be
    broadcast and one whose filter cannot, the filter decides."""
    n_bits = _filter_bits(delta, config, delta_bytes)
    if not n_bits:
        return current, None
    bits = F.broadcast(key_filter(delta, config, n_bits))  # n_bits, held against broadcast_bytes
    placed = current.withColumn("__bit", _bit(config, n_bits))
    tested = placed.join(bits, F.floor(F.col("__bit") / _BITMAP) == F.col("bits_of"), "left")
    byte = F.expr(f"cast(conv(hex(substring(bits, cast(__bit % {_BITMAP} div 8 as int) + 1, 1)), 16, 10) as int)")
    may = F.coalesce(F.getbit(byte, (F.col("__bit") % 8).cast("int")) == 1, F.lit(False))
    return tested.where(may).select(*all_named(current.columns)), tested.where(~may).select(*all_named(current.columns))


def merge_reversion_all(
    hist: DataFrame, delta: DataFrame, config: MergeConfig, delta_bytes: int | None = None
) -> DataFrame:
    """Close the open version of every key in the delta, changed or not, and add the whole delta.

    Only the distinct keys of the delta are looked up, so the delta itself is not shuffled, and with
    a delta measured as small (``delta_bytes``, see ``delta_size``) the history is not either. Beyond that a filter of
    the delta's keys lets most open versions that are not in it pass by.
    """
    current, beside = _split(hist, config)
    current, passing = _thinned(current, delta, config, delta_bytes)
    if passing is not None:
        beside = beside.unionByName(passing)
    keys = _keys(delta.where(~any_null(config.key)), config).withColumn("__hit", F.lit(True))
    judged = current.alias("x").join(_small(keys, _is_small(delta_bytes, config)).alias("y"), _same_key(config), "left")
    end = F.when(F.col("__hit").isNotNull(), as_of_column(config.as_of)).otherwise(named(config.end, "x"))
    closed = judged.select(*[(end if c == config.end else named(c, "x")).alias(c) for c in hist.columns])
    return closed.unionByName(beside).unionByName(delta)


def merge_changed_only(
    hist: DataFrame, delta: DataFrame, config: MergeConfig, delta_bytes: int | None = None
) -> DataFrame:
    """Close the open versions that change in the delta, and add its changed and new rows.

    A key without an open version counts as new, so a key that had been closed comes back. Merging
    the same delta again changes nothing. History and delta meet in one full outer join. A delta measured as
    small (``delta_bytes``, see ``delta_size``) is broadcast instead, and the history is not shuffled; only its
    keys are read once more, to tell which rows of the delta are new. Beyond that a filter of the delta's keys lets most
    open versions that are not in it pass by the join.
    """
    current, beside = _split(hist, config)
    whole = ~any_null(config.key)
    keyed, keyless = delta.where(whole), delta.where(~whole)
    if _is_small(delta_bytes, config):
        known = _met(current.select(*all_named(config.key)), _keys(keyed, config), config, small=True)
        new = _met(keyed, known, config, "left_anti")
        met = _meet(current, keyed, config, "left", small=True).unionByName(new)
    else:
        current, passing = _thinned(current, keyed, config, delta_bytes)
        met = _meet(current, keyed, config, "full_outer")
        beside = beside.unionByName(passing) if passing is not None else beside
    return met.unionByName(beside).unionByName(keyless)


def _meet(current: DataFrame, delta: DataFrame, config: MergeConfig, how: str, small: bool = False) -> DataFrame:
    """Each pair yields the old version, the new one, or both."""
    old_side = current.withColumn("__old", F.lit(True)).alias("x")
    new_side = _small(delta.withColumn("__new", F.lit(True)), small).alias("y")
    pairs = old_side.join(new_side, _same_key(config), how)
    has_old, has_new = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    acts = has_new & (~has_old | _differs(config))
    end = F.when(acts, as_of_column(config.as_of)).otherwise(named(config.end, "x"))
    old = F.struct(*[(end if c == config.end else named(c, "x")).alias(c) for c in current.columns])
    new = F.struct(*[named(c, "y").alias(c) for c in current.columns])
    versions = (
        F.when(has_old & acts, F.array(old, new)).when(has_old, F.array(old)).otherwise(F.array(new))
    )
    return pairs.select(F.inline(versions))


# ---------------------------------------------------------------- set operations and order


def union_by_position(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


def union_by_name(parts: Iterable[DataFrame]) -> DataFrame:
    """Rows of all parts; a part without one of the columns is an error."""
    return reduce(DataFrame.unionByName, parts)


def order_history(hist: DataFrame, config: MergeConfig) -> DataFrame:
    """Versions of each key together, oldest end first, the open one last.

    The remaining columns break ties, which also lets Spark cut a key with many versions into
    several sort ranges.
    """
    first = [*config.key, config.end, config.start]
    rest = [c for c in hist.columns if c not in first]
    return hist.orderBy(*[named(c).asc_nulls_last() for c in first + rest])
