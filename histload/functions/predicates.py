"""Predicates over lists of columns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from histload.functions.names import named


def all_not_null(columns: Iterable[str]) -> Column:
    """Every column holds a value. Empty text counts as a value."""
    return reduce(and_, [named(c).isNotNull() for c in columns])


def any_null(columns: Iterable[str]) -> Column:
    return reduce(or_, [named(c).isNull() for c in columns])


def none_blank(columns: Iterable[str]) -> Column:
    """Every column holds a value that is not empty or spaces only."""
    return reduce(and_, [F.trim(named(c).cast("string")) != "" for c in columns])


def any_differs(
    left: str, right: str, columns: Iterable[str], null_safe: bool = True, trim: bool = False
) -> Column:
    """At least one column differs between the relations aliased ``left`` and ``right``.

    Not null-safe, a value that appears or disappears is no difference, as with ``!=`` in SQL.
    """
    tests = []
    for c in columns:
        a, b = named(c, left), named(c, right)
        if trim:
            a, b = F.trim(a), F.trim(b)
        tests.append(~a.eqNullSafe(b) if null_safe else F.coalesce(a != b, F.lit(False)))
    return reduce(or_, tests)
