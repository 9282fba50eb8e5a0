"""Columns by name, whatever characters the name holds."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def named(name: str, relation: str | None = None) -> Column:
    """The column called ``name``, dots included, of a relation known by an alias if one is given."""
    return F.col(f"{relation}.{quoted(name)}" if relation else quoted(name))


def all_named(names: Iterable[str], relation: str | None = None) -> list[Column]:
    return [named(n, relation) for n in names]
