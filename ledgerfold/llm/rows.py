"""Columns of a table carried along as one struct."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def free_name(taken: Iterable[str], wish: str = "_") -> str:
    """``wish``, longer by as many underscores as it takes to differ from all names in any case."""
    names = {name.lower() for name in taken}
    while wish.lower() in names:
        wish += "_"
    return wish


def carried(columns: Sequence[str]) -> Column:
    """The columns as one struct. Its first field is a zero, so that it is never empty, under a name that is free."""
    spare = F.lit(0).alias(free_name(columns))
    return F.struct(spare, *[F.col(f"`{c}`") for c in columns])
