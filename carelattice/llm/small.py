"""Broadcast of id lists behind a check of their size; names that clash with no column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows up to which a list of longs is broadcast (32 MB); a longer list is joined through a shuffle.
BROADCAST_IDS = 2_000_000


def if_few(ids: DataFrame, rows: int | None = None) -> DataFrame:
    """``ids``, a written table of one long column, marked for broadcast when it is short."""
    return F.broadcast(ids) if (ids.count() if rows is None else rows) <= BROADCAST_IDS else ids


def free_prefix(columns: list[str]) -> str:
    """Underscores that no column begins with as many of, so that names behind them clash with none."""
    return "_" * (1 + max((len(c) - len(c.lstrip("_")) for c in columns), default=0))
