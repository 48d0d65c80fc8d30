"""Small helpers shared by all column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

ColumnLike = Column | str


def as_col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_list(value: str | list[str] | tuple[str, ...]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def let(value: ColumnLike, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row, however often the body names it."""
    return F.get(F.transform(F.array(as_col(value)), body), F.lit(0))
