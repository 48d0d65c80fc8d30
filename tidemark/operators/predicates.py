"""Row filters."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.geo import bounding_box, distance_km
from tidemark.functions.scalars import hash_bucket
from tidemark.functions.text import has_term, tokens


def require(df: DataFrame, *cols: str, non_empty: bool = False) -> DataFrame:
    """Rows that have a value (with `non_empty`: not the empty text either) in each column."""
    for c in cols:
        df = df.where(F.col(c).isNotNull())
        if non_empty:
            df = df.where(F.col(c) != "")
    return df


def in_range(df: DataFrame, ranges: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """Inclusive numeric ranges, all of which must hold. Text columns are read as numbers first."""
    types = dict(df.dtypes)
    for name, (low, high) in ranges.items():
        col = F.col(name).try_cast("double") if types[name] == "string" else F.col(name)
        if low is not None:
            df = df.where(col >= low)
        if high is not None:
            df = df.where(col <= high)
    return df


def time_range(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """Inclusive range of instants. The bounds take the column's own type, so the test reaches the scan."""
    kind = dict(df.dtypes)[ts]
    return df.where(F.col(ts).between(F.lit(start).cast(kind), F.lit(end).cast(kind)))


def facet_filter(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """field = value for each entry, all of which must hold."""
    for name, value in values.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def text_match(df: DataFrame, col: str, term: str, analyzer: str = "standard") -> DataFrame:
    """Rows whose analysed text holds the term as a token (not as a substring). No stemming."""
    if analyzer == "standard":
        return df.where(has_term(col, term))
    return df.where(F.array_contains(tokens(col, analyzer), term if analyzer == "whitespace" else term.lower()))


def within_km(df: DataFrame, lat: str, lon: str, point: tuple[float, float], km: float) -> DataFrame:
    """Rows at most `km` from the point; a plain box test comes first."""
    return df.where(bounding_box(lat, lon, point, km)).where(distance_km(lat, lon, point) <= km)


def where_in(df: DataFrame, key: str, sub: DataFrame, sub_key: str) -> DataFrame:
    """Rows whose key occurs in `sub`."""
    keys = sub.select(F.col(sub_key).alias("_sub_key"))
    return df.join(keys, F.col(key) == F.col("_sub_key"), "left_semi")


def having(aggregated: DataFrame, condition: Column | str) -> DataFrame:
    return aggregated.where(condition)


def sample_rows(df: DataFrame, key: str | Column, pct: int, seed: int = 0) -> DataFrame:
    """About `pct` percent of the rows, picked by a hash of the key: the same rows in every run and with
    every partitioning. `df.sample` is the cheaper choice where that does not matter."""
    return df.where(hash_bucket(key, 100, seed) < pct)
