"""Joins. Broadcasts are left to Spark's own size test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.geo import distance_between_km, space_cell
from tidemark.functions.types import as_list

Keys = str | list[str]


def join_inner(left: DataFrame, right: DataFrame, on: Keys) -> DataFrame:
    return left.join(right, on, "inner")


def join_left(left: DataFrame, right: DataFrame, on: Keys, right_cols: list[str]) -> DataFrame:
    """All rows of `left`, with `right_cols` where the right side has the key."""
    return left.join(right.select(*as_list(on), *right_cols), on, "left")


def semi(left: DataFrame, right: DataFrame, on: Keys) -> DataFrame:
    return left.join(right.select(*as_list(on)), on, "left_semi")


def join_topk(
    dim: DataFrame, fact: DataFrame, key: str, aggs: list[Column], order: list[Column], n: int, keep: Column | None = None
) -> DataFrame:
    """Aggregate `fact` by key, keep the first `n` groups by `order`, then look up `dim`.

    Spark knows that the small side has at most `n` rows, and decides by that.
    """
    grouped = fact.groupBy(key).agg(*aggs)
    if keep is not None:
        grouped = grouped.where(keep)
    top = grouped.orderBy(*order).limit(n)
    return dim.join(top, key)


def join_filtered(fact: DataFrame, dim: DataFrame, predicate: Column, on: Keys) -> DataFrame:
    """Join to the part of `dim` that passes `predicate`; adaptive execution picks a broadcast when that
    part turns out small."""
    return fact.join(dim.where(predicate), on, "inner")


def hash_join(left: DataFrame, right: DataFrame, on: Keys, strategy: str = "hash") -> DataFrame:
    """Inner join with a chosen strategy.

    hash   both sides partitioned by the key, a hash table per partition of the right side
    merge  both sides partitioned and sorted by the key
    auto   Spark decides, by the sizes it knows or finds at run time
    """
    hints = {"hash": "shuffle_hash", "merge": "merge", "auto": None}
    if strategy not in hints:
        raise ValueError(f"unknown strategy {strategy!r}")
    hint = hints[strategy]
    return left.join(right.hint(hint) if hint else right, on)


def join_near(
    points: DataFrame, centres: DataFrame, km: float, lat: str = "latitude", lon: str = "longitude",
    centre_lat: str = "centre_latitude", centre_lon: str = "centre_longitude", distance: str = "km",
) -> DataFrame:
    """Every pair of a point and a centre at most `km` apart, with the distance; all columns of both sides.

    Space is cut into cubes as wide as the radius. A point is in one of them, a centre is sent to its own and the 26 around it, so the join has
    a plain key, meets each pair once, and the distance is worked out for near pairs only. Rows without a place pair up with nothing. A crowded
    cube is a skewed key, which adaptive execution splits.
    """
    if km <= 0:
        raise ValueError("km must be positive")
    cell = ["_x", "_y", "_z"]
    around = [F.explode(F.array(*(c + i for i in (-1, 0, 1)))) for c in space_cell(centre_lat, centre_lon, km)]
    sent = centres.where(F.col(centre_lat).isNotNull() & F.col(centre_lon).isNotNull())
    for name, each in zip(cell, around, strict=True):
        sent = sent.withColumn(name, each)
    held = points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).withColumns(dict(zip(cell, space_cell(lat, lon, km), strict=True)))
    pairs = held.join(sent, cell).drop(*cell)
    return pairs.withColumn(distance, distance_between_km(lat, lon, centre_lat, centre_lon)).where(F.col(distance) <= km)
