"""Aggregations, facets, column profiles, grids, top-k, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, NumericType

from tidemark.functions.geo import grid_cell
from tidemark.scratch import materialize


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def facet(
    df: DataFrame,
    by: str | list[str],
    aggs: list[Column],
    order: list[Column] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Group, aggregate, sort and cut. Put the group columns last in `order` to settle ties."""
    by = [by] if isinstance(by, str) else by
    out = df.groupBy(*by).agg(*aggs)
    if order:
        out = out.orderBy(*order)
    return out.limit(limit) if limit is not None else out


def column_profile(df: DataFrame, cols: list[str], top_n: int = 10) -> DataFrame:
    """One row per number column (count, nulls, min, max, avg) and up to `top_n` rows per text or list
    column (its most frequent values with their counts), as (column, value, n, nulls, min, max, avg).

    Numbers take one aggregate without grouping. All text columns share one pass: each row is turned into
    (column, value) pairs, which are counted in the map tasks before the shuffle, and the ranking keeps
    `top_n` values per column in each task before it exchanges them.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = [c for c in cols if isinstance(types[c], NumericType)]
    listed = [c for c in cols if isinstance(types[c], ArrayType)]
    textual = [c for c in cols if c not in numeric and c not in listed]
    parts = []
    if numeric:
        aggs = []
        for i, c in enumerate(numeric):
            col = F.col(c).cast("double")
            aggs += [
                F.count(col).alias(f"n{i}"), F.count_if(col.isNull()).alias(f"z{i}"), F.min(col).alias(f"lo{i}"),
                F.max(col).alias(f"hi{i}"), F.round(F.avg(col), 6).alias(f"av{i}"),
            ]
        rows = F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"), F.lit(None).cast("string").alias("value"), F.col(f"n{i}").alias("n"),
                    F.col(f"z{i}").alias("nulls"), F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"),
                    F.col(f"av{i}").alias("avg"),
                )
                for i, c in enumerate(numeric)
            ]
        )
        parts.append(df.agg(*aggs).select(F.inline(rows)))
    if textual or listed:
        pairs = [F.array(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))) for c in textual]
        pairs += [_list_pairs(c, types[c]) for c in listed]
        # the outer form keeps Spark from building the list once more to see if it is empty
        flat = df.select(F.inline_outer(F.concat(*pairs) if len(pairs) > 1 else pairs[0]))
        counted = flat.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        ranked = Window.partitionBy("column").orderBy(F.col("n").desc(), F.col("value"))
        top = counted.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") <= top_n)
        none = F.lit(None).cast("double")
        parts.append(
            top.select(
                "column", "value", "n", F.lit(None).cast("bigint").alias("nulls"), none.alias("min"), none.alias("max"),
                none.alias("avg"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _list_pairs(name: str, kind: ArrayType) -> Column:
    values = F.coalesce(F.col(name), F.array().cast(kind))
    return F.transform(values, lambda v: F.struct(F.lit(name).alias("column"), v.cast("string").alias("value")))


def approx_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Sketch-based profile: distinct count and median of each column in one pass with small state."""
    aggs = []
    for f in df.schema.fields:
        if f.name not in cols:
            continue
        aggs.append(F.approx_count_distinct(f.name).alias(f"{f.name}_distinct"))
        if isinstance(f.dataType, NumericType):
            aggs.append(F.approx_percentile(f.name, 0.5).alias(f"{f.name}_median"))
    return df.agg(*aggs)


def exact_profile(df: DataFrame, cols: list[str], shares: list[float]) -> DataFrame:
    """(column, distinct, quantiles) of numeric columns, exactly, quantiles between two values as `percentile` gives them, in double precision.

    Rows become counts per value in the map tasks, and the values are ranged over partitions, whose numbers of rows, one row each, give the
    others their offsets. So no task holds all values of a column. A column without values has no row.
    """
    each = F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_value")) for c in cols)))
    counts = df.select(each).where(F.col("_value").isNotNull()).groupBy("column", "_value").agg(F.count(F.lit(1)).alias("_n"))
    ranged = materialize(counts.repartitionByRange("column", "_value").withColumn("_part", F.spark_partition_id()), "values")
    sizes = ranged.groupBy("column", "_part").agg(F.sum("_n").alias("_size"))
    parts = Window.partitionBy("column")  # one row per partition
    before = parts.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("column", "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"), F.sum("_size").over(parts).alias("_rows"))
    inside = F.sum("_n").over(Window.partitionBy("column", "_part").orderBy("_value"))
    placed = ranged.withColumn("_upto", inside).join(F.broadcast(offsets), ["column", "_part"]).withColumn("_upto", F.col("_upto") + F.col("_offset"))

    def at(share: float) -> Column:
        place = F.lit(share) * (F.col("_rows") - 1)
        low, high = (F.min(F.when(F.col("_upto") > to(place), F.col("_value"))) for to in (F.floor, F.ceil))
        part = F.max(place - F.floor(place))
        return low * (1 - part) + high * part

    return placed.groupBy("column").agg(F.count(F.lit(1)).alias("distinct"), F.array(*(at(s) for s in shares)).alias("quantiles"))


def time_histogram(df: DataFrame, ts: str, unit: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows per day, hour, ... of a timestamp column, optionally within an inclusive range."""
    kind = dict(df.dtypes)[ts]
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start).cast(kind))
    if end is not None:
        df = df.where(F.col(ts) <= F.lit(end).cast(kind))
    return df.groupBy(F.date_trunc(unit, ts).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def geo_grid(
    df: DataFrame, lat: str, lon: str, box: tuple[float, float, float, float], cell_deg: float = 1.40625
) -> DataFrame:
    """Points per grid cell within the box (west, south, east, north); cells count from -180 and -90."""
    west, south, east, north = box
    inside = df.where(F.col(lat).between(south, north) & F.col(lon).between(west, east))
    return inside.groupBy(
        grid_cell(lon, -180.0, cell_deg).alias("cell_x"), grid_cell(lat, -90.0, cell_deg).alias("cell_y")
    ).agg(F.count(F.lit(1)).alias("n"))


def collect_by_key(pairs: Column, key: str, value: str, keys: list[str], unique: bool = False) -> Column:
    """Group a row's list of (key, value) structs into a map key -> values, for the keys listed.

    It works within the row, so no group is ever larger than one record. With `unique`, values are a
    sorted set; otherwise they keep their order.
    """

    def values_of(k: str) -> Column:
        picked = F.transform(F.filter(pairs, lambda p: p[key] == F.lit(k)), lambda p: p[value])
        return F.sort_array(F.array_distinct(picked)) if unique else picked

    return F.map_from_arrays(F.array(*[F.lit(k) for k in keys]), F.array(*[values_of(k) for k in keys]))


def topk(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First `n` rows by `order`, which should end in a unique column. Each task keeps `n` rows."""
    return df.orderBy(*order).limit(n)


def page(df: DataFrame, order: list[Column], n: int | None = None, where: Column | None = None) -> DataFrame:
    """Filter, sort and cut; `n=None` returns all rows."""
    if where is not None:
        df = df.where(where)
    out = df.orderBy(*order)
    return out if n is None else out.limit(n)


def ordered(df: DataFrame, *key: str) -> DataFrame:
    return df.orderBy(*key)


def distinct_pairs(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct() if cols else df.distinct()


def common_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows found in both. Each side is reduced to distinct rows first, so a frequent row meets the
    other side once."""
    return a.distinct().intersect(b.distinct())


