"""Catalogue calls a user makes on named tables and views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def cache_as(spark: SparkSession, sql: str, name: str) -> DataFrame:
    """Register a query's result under a name and cache it when it is first read."""
    spark.catalog.dropTempView(name)
    spark.sql(f"CACHE LAZY TABLE `{name}` AS {sql}")
    return spark.table(name)


def show_tables(spark: SparkSession, like: str | None = None) -> DataFrame:
    """Names of tables and views; `like` takes * and | as Spark does."""
    pattern = (like or "*").replace("\\", "\\\\").replace("'", "\\'")
    return spark.sql(f"SHOW TABLES LIKE '{pattern}'").select("tableName", "isTemporary")


def table_sizes(spark: SparkSession, like: str | None = None) -> DataFrame:
    """(table_name, n): listed tables with their row counts."""
    names = [row["tableName"] for row in show_tables(spark, like).collect()]
    if not names:
        return spark.createDataFrame([], "table_name string, n bigint")
    out = None
    for name in sorted(names):
        part = spark.table(name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def describe(spark: SparkSession, name: str) -> DataFrame:
    """One row per column: position, name, type, number of rows, number of nulls. One pass."""
    df = spark.table(name)
    nulls = [F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"z{i}") for i, f in enumerate(df.schema.fields)]
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"), F.col("n"), F.col(f"z{i}").alias("nulls"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return df.agg(F.count(F.lit(1)).alias("n"), *nulls).select(F.inline(rows))


def first_rows(spark: SparkSession, name: str, n: int = 10) -> DataFrame:
    return spark.table(name).limit(n)


def set_cached(spark: SparkSession, name: str, on: bool) -> bool:
    """Cache or uncache a table; returns what the catalogue says afterwards."""
    spark.sql(f"CACHE LAZY TABLE `{name}`" if on else f"UNCACHE TABLE IF EXISTS `{name}`")
    return spark.catalog.isCached(name)


def define_view(
    df: DataFrame, name: str, where: Column | None = None, cols: list[str] | None = None, sort: list[str | Column] | None = None
) -> DataFrame:
    """Named view with a filter, a projection and an order; Spark merges them into the queries that use it."""
    out = df if where is None else df.where(where)
    if cols:
        out = out.select(*cols)
    if sort:
        out = out.orderBy(*sort)
    out.createOrReplaceTempView(name)
    return out
