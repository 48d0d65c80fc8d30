"""A stored index from tokens to documents, so that a match reads one bucket and not every text.

Two catalogue tables: `<name>` has one row per (token, id, load), hashed by token into buckets and sorted within them, and `<name>_loads` one per
(id, load). A load adds rows to both and rewrites nothing. A document that is loaded again leaves stale rows behind, which a third table,
`<name>_stale`, names; a match takes them out. It holds reloaded documents only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.text import tokens

BUCKETS = 64


def _append(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    # dealt by bucket before the write; a bucket too large for one task is split over several, each with a sorted file of its own
    (
        df.withColumn("_bucket", F.pmod(F.hash(key), F.lit(buckets))).hint("rebalance", F.col("_bucket")).drop("_bucket").write.mode("append").format("parquet").option("path", path)
        .bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    )


def index_tokens(
    docs: DataFrame, name: str, path: str, id_col: str = "id", text_col: str = "text", load: int = 0, buckets: int = BUCKETS, kind: str = "standard"
) -> None:
    """Add the documents of one load to the index `name`, whose files lie below `path`.

    Each token of a document is kept once. Documents that an earlier load brought are replaced; loads have rising numbers. Rows without an
    id are left out, and a document without text, or of no tokens, takes the place of its earlier form. Choose `buckets` with the first load so
    that a bucket is a few hundred MB at the size the index will have.
    """
    spark = docs.sparkSession
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.array_distinct(tokens(text_col, kind)).alias("tokens"))
    words = rows.select(F.explode("tokens").alias("token"), "id", F.lit(load).cast("long").alias("load"))
    ids = rows.select("id", F.lit(load).cast("long").alias("load")).distinct()
    stale = ids.select("id", F.col("load").alias("before"))
    if spark.catalog.tableExists(f"{name}_loads"):
        stale = stale.join(spark.table(f"{name}_loads").select("id").distinct(), "id", "left_semi")
    else:
        stale = stale.limit(0)
    _append(stale, f"{name}_stale", f"{path}/stale", "id", buckets)
    _append(words, name, f"{path}/tokens", "token", buckets)
    _append(ids, f"{name}_loads", f"{path}/loads", "id", buckets)


def match_ids(spark: SparkSession, name: str, words: list[str], every: bool = True) -> DataFrame:
    """Ids of the documents that hold all of the tokens (any of them, without `every`). Give tokens as the index has them.

    The filter on the token picks its bucket, and row groups within it by their bounds; no text is read.
    """
    wanted = sorted(set(words))
    hits = spark.table(name).where(F.col("token").isin(wanted))
    stale = spark.table(f"{name}_stale").groupBy("id").agg(F.max("before").alias("before"))
    valid = hits.join(stale, "id", "left").where(F.col("before").isNull() | (F.col("load") >= F.col("before")))
    found = valid.groupBy("id").agg(F.count_distinct("token").alias("n"))
    return found.where(F.col("n") == len(wanted)).select("id") if every and len(wanted) > 1 else found.select("id")


def drop_index(spark: SparkSession, name: str) -> None:
    """Forget the tables; their files stay."""
    for table in (name, f"{name}_loads", f"{name}_stale"):
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def matches(ids: DataFrame, docs: DataFrame, id_col: str | Column = "id") -> DataFrame:
    """The documents with these ids."""
    return docs.join(ids.withColumnRenamed("id", id_col), id_col, "left_semi")
