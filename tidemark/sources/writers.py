"""Writers and load control: overwrite, upsert, batches, partitions, schema contract, retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from tidemark.functions.types import as_list
from tidemark.sources.readers import partition_format


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def latest_per_key(df: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """The last row of each key by `order` (list enough columns to make it unique).

    `row_number() = 1` lets Spark keep one row per key in every map task before the shuffle, so a key
    that holds a third of the table ships a handful of rows, not a third of the table.
    """
    last_first = Window.partitionBy(*as_list(key)).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rank", F.row_number().over(last_first)).where("_rank = 1").drop("_rank")


def upsert(target: DataFrame, changes: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """Target with `changes` applied: one row per key, the last by `order`; on a tie the change wins."""
    both = target.withColumn("_gen", F.lit(0)).unionByName(changes.withColumn("_gen", F.lit(1)))
    return latest_per_key(both, key, [*order, "_gen"]).drop("_gen")


def upsert_table(target: str, changes: DataFrame, key: str | list[str], order: list[str], parts: int = 64) -> list[int]:
    """Apply `changes` to the table stored at `target`, which is made if it is not there, and return the parts written.

    The table is kept in `parts` folders by a hash of the key (the number is chosen once, with the first call). Only the
    folders that hold a changed key are read, merged and replaced, in one commit; the others stay as they are.
    """
    spark = changes.sparkSession
    tagged = changes.withColumn("_part", F.pmod(F.xxhash64(*as_list(key)), F.lit(parts)).cast("int"))
    touched = [r["_part"] for r in tagged.select("_part").distinct().collect()]  # at most `parts`
    merged = tagged
    if _exists(spark, target):
        merged = spark.read.schema(tagged.schema).parquet(target).where(F.col("_part").isin(touched))
        merged = upsert(merged, tagged, key, order)
    else:
        merged = latest_per_key(tagged, key, order)
    if touched:
        # rows of a part come together, so a task does not open a file in each of them
        parts_together = merged.hint("rebalance", F.col("_part"))
        parts_together.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_part").parquet(target)
    return sorted(touched)


def read_upserted(spark: SparkSession, target: str, schema: StructType | str) -> DataFrame:
    """The rows of a table written by `upsert_table`."""
    return spark.read.schema(schema).parquet(target).drop("_part")


def _folder(spark: SparkSession, path: str):
    """Hadoop's file system for a path, and the path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _exists(spark: SparkSession, path: str) -> bool:
    files, at = _folder(spark, path)
    return files.exists(at)


def write_batched(df: DataFrame, path: str, batch_size: int, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write files of at most `batch_size` rows; the last file of each partition may be shorter."""
    df.write.mode(mode).option("maxRecordsPerFile", batch_size).format(fmt).save(path)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Catalogue table at `path`, hashed by key into `buckets` parts and sorted within them.

    Two tables with the same key and number of buckets are joined and grouped by that key without a
    shuffle, however often. The rows are hashed before the write, so each bucket is one file.
    """
    spark = df.sparkSession
    (
        df.repartition(buckets, key).write.mode("overwrite").option("path", path)
        .bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    )
    return spark.table(table)


def buckets_for(df: DataFrame, bytes_per_bucket: int = 64 << 20) -> int:
    """A number of buckets by the size of the files and tables the frame reads, one at least and no more than Spark allows.

    Spark's estimate for the frame itself is no use here: for a join it is the product of the two sides.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    most = int(df.sparkSession.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return min(most, max(1, -(-size // bytes_per_bucket)))


def with_output_partitions(df: DataFrame, n: int) -> DataFrame:
    """Even, round-robin spread over `n` output partitions."""
    return df.repartition(n)


def load(df: DataFrame, path: str, source: str, clear: bool, batch_size: int | None = None) -> None:
    """Add rows of one data source, after dropping that source's earlier rows when `clear` is set.

    The table is partitioned by source, and clearing replaces that one partition in the commit step,
    so a job that dies half way leaves the earlier rows in place.
    """
    tagged = df.withColumn("data_source", F.lit(source))
    writer = tagged.write.partitionBy("data_source")
    if batch_size:
        writer = writer.option("maxRecordsPerFile", batch_size)
    if clear:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode("append").parquet(path)


def enforce_schema(df: DataFrame, contract: StructType) -> DataFrame:
    """Cast to the declared columns and types, with `rejected_fields`: how many values did not fit.

    Undeclared columns go; a declared column the input lacks is null.
    """
    have = set(df.columns)
    casts, rejects = [], F.lit(0)
    for field in contract.fields:
        if field.name not in have:
            casts.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = F.col(field.name).try_cast(field.dataType)
        casts.append(value.alias(field.name))
        rejects = rejects + (F.col(field.name).isNotNull() & value.isNull()).cast("int")
    return df.select(*casts, rejects.alias("rejected_fields"))


def with_time_partition(df: DataFrame, ts: str, period: str = "day") -> DataFrame:
    """Add `dt`, the day or hour of `ts` as text."""
    return df.withColumn("dt", F.date_format(F.col(ts).cast("timestamp"), partition_format(period)))


def stored_partitions(spark: SparkSession, path: str) -> list[str]:
    """Names of the days or hours stored at `path`, oldest first; a listing, no read."""
    files, at = _folder(spark, path)
    if not files.exists(at):
        return []
    names = [f.getPath().getName() for f in files.listStatus(at) if f.isDirectory()]
    return sorted(n.removeprefix("dt=") for n in names if n.startswith("dt="))


def expire_partitions(spark: SparkSession, path: str, max_active: int) -> list[str]:
    """Delete all but the newest `max_active` partitions of a stored table; returns the names that went."""
    stored = stored_partitions(spark, path)
    old = stored[: max(0, len(stored) - max_active)]
    files, _ = _folder(spark, path)
    for name in old:
        files.delete(_folder(spark, f"{path}/dt={name}")[1], True)
    return old


def write_time_partitions(
    df: DataFrame,
    path: str,
    ts: str,
    period: str = "day",
    max_active: int | None = None,
    mode: str = "overwrite",
    delete_expired: bool = False,
) -> None:
    """Write one folder per day or hour.

    With `max_active`, only rows of the newest so many partitions are written, counting those already stored (none, in
    mode overwrite). Stored partitions beyond them stay unless `delete_expired` is set.

    The rebalance hint brings rows of a partition together, splits a partition that is far larger than
    the others over several tasks, and merges small ones.
    """
    spark = df.sparkSession
    out = with_time_partition(df, ts, period)
    if max_active is not None:
        newest = out.select("dt").distinct().orderBy(F.col("dt").desc()).limit(max_active)
        names = {r["dt"] for r in newest.where("dt IS NOT NULL").collect()}  # at most max_active
        if mode == "append":
            names.update(stored_partitions(spark, path))
        kept = sorted(names)[-max_active:]
        out = out.where(F.col("dt") >= kept[0]) if kept else out.where("dt IS NOT NULL")
    out.hint("rebalance", F.col("dt")).write.mode(mode).partitionBy("dt").parquet(path)
    if max_active is not None and delete_expired:
        expire_partitions(spark, path, max_active)


def read_back(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
