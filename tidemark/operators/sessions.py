"""Gap-based sessions that hold up when one key has a large share of all rows.

A plain window by key sorts all rows of that key in one task. Here the time line of every key is cut into slices
of fixed length: rows are windowed by (key, slice), and the slices are joined up through one small row each that
holds its first and last instant and the number of breaks inside. There is one path for all keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.scalars import epoch_ms, make_id
from tidemark.functions.types import as_list

SLICE_MS = 60_000


def sessionize(df: DataFrame, key: str | list[str], ts: str, gap_ms: int = 30_000, slice_ms: int = SLICE_MS) -> DataFrame:
    """Add `diff_ms`, the milliseconds since the key's previous row (null on its first), and `session_id`,
    the running count of gaps strictly longer than `gap_ms`, from 0 per key.

    Rows of one key with equal `ts` share a session. A row without a key or an instant belongs to no
    session: both columns are null.

    `slice_ms` changes how the work is spread, not the result: no task sees more of a key than one slice of its
    time, and the rows between slices are one per (key, slice). The rows are shuffled once, by (key, slice), and
    the join to the slice rows keeps that partitioning. `df` is read twice, once for its key and instant only.
    """
    keys = as_list(key)
    where = [*keys, "_slice"]
    complete = reduce(lambda a, c: a & c, [F.col(c).isNotNull() for c in [*keys, ts]])
    # rows without a key or an instant are spread by their content, so that they do not pile up in one task
    spread = -1 - F.pmod(F.xxhash64(*(F.col(c) for c, kind in df.dtypes if not kind.startswith("map"))), F.lit(1 << 20))
    cut = df.withColumns({"_ms": epoch_ms(ts), "_known": complete}).withColumn(
        "_slice", F.when(F.col("_known"), F.expr(f"_ms div {int(slice_ms)}")).otherwise(spread)
    )

    def windowed(part: DataFrame) -> DataFrame:
        in_slice = Window.partitionBy(*where).orderBy(ts)
        gap = part.withColumn("_gap", F.col("_ms") - F.lag("_ms").over(in_slice))
        return gap.withColumn("_local", F.sum(F.when(F.col("_gap") > gap_ms, 1).otherwise(0)).over(in_slice))

    edges = (
        windowed(cut.where("_known").select(*where, ts, "_ms"))
        .groupBy(*where)
        .agg(F.min("_ms").alias("_first"), F.max("_ms").alias("_last"), F.max("_local").alias("_inner"))
    )
    by_time = Window.partitionBy(*keys).orderBy("_slice")
    before = by_time.rowsBetween(Window.unboundedPreceding, -1)
    up_to_here = by_time.rowsBetween(Window.unboundedPreceding, 0)
    edges = edges.withColumn("_prev", F.lag("_last").over(by_time)).withColumn(
        "_step", F.when(F.col("_first") - F.col("_prev") > gap_ms, 1).otherwise(0)
    )
    offset = F.sum("_step").over(up_to_here) + F.coalesce(F.sum("_inner").over(before), F.lit(0))
    edges = edges.select(*where, "_prev", offset.alias("_offset"))

    joined = windowed(cut).join(edges, where, "left")
    return joined.select(
        *df.columns,
        F.when(F.col("_known"), F.coalesce(F.col("_gap"), F.col("_ms") - F.col("_prev"))).alias("diff_ms"),
        F.when(F.col("_known"), F.col("_local") + F.col("_offset")).cast("bigint").alias("session_id"),
    )


def with_gap_ms(df: DataFrame, key: str | list[str], ts: str, slice_ms: int = SLICE_MS) -> DataFrame:
    """Add `diff_ms` only."""
    return sessionize(df, key, ts, slice_ms=slice_ms).drop("session_id")


def session_summary(sessions: DataFrame, key: str, ts: str, measure: str) -> DataFrame:
    """One row per session: id, key, first and last instant, length in ms, total of `measure`, row count.

    The totals are built in the map tasks first, so even a session that never ends stays cheap.
    """
    return (
        sessions.where(F.col("session_id").isNotNull())
        .groupBy(key, "session_id")
        .agg(
            F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.sum(measure).alias("total_bytes_l"),
            F.count(F.lit(1)).alias("total_requests_l"),
        )
        .select(
            make_id([key, "session_id"], "||").alias("id"),
            key,
            "session_start",
            "session_end",
            (epoch_ms("session_end") - epoch_ms("session_start")).alias("session_len_ms_l"),
            "total_bytes_l",
            "total_requests_l",
        )
    )
