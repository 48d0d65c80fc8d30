"""Stored tables that grow batch by batch: keyed upsert, open sessions, click sums.

A stored table is a folder of parts. A batch reads and rewrites only the parts that its rows belong to, under the batch's own name, and is
then made visible by one small file, its manifest, which says where each part lies. So readers see all of a batch or nothing, a batch
that died half way is simply run again, and a batch that is already in changes nothing. One writer at a time.

    path/batch=<n>/_part=<p>/...   rewritten parts
    path/emitted/batch=<n>/...     rows that left the state for good, such as closed sessions
    path/_manifests/<n>.json       {"batch", "parts": {part: batch}, "notes": {...}}
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.functions.scalars import epoch_ms
from tidemark.functions.types import as_list
from tidemark.operators.sessions import sessionize
from tidemark.sources.writers import upsert

Merge = Callable[[DataFrame | None, DataFrame], DataFrame]


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def manifest(spark: SparkSession, path: str) -> dict | None:
    """What the last visible batch says, None for a table without any."""
    files, at = _files(spark, f"{path}/_manifests")
    if not files.exists(at):
        return None
    names = [s.getPath().getName() for s in files.listStatus(at)]
    done = [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]
    if not done:
        return None
    stream = files.open(_files(spark, f"{path}/_manifests/{max(done)}.json")[1])
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _publish(spark: SparkSession, path: str, said: dict) -> None:
    """Write beside, then rename, so that a manifest is there whole or not at all."""
    name = f"{path}/_manifests/{said['batch']}.json"
    files, part = _files(spark, name + ".part")
    out = files.create(part, True)
    out.write(bytearray(json.dumps(said, sort_keys=True).encode()))
    out.close()
    if not files.rename(part, _files(spark, name)[1]):
        raise OSError(f"{name} cannot be written")


def _read_parts(spark: SparkSession, path: str, said: dict, schema: StructType, only: set[str] | None = None) -> DataFrame | None:
    """Rows of the visible parts (those of `only`), None where there are none."""
    folders = [f"{path}/batch={batch}/_part={part}" for part, batch in said["parts"].items() if only is None or part in only]
    return spark.read.schema(schema).parquet(*folders) if folders else None


def merge_batch(
    path: str, batch: int, changes: DataFrame, part: Column, merge: Merge, schema: StructType | str, notes: dict | None = None,
    emit: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None, all_parts: bool = False,
) -> bool:
    """Merge one batch into the stored table; False, and no effect, if that batch or a later one is already in.

    `part` names, from columns that both changes and stored rows have, the part a row belongs to. `merge` gets the stored rows of the touched
    parts (None if there are none) and the changes, and returns what these parts hold afterwards. `emit` splits that into what stays and what
    leaves the state; the latter is kept as emitted rows. `all_parts` takes every stored part as touched, for state that closes by time.
    """
    spark = changes.sparkSession
    said = manifest(spark, path) or {"batch": None, "parts": {}, "notes": {}}
    if said["batch"] is not None and batch <= said["batch"]:
        return False
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    named = F.coalesce(part.cast("string"), F.lit("none")).alias("_part")
    touched = {r["_part"] for r in changes.select(named).distinct().collect()}  # names of parts, of which a table has a bounded number
    if all_parts:
        touched |= set(said["parts"])
    merged = merge(_read_parts(spark, path, said, kind, touched), changes)
    if emit:
        merged, gone = emit(merged)
        gone.write.mode("overwrite").parquet(f"{path}/emitted/batch={batch}")
    rows = merged.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in kind.fields), named)
    # rows of a part come together, a large part is split over several tasks
    rows.hint("rebalance", F.col("_part")).write.mode("overwrite").partitionBy("_part").parquet(f"{path}/batch={batch}")
    files, at = _files(spark, f"{path}/batch={batch}")
    written = [s.getPath().getName() for s in files.listStatus(at) if s.isDirectory()]
    parts = {p: b for p, b in said["parts"].items() if p not in touched}
    parts |= {name.removeprefix("_part="): batch for name in written if name.startswith("_part=")}
    _publish(spark, path, {"batch": batch, "parts": parts, "notes": {**said["notes"], **(notes or {})}})
    return True


def read_stored(spark: SparkSession, path: str, schema: StructType | str, parts: set[str] | None = None) -> DataFrame:
    """The visible rows, of the named parts only if these are given."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    said = manifest(spark, path)
    rows = _read_parts(spark, path, said, kind, parts) if said else None
    return spark.createDataFrame([], kind) if rows is None else rows


def read_emitted(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows that left the state with a visible batch."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    said = manifest(spark, path)
    files, at = _files(spark, f"{path}/emitted")
    if said is None or not files.exists(at):
        return spark.createDataFrame([], kind)
    rows = spark.read.schema(StructType(list(kind.fields)).add("batch", "long")).parquet(f"{path}/emitted")
    return rows.where(F.col("batch") <= said["batch"]).drop("batch")


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete rewritten parts and manifests that no visible part refers to; returns the number of folders and files. Not while someone reads."""
    said, gone = manifest(spark, path), 0
    if said is None:
        return 0
    files, at = _files(spark, path)
    for status in files.listStatus(at):
        name = status.getPath().getName()
        if name.startswith("batch="):
            batch = int(name.removeprefix("batch="))
            for inner in files.listStatus(status.getPath()):
                part = inner.getPath().getName().removeprefix("_part=")
                if inner.isDirectory() and said["parts"].get(part) != batch:
                    gone += bool(files.delete(inner.getPath(), True))
    for status in files.listStatus(_files(spark, f"{path}/_manifests")[1]):
        if status.getPath().getName() != f"{said['batch']}.json":
            gone += bool(files.delete(status.getPath(), True))
    return gone


def _hashed(key: list[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(parts))


def upsert_batch(path: str, batch: int, changes: DataFrame, key: str | list[str], order: list[str], parts: int = 64) -> bool:
    """Apply one batch of changes: one row per key stays, the last by `order`, on a tie the later batch's. `parts` is how many folders the keys are
    hashed into; choose it by the size the table will have, and the same for all batches."""
    keys = as_list(key)

    def merge(stored: DataFrame | None, new: DataFrame) -> DataFrame:
        return upsert(new.limit(0) if stored is None else stored, new, keys, order)

    return merge_batch(path, batch, changes, _hashed(keys, parts), merge, changes.schema)


def upsert_stream(stream: DataFrame, path: str, checkpoint: str, key: str | list[str], order: list[str], parts: int = 64) -> StreamingQuery:
    """Keep a stored keyed table up to date from a stream, until the input present at the start is used up.

    Each micro-batch is one batch of the table. A micro-batch that is run again, after a failure between its commit and the
    stream's own, finds its number taken and does nothing. The table belongs to one checkpoint folder.
    """
    return (
        stream.writeStream.foreachBatch(lambda df, batch: upsert_batch(path, batch, df, key, order, parts))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _utc(us: int) -> datetime:
    return datetime.fromtimestamp(us // 1_000_000, timezone.utc).replace(microsecond=us % 1_000_000, tzinfo=None)


def session_schema(rows: DataFrame, key: str, ts: str, measure: str) -> StructType:
    """Columns of open and closed sessions for rows of that kind."""
    total = rows.select(F.sum(measure).alias("total"))
    kind = rows.select(F.col(key), F.col(ts).alias("session_start"), F.col(ts).alias("session_end")).schema
    return StructType(kind.fields + total.schema.fields).add("count", "long")


def sessions_batch(path: str, batch: int, rows: DataFrame, key: str, ts: str, measure: str, gap_ms: int, delay_ms: int, parts: int = 64) -> bool:
    """Carry sessions on by one batch of rows; no row of earlier batches is read again.

    The table holds the open sessions of each key; closed ones are its emitted rows. Rows of one key at most `gap_ms` apart
    share a session. The watermark is the latest instant of all batches before this one less `delay_ms`: rows before it are late and dropped,
    others may lengthen open sessions or join two of them. A session is closed once the watermark after the batch is more than `gap_ms` past its
    end, so no row that is still taken could reach it. Open and closed sessions together are what sessionizing all rows that were taken at once gives.

    Rows without a key or an instant belong to no session. Rows are made into sessions within the batch first (see `sessionize`), so a key with
    most of them meets its open sessions as few rows. With an empty batch the watermark stays.
    """
    spark = rows.sparkSession
    said = manifest(spark, path)
    if said is not None and said["batch"] is not None and batch <= said["batch"]:
        return False
    before = (said or {"notes": {}})["notes"].get("latest_us")
    taken = rows.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    if before is not None:
        taken = taken.where(F.col(ts) >= F.lit(_utc(before - delay_ms * 1000)).cast(rows.schema[ts].dataType))
    seen = rows.select(F.unix_micros(F.max(F.col(ts)).cast("timestamp"))).head()[0]
    latest = max((x for x in (before, seen) if x is not None), default=None)
    kind = session_schema(rows, key, ts, measure)
    new = (
        sessionize(taken.select(key, ts, measure), key, ts, gap_ms).groupBy(key, "session_id")
        .agg(F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.sum(measure).alias("total"), F.count(F.lit(1)).alias("count"))
        .drop("session_id")
    )

    def merge(stored: DataFrame | None, fresh: DataFrame) -> DataFrame:
        both = fresh if stored is None else stored.unionByName(fresh)
        by_start = Window.partitionBy(key).orderBy("session_start", "session_end")
        reach = F.max(epoch_ms("session_end")).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
        starts = F.when(epoch_ms("session_start") - reach > gap_ms, 1).otherwise(0)
        marked = both.withColumn("_starts", starts).withColumn("_n", F.sum("_starts").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
        return marked.groupBy(key, "_n").agg(
            F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"), F.sum("total").alias("total"), F.sum("count").alias("count")
        ).drop("_n")

    def emit(merged: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows_of = merged.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in kind.fields))
        done = F.lit(False) if latest is None else epoch_ms("session_end") + gap_ms < (latest - delay_ms * 1000) // 1000
        return rows_of.where(~done), rows_of.where(done)

    return merge_batch(path, batch, new, _hashed([key], parts), merge, kind, {"latest_us": latest}, emit, all_parts=True)


def sessions_stream(stream: DataFrame, path: str, checkpoint: str, key: str, ts: str, measure: str, gap_ms: int, delay_ms: int, parts: int = 64) -> StreamingQuery:
    """`sessions_batch` for every micro-batch of a stream, until the input present at the start is used up."""
    return (
        stream.writeStream.foreachBatch(lambda df, batch: sessions_batch(path, batch, df, key, ts, measure, gap_ms, delay_ms, parts))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


_CLICKS = "query string, doc_id string, dt date, weight double"


def add_clicks(path: str, batch: int, clicks: DataFrame, ts: str = "ts", weight: str | None = None) -> bool:
    """Add a load of clicks (query, doc_id, ts) to the stored sums per day, query and document.

    Only rows after the high-water mark are added, the latest instant of all loads before, so a load may hold rows of earlier ones again (then it
    must hold all rows of its last instant that there will be). Sums are made in the map tasks first, and only days with new rows are read
    and rewritten. Rows without an instant are left out; without `weight` each row counts as 1.
    """
    spark = clicks.sparkSession
    said = manifest(spark, path)
    mark = (said or {"notes": {}})["notes"].get("mark_us")
    new = clicks.where(F.col(ts).isNotNull())
    if mark is not None:
        new = new.where(F.col(ts) > F.lit(_utc(mark)).cast(clicks.schema[ts].dataType))
    latest = new.select(F.unix_micros(F.max(F.col(ts)).cast("timestamp"))).head()[0]
    worth = F.col(weight).cast("double") if weight else F.lit(1.0)

    def total(rows: DataFrame) -> DataFrame:
        return rows.groupBy("query", "doc_id", "dt").agg(F.sum("weight").alias("weight"))

    def merge(stored: DataFrame | None, fresh: DataFrame) -> DataFrame:
        return fresh if stored is None else total(stored.unionByName(fresh))

    daily = total(new.select("query", F.col("doc_id").cast("string").alias("doc_id"), F.col(ts).cast("date").alias("dt"), worth.alias("weight")))
    return merge_batch(path, batch, daily, F.col("dt"), merge, _CLICKS, {"mark_us": mark if latest is None else latest})


def stored_click_weights(spark: SparkSession, path: str, half_life_days: float | None = None, at: str | None = None) -> DataFrame:
    """(query, doc_id, weight) from the stored sums.

    With a half life, a click counts 0.5 ** (age / half life), its age being whole days before the day `at` (the latest stored day if not given);
    clicks of that day or later count in full. Without one this is the plain sum of `click_weights`. The
    definition is ours: the sums per day are exact, whatever decay is asked for later.
    """
    days = read_stored(spark, path, _CLICKS)
    worth = F.col("weight")
    if half_life_days is not None:
        last = F.lit(at).cast("date") if at else days.agg(F.max("dt")).scalar()
        age = F.greatest(F.datediff(last, F.col("dt")), F.lit(0))
        worth = worth * F.pow(F.lit(0.5), age / F.lit(float(half_life_days)))
    return days.groupBy("query", "doc_id").agg(F.sum(worth).alias("weight"))


_PROFILE = "part string, column string, n long, nulls long, min double, max double, distinct binary, spread binary"


def add_profile(path: str, batch: int, rows: DataFrame, cols: list[str], part: str) -> bool:
    """Profile a load of rows and merge it into the stored profiles, one row per part (a column such as the day) and column.

    A profile holds counts, bounds and two sketches that can be merged: one of the distinct values (HyperLogLog) and, for numbers, one of
    the quantiles (KLL). Their size is fixed, so a profile of any number of rows is some kilobytes, and only the parts of
    the load are read and rewritten.
    """
    kinds = dict(rows.dtypes)
    numeric = [c for c in cols if kinds[c] in ("tinyint", "smallint", "int", "bigint", "float", "double") or kinds[c].startswith("decimal")]
    entries = []
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        text, number = F.col(c).cast("string"), F.col(c).cast("double")
        aggs += [F.count(c).alias(f"c{i}"), F.hll_sketch_agg(text).alias(f"d{i}")]
        if c in numeric:
            aggs += [F.min(number).alias(f"a{i}"), F.max(number).alias(f"z{i}"), F.kll_sketch_agg_double(number).alias(f"q{i}")]
        bounds = [F.col(f"{x}{i}") if c in numeric else F.lit(None).cast(t) for x, t in (("a", "double"), ("z", "double"), ("q", "binary"))]
        entries.append(F.struct(
            F.lit(c).alias("column"), F.col("n"), (F.col("n") - F.col(f"c{i}")).alias("nulls"), bounds[0].alias("min"), bounds[1].alias("max"),
            F.col(f"d{i}").alias("distinct"), bounds[2].alias("spread"),
        ))
    new = rows.groupBy(F.col(part).cast("string").alias("part")).agg(*aggs).select("part", F.inline(F.array(*entries)))

    def merge(stored: DataFrame | None, fresh: DataFrame) -> DataFrame:
        return fresh if stored is None else _merged(stored.unionByName(fresh), "part", "column")

    return merge_batch(path, batch, new, F.col("part"), merge, _PROFILE)


def _merged(profiles: DataFrame, *by: str) -> DataFrame:
    return profiles.groupBy(*by).agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("spread").alias("spread"),
    )


def stored_profile(spark: SparkSession, path: str, parts: set[str] | None = None, by_part: bool = False) -> DataFrame:
    """(column, n, nulls, min, max, distinct, median) of all loads, or of the named parts, from the stored sketches; no row is read again.

    `by_part` keeps the parts apart. The number of distinct values and the median are estimates.
    """
    by = ["part", "column"] if by_part else ["column"]
    merged = _merged(read_stored(spark, path, _PROFILE, parts), *by)
    median = F.when(F.col("min").isNotNull(), F.kll_sketch_get_quantile_double("spread", F.lit(0.5)))
    return merged.select(*by, "n", "nulls", "min", "max", F.hll_sketch_estimate("distinct").alias("distinct"), median.alias("median"))
