"""Sharding by fixed virtual slots and a versioned map from slots to shards.

A record belongs to one of some thousand slots for good: the slot is a hash of its key. Which shard holds a slot is said by a small
table of (version, slot, shard), one row per slot and version. Rebalancing adds up the bytes of every slot and edits the map: each
shard keeps its largest slots while they fit its fair share, and only the slots beyond it move, the largest first, each to the
shard that is lightest by then. Records never change their slot, so a new version names exactly the slots that have to be copied.

Everything is SQL on frames. The map has `slots` rows whatever the input, which bounds the broadcast and the one fold over it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.scratch import fresh_path, materialize

SLOTS = 4096


def slot_of(*key: Column | str, slots: int = SLOTS) -> Column:
    """The slot of a record. Nulls in the key hash like any value, so such records have a slot too."""
    return F.pmod(F.xxhash64(*key), F.lit(slots)).cast("int")


def slot_loads(records: DataFrame, slot: str, size: str) -> DataFrame:
    """Bytes and rows of each slot that has records."""
    return records.groupBy(F.col(slot).alias("virtual_slot")).agg(F.sum(size).alias("bytes"), F.count("*").alias("rows"))


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 0: equal spans of slots."""
    if not 0 < shards <= slots:
        raise ValueError("there must be between one shard and as many as slots")
    return spark.range(slots).select(
        F.lit(0).alias("version"), F.col("id").cast("int").alias("virtual_slot"),
        F.expr(f"CAST(id * {shards} DIV {slots} AS INT)").alias("shard"),
    )


def rebalance(slot_map: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """The next version of the map for these loads and this number of shards, which may be more or fewer than before.

    A shard keeps its slots, the largest first, while their bytes stay within total / shards; slots of shards that are gone move in
    any case. Ties go by slot and shard number, so the same loads always give the same map. An empty table keeps the map.
    """
    held = slot_map.join(F.broadcast(loads), "virtual_slot", "left").select(
        "version", "virtual_slot", "shard", F.coalesce("bytes", F.lit(0)).alias("bytes")
    )
    total = held.agg(F.sum("bytes")).scalar()
    order = Window.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot")
    marked = held.select(
        "version", "virtual_slot", "shard", "bytes",
        ((F.col("shard") < shards) & (F.sum("bytes").over(order) * shards <= total)).alias("keeps"),
    )
    gathered = marked.agg(
        F.max("version").alias("version"),
        F.collect_list(F.struct("virtual_slot", "shard", "bytes", "keeps")).alias("all"),
    ).selectExpr(
        "version", "all",
        f"transform(sequence(0, {shards - 1}), s -> aggregate(all, 0L, (t, x) -> t + IF(x.keeps AND x.shard = s, x.bytes, 0L))) AS loads",
        "sort_array(transform(filter(all, x -> NOT x.keeps), x -> struct(-x.bytes AS less, x.virtual_slot AS virtual_slot))) AS moving",
    )
    dealt = gathered.selectExpr(
        "version", "all",
        """aggregate(moving, struct(loads AS loads, array(CAST(NULL AS STRUCT<virtual_slot INT, shard INT>)) AS moved), (t, x) ->
          transform(array(CAST(array_position(t.loads, array_min(t.loads)) - 1 AS INT)), s -> struct(
            transform(t.loads, (b, i) -> IF(i = s, b - x.less, b)) AS loads,
            array_append(t.moved, struct(x.virtual_slot AS virtual_slot, s AS shard)) AS moved))[0]).moved AS moved""",
    )
    return dealt.selectExpr(
        "version + 1 AS version",
        "inline(concat(transform(filter(all, x -> x.keeps), x -> struct(x.virtual_slot, x.shard)), filter(moved, x -> x IS NOT NULL)))",
    )


def save_map(slot_map: DataFrame, path: str) -> None:
    """Add versions to the stored map; a version that is there already is replaced as a whole."""
    (slot_map.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(path))


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the stored map, the latest if none is named."""
    stored = spark.read.schema("virtual_slot int, shard int, version int").parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.where(F.col("version") == version).select("version", "virtual_slot", "shard")


def place(records: DataFrame, slot_map: DataFrame, loads: DataFrame, order: list[str]) -> DataFrame:
    """Add shard, map_version and slot, the record's gapless place in its shard, to records with a column virtual_slot.

    Places run on from slot to slot: a slot's records are numbered among themselves, and the rows of the slots before it in the same
    shard are added, so no task sees more than one slot.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.join(F.broadcast(loads), "virtual_slot").select(
        "virtual_slot", "shard", F.col("version").alias("map_version"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")
    )
    own = Window.partitionBy("virtual_slot").orderBy(*order)
    return (
        records.withColumn("place", F.row_number().over(own).cast("long"))
        .join(F.broadcast(starts), "virtual_slot")  # at most one row per slot
        .withColumn("slot", F.col("start") + F.col("place") - 1)
        .drop("start", "place")
    )


def shard_documents(documents: DataFrame, shards: int, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """Shard documents by bytes: doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, map_version.

    Size is the text's UTF-8 bytes plus 8; a null text counts as empty. The key is the doc_id with the text's checksum, so that rows that
    share an id spread; repeated rows share a slot and get places of their own. Other columns of `documents` are not read. The law is
    `bytes`: sizes of shards are equal up to one small slot, unless a single slot outweighs a shard. `map_path` is where the versions of
    the map are kept, by default a new folder in the shared folder: version 0 and the rebalanced version 1, or one version more than it holds.
    A folder that is not there yet is made; a stored map with another number of slots is refused.
    """
    spark = documents.sparkSession
    records = materialize(
        documents.select(
            F.col("`doc_id`").alias("doc_id"),
            (F.coalesce(F.octet_length("`text`"), F.lit(0)).cast("long") + 8).alias("size"),
            F.crc32(F.coalesce(F.col("`text`"), F.lit("")).cast("binary")).alias("text_crc32"),
        ).withColumn("virtual_slot", slot_of("doc_id", "text_crc32", slots=slots)),
        "sharded",
    )
    loads = materialize(slot_loads(records, "virtual_slot", "size"), "slot-loads")
    map_path = map_path or fresh_path(spark, "slot-map")
    at = spark._jvm.org.apache.hadoop.fs.Path(map_path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        save_map(first_map(spark, shards, slots), map_path)
    held = load_map(spark, map_path).agg(F.count("*"), F.max("virtual_slot")).head()
    if tuple(held) != (slots, slots - 1):
        raise ValueError(f"the stored map has {held[0]} slots, not {slots}")
    save_map(rebalance(load_map(spark, map_path), loads, shards), map_path)
    return place(records, load_map(spark, map_path), loads, ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version",
    )
