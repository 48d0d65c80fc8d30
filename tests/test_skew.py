"""One key with a large share of the rows: results stay whole and the work stays spread."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import facets, joins, signals
from tidemark.operators.mapping import Stage, run_stages
from tidemark.sources import writers


@pytest.fixture(scope="module")
def fact(spark):
    """60,000 rows, two thirds of them with key 0."""
    key = F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id") % 997)
    return spark.range(60_000).select(key.cast("int").alias("k"), F.col("id").alias("v"))


def metric_of(df, needle):
    """Lines of the plan that was run, after adaptive changes."""
    df.collect()
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if needle in line]


def test_skewed_join_is_split(spark, fact):
    dim = spark.range(997).select(F.col("id").cast("int").alias("k"), F.repeat(F.lit("x"), 40).alias("name"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = joins.join_inner(fact.repartition(8), dim, "k")
        assert metric_of(joined, "skew=true")
        assert joined.count() == 60_000
        hashed = joins.hash_join(fact.repartition(8), dim, "k", "hash")
        assert hashed.count() == 60_000
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_latest_row_of_a_hot_key_ships_few_rows(spark, fact):
    out = writers.latest_per_key(fact.repartition(8), "k", ["v"])
    assert out.count() == fact.select("k").distinct().count()
    assert out.where("k = 0").first()["v"] == 59_999
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_facets_are_counted_before_the_shuffle(fact):
    out = facets.facet(fact, "k", [F.count(F.lit(1)).alias("n")], [F.col("n").desc(), F.col("k")], 1)
    assert tuple(out.first()) == (0, 40_021)


def test_time_partition_of_a_hot_day_is_split(spark):
    """Nearly all rows on one day: the rebalance hint must not put them in one file writer."""
    from tidemark.scratch import fresh_path

    day = F.when(F.col("id") % 50 == 0, F.col("id") % 7).otherwise(F.lit(3))
    events = spark.range(200_000).select(
        F.timestamp_seconds(day * 86_400 + 1_000_000_000).alias("ts"), F.sha2(F.col("id").cast("string"), 256).alias("payload")
    )
    path = fresh_path(spark, "hot-day")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        writers.write_time_partitions(events.repartition(8), path, "ts")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = spark.read.parquet(path).groupBy("dt", F.col("_metadata.file_path").alias("f")).count()
    per_day = {r.dt: r.n for r in files.groupBy("dt").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert spark.read.parquet(path).count() == 200_000
    assert max(per_day.values()) >= 3


def test_grades_of_a_hot_query(spark):
    weights = spark.range(20_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("q"), (F.col("id") % 100).cast("string"))).alias("query"),
        F.col("id").cast("string").alias("doc_id"), (F.col("id") % 50 + 1).alias("weight"),
    )
    graded = signals.ground_truth(weights, 1, 5)
    assert graded.count() == 20_000
    assert graded.where("grade < 1 OR grade > 5").isEmpty()
    top = signals.boosts(weights, 3)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert [r.doc_id for r in top.where("query = 'hot'").orderBy("rank").collect()] == ["10049", "10099", "10199"]


def test_stages(spark):
    stages = [
        Stage("double", lambda df: df.withColumn("id", F.col("id") * 2)),
        Stage("off", lambda df: df.limit(0), skip=True),
        Stage("keep", lambda df: df.where("id > 3")),
    ]
    assert [r.id for r in run_stages(spark.range(4), stages).collect()] == [4, 6]
