"""The batch sink, the token index and the join by distance."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.text import tokens
from tidemark.operators import joins, token_index
from tidemark.plans import bindings as b
from tidemark.scratch import fresh_path
from tidemark.sources import sink


def lines(path):
    """(file, row) of everything a reader sees."""
    from pathlib import Path

    found = [p for p in Path(path).rglob("*.json") if not any(part.startswith("_") for part in p.relative_to(path).parts)]
    return [(p.name, json.loads(line)) for p in found for line in p.read_text().splitlines()]


def test_sink_hands_over_batches(spark):
    path = fresh_path(spark, "sink")
    df = spark.range(0, 25, 1, 2).select("id", F.array("id").alias("l"), F.struct(F.lit("ü").alias("a"), F.lit(None).cast("int").alias("b")).alias("s"), F.lit("2024-01-02").cast("date").alias("d"))
    sink.write_in_batches(df, path, 5)
    got = lines(path)
    sizes = [sum(name == n for n, _ in got) for name in {n for n, _ in got}]
    assert sorted(sizes) == [2, 3, 5, 5, 5, 5] and {r["id"] for _, r in got} == set(range(25))
    assert next(r for _, r in got if r["id"] == 3) == {"id": 3, "l": [3], "s": {"a": "ü"}, "d": "2024-01-02"}
    sink.write_in_batches(spark.range(3).select("id"), path, 5)
    assert len(lines(path)) == 28
    sink.write_in_batches(spark.range(2).select("id"), path, 5, mode="overwrite")
    assert sorted(r["id"] for _, r in lines(path)) == [0, 1]
    assert spark.read.schema("id long").json(path, recursiveFileLookup=True).count() == 2
    sink.write_in_batches(spark.range(0).select("id"), path, 5)
    assert len(lines(path)) == 2
    with pytest.raises(Exception, match="batch must be"):
        sink.write_in_batches(spark.range(2).select("id"), path, 0)


def test_a_failing_task_leaves_nothing_visible(spark):
    path = fresh_path(spark, "sink")
    sink.write_in_batches(spark.range(4).select("id"), path, 1)
    late = F.when(F.col("id") == 999, F.raise_error(F.lit("broken row"))).otherwise(F.col("id")).cast("long").alias("id")
    with pytest.raises(Exception, match="broken row"):
        sink.write_in_batches(spark.range(0, 1000, 1, 4).select(late), path, 10)
    assert len(lines(path)) == 4
    sink.write_in_batches(spark.range(4, 6).select("id"), path, 10)
    assert sorted(r["id"] for _, r in lines(path)) == list(range(6))


def test_token_index(spark):
    name, path = "test_tokens", fresh_path(spark, "index")
    schema = "id long, text string"
    first = [(1, "Red fox, red dog"), (2, "a red cat"), (3, None), (4, "dog"), (None, "red"), (5, "")]
    token_index.index_tokens(spark.createDataFrame(first, schema), name, path, load=0, buckets=8)
    ids = lambda *a, **k: sorted(r.id for r in token_index.match_ids(spark, name, *a, **k).collect())
    assert ids(["red"]) == [1, 2] and ids(["red", "dog"]) == [1] and ids(["cat", "dog"], every=False) == [1, 2, 4] and ids(["none"]) == []
    # 1 loses its words, 2 keeps one, 3 gets some, 6 is new
    second = [(1, None), (2, "red"), (3, "dog red"), (6, "dog")]
    token_index.index_tokens(spark.createDataFrame(second, schema), name, path, load=1, buckets=8)
    assert ids(["red"]) == [2, 3] and ids(["dog"]) == [3, 4, 6] and ids(["cat"]) == [] and ids(["red", "dog", "dog"]) == [3]
    docs = spark.createDataFrame([(3, "x"), (4, "y"), (9, "z")], schema)
    assert {r.text for r in token_index.matches(token_index.match_ids(spark, name, ["dog"]), docs).collect()} == {"x", "y"}
    plan = token_index.match_ids(spark, name, ["dog"])._jdf.queryExecution().toString()
    assert "SelectedBucketsCount: 1 out of 8" in plan and "PushedFilters: [In(token, [dog])" in plan or "EqualTo(token,dog)" in plan
    token_index.drop_index(spark, name)


def test_index_finds_what_a_scan_finds(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    name = "test_tokens_documents"
    token_index.index_tokens(docs, name, fresh_path(spark, "index"), buckets=4)
    for word in ("the", "und", "ion"):
        want = {r.id for r in docs.where(F.array_contains(tokens("text"), word)).collect()}
        assert {r.id for r in token_index.match_ids(spark, name, [word]).collect()} == want
    token_index.drop_index(spark, name)


def km_between(a, b):
    (p, q), (r, s) = ([math.radians(x) for x in y] for y in (a, b))
    h = math.sin((p - r) / 2) ** 2 + math.cos(p) * math.cos(r) * math.sin((q - s) / 2) ** 2
    return 2 * 6371.0088 * math.asin(min(1.0, math.sqrt(h)))


@pytest.mark.parametrize("km", [3.0, 400.0, 9_000.0, 30_000.0])
def test_join_near_is_all_near_pairs(spark, km):
    rng = random.Random(10)
    spots = [(90.0, 0.0), (-90.0, 7.0), (0.0, 180.0), (0.0, -180.0), (89.99, 10.0), (89.99, -170.0), (44.96, -93.26), (44.96, -93.26), (10.0, 179.99), (10.0, -179.99)]
    points = spots + [(math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for _ in range(150)] + [(44.96 + rng.uniform(-0.05, 0.05), -93.26) for _ in range(40)]
    centres = spots + points[10:40]
    p = spark.createDataFrame([(i, *x) for i, x in enumerate(points)] + [(900, None, 1.0)], "i int, latitude double, longitude double")
    c = spark.createDataFrame([(i, *x) for i, x in enumerate(centres)] + [(900, 1.0, None)], "c int, centre_latitude double, centre_longitude double")
    near = joins.join_near(p, c, km)
    got = sorted((r.i, r.c) for r in near.select("i", "c").collect())
    assert got == sorted((i, j) for i, x in enumerate(points) for j, y in enumerate(centres) if km_between(x, y) <= km)
    plan = near._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_token_index_splits_large_buckets(spark):
    """A bucket larger than a task should hold is written by several, and a match reads all its files."""
    setting, name = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "token_index_split"
    docs = spark.range(0, 20_000, 1, 8).selectExpr("id", "concat('the ', md5(string(id))) AS text")
    was = spark.conf.get(setting)
    spark.conf.set(setting, "64k")
    try:
        token_index.index_tokens(docs, name, fresh_path(spark, "index"), buckets=2)
    finally:
        spark.conf.set(setting, was)
    assert len(spark.table(name).inputFiles()) > 2
    assert token_index.match_ids(spark, name, ["the"]).count() == 20_000
    token_index.drop_index(spark, name)


def test_texts_are_dealt_by_size(spark, sf_dir):
    """A task's share of the documents does not grow with the table."""
    setting = "spark.sql.files.maxPartitionBytes"
    was = spark.conf.get(setting)
    spark.conf.set(setting, "4k")
    try:
        scans = b.documents(spark, sf_dir)._jdf.queryExecution().toRdd().getNumPartitions()
        dealt = b.texts(spark, sf_dir)._jdf.queryExecution().optimizedPlan().numPartitions()
    finally:
        spark.conf.set(setting, was)
    assert dealt == 4 * scans > spark.sparkContext.defaultParallelism
