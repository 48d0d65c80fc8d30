import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.scratch import clean_up, fresh_path, materialize, shared_root
from tidemark.functions.scalars import split_list
from tidemark.sources import readers, writers
from tidemark.sources.jobs import LoadSpec, bulk_load


def test_access_log(spark):
    lines = [
        '10.0.0.1 - bob [10/Oct/2000:13:55:36 -0700] "GET /a.gif HTTP/1.0" 200 2326',
        '10.0.0.2 - - [10/Oct/2000:13:55:37 +0000] "POST /b HTTP/1.1" 304 -',
        '10.0.0.3 - - [10/Oct/2000:13:55:38 +0000] "-" 408 0',
        "nonsense",
    ]
    rows = readers.parse_access_log(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert (rows[0].clientip, rows[0].ident, rows[0].auth, rows[0].verb, rows[0].request, rows[0].httpversion, rows[0].response, rows[0].bytes) == (
        "10.0.0.1", "-", "bob", "GET", "/a.gif", "1.0", "200", 2326,
    )
    assert rows[0].ts.isoformat() == "2000-10-10T20:55:36"
    assert rows[1].bytes is None and not rows[1].rejected
    assert rows[2].rawrequest == "-" and rows[2].verb is None and rows[2].bytes == 0
    assert rows[3].rejected and rows[3].clientip is None
    assert [r.rejected for r in rows] == [False, False, False, True]


def test_signals_json(spark):
    text = '{"tv":{"signals":[{"docId":"d1","count":"5"},{"docId":"d2","count":"x"}],"rank":["d1"]},"led tv":{"signals":[],"rank":[]}}'
    df = spark.createDataFrame([(text,)], "j string")
    assert sorted(tuple(r) for r in readers.explode_signals(df, "j").collect()) == [("tv", "d1", 5), ("tv", "d2", None)]


def test_bare_quotes_and_header(spark):
    path = fresh_path(spark, "quotes")
    spark.createDataFrame([('doc5,"A 32" TV, LED","big, ""quoted"" one"',), ("doc6,plain,x",)], "v string").coalesce(1).write.text(path)
    rows = readers.read_delimited(spark, path, ",", "id string, title string, description string").orderBy("id").collect()
    assert rows[0].title == 'A 32" TV, LED' and rows[0].description == 'big, "quoted" one' and rows[1].title == "plain"


def test_corpus_latin1(spark):
    path = fresh_path(spark, "latin")
    spark.createDataFrame([("café",)], "v string").select(F.encode("v", "ISO-8859-1").alias("b")).createOrReplaceTempView("latin_bytes")
    # the text writer stores bytes as they are
    spark.table("latin_bytes").select(F.col("b").cast("string").alias("value")).coalesce(1).write.partitionBy().text(path)
    got = readers.read_corpus(spark, path, "ISO-8859-1", "*.txt").collect()
    assert got[0].content == "café\n" and got[0].path.endswith(".txt")


def test_partition_pruning(spark):
    path = fresh_path(spark, "days")
    events = spark.sql("SELECT explode(sequence(TIMESTAMP'2024-01-01', TIMESTAMP'2024-01-09 23:00:00', INTERVAL 1 HOUR)) AS ts")
    writers.write_time_partitions(events, path, "ts")
    schema = StructType().add("ts", "timestamp").add("dt", "string")
    some = readers.read_time_partitions(spark, path, "ts", schema, "2024-01-03 12:00:00", "2024-01-04 00:00:00")
    assert some.count() == 13
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert len({r.f for r in some.select(F.input_file_name().alias("f")).collect()}) == 2
    assert readers.read_time_partitions(spark, path, "ts", schema).count() == events.count()
    with pytest.raises(ValueError):
        readers.partition_format("week")


def test_retention_keeps_the_newest(spark):
    path = fresh_path(spark, "keep")
    events = spark.sql("SELECT explode(sequence(TIMESTAMP'2024-01-01', TIMESTAMP'2024-01-09 23:00:00', INTERVAL 1 HOUR)) AS ts")
    writers.write_time_partitions(events, path, "ts", max_active=3)
    assert sorted(r.dt for r in spark.read.schema("ts timestamp, dt string").parquet(path).select("dt").distinct().collect()) == ["2024-01-07", "2024-01-08", "2024-01-09"]


def test_ranks(spark):
    text = '{"tv":{"signals":[],"rank":["d1","d2"]},"led":{"rank":[]}}'
    df = spark.createDataFrame([(text,)], "j string")
    assert sorted(tuple(r) for r in readers.explode_ranks(df, "j").collect()) == [("tv", "d1", 1), ("tv", "d2", 2)]


@pytest.mark.parametrize("delete", [True, False])
def test_retention_over_what_is_stored(spark, tmp_path, delete):
    path = str(tmp_path / "days")
    days = lambda low, high: spark.range(low, high).select(F.expr("timestamp_seconds(id * 86400)").alias("ts"), "id")
    writers.write_time_partitions(days(0, 5), path, "ts", max_active=3, mode="append", delete_expired=delete)
    assert writers.stored_partitions(spark, path) == ["1970-01-03", "1970-01-04", "1970-01-05"]
    writers.write_time_partitions(days(1, 7), path, "ts", max_active=3, mode="append", delete_expired=delete)
    newest = ["1970-01-05", "1970-01-06", "1970-01-07"]
    assert writers.stored_partitions(spark, path) == (newest if delete else ["1970-01-03", "1970-01-04", *newest])


def test_upsert_table(spark, tmp_path):
    path, schema = str(tmp_path / "table"), "id long, at int, v string"
    first = spark.range(200).selectExpr("id", "0 AS at", "'old' AS v")
    assert len(writers.upsert_table(path, first, "id", ["at"], parts=8)) == 8
    change = spark.createDataFrame([(3, 1, "new"), (3, 2, "newer"), (900, 0, "added")], schema)
    assert len(writers.upsert_table(path, change, "id", ["at"], parts=8)) <= 2
    assert writers.upsert_table(path, change.where("false"), "id", ["at"], parts=8) == []
    rows = {r["id"]: r["v"] for r in writers.read_upserted(spark, path, schema).collect()}
    assert len(rows) == 201 and rows[3] == "newer" and rows[900] == "added" and rows[4] == "old"


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id int, v string, at int")
    changes = spark.createDataFrame([(2, "c", 2), (3, "d", 1), (1, "old", 0)], "id int, v string, at int")
    once = writers.upsert(target, changes, "id", ["at"])
    assert sorted(tuple(r) for r in once.collect()) == [(1, "a", 1), (2, "c", 2), (3, "d", 1)]
    assert writers.upsert(once, changes, "id", ["at"]).exceptAll(once).isEmpty()
    tie = spark.createDataFrame([(1, "new", 1)], "id int, v string, at int")
    assert ("new",) in [(r.v,) for r in writers.upsert(target, tie, "id", ["at"]).collect()]
    assert "WindowGroupLimit" in once._jdf.queryExecution().executedPlan().toString()


def test_batches_and_partitions(spark):
    path = fresh_path(spark, "batch")
    writers.write_batched(spark.range(2_500).coalesce(1), path, 1_000)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy("_metadata.file_path").count().collect()]
    assert sorted(sizes) == [500, 1000, 1000]
    assert writers.with_output_partitions(spark.range(10), 8).rdd.getNumPartitions() == 8


def test_load_clear_and_append(spark):
    path = fresh_path(spark, "load")
    one, two = spark.range(3), spark.range(5)
    for df, source, clear in [(one, "a", True), (two, "b", True), (two, "a", True), (one, "b", False)]:
        writers.load(df, path, source, clear)
    got = {r.data_source: r["count"] for r in spark.read.parquet(path).groupBy("data_source").count().collect()}
    assert got == {"a": 5, "b": 8}


def test_schema_contract(spark):
    df = spark.createDataFrame([("1", "x", 9), ("y", "2.5", 9)], "a string, b string, extra int")
    out = writers.enforce_schema(df, StructType().add("a", "integer").add("b", "double").add("c", "string")).collect()
    assert [tuple(r) for r in out] == [(1, None, None, 1), (None, 2.5, None, 1)]


def test_bulk_load(spark):
    src, out = fresh_path(spark, "src"), fresh_path(spark, "out")
    spark.createDataFrame([("1", "Heat", "Action|Crime"), ("2", "Big", "Comedy")], "movieId string, title string, genres string").write.option("header", True).csv(src)
    spec = LoadSpec(
        source="movies", format="csv", path=src, read_options={"header": "true"}, output=out, output_partitions=2,
        transform=lambda df: df.withColumn("genre", split_list("genres", "|")), sql="SELECT movieId AS id, title, genre FROM _input",
    )
    for _ in range(2):  # clearing makes the load repeatable
        table = bulk_load(spark, spec)
    assert sorted((r.id, r.genre) for r in table.collect()) == [("1", ["Action", "Crime"]), ("2", ["Comedy"])]
    with pytest.raises(ValueError):
        bulk_load(spark, LoadSpec(source="x", format="csv", path=src))


def test_scratch_follows_the_setting(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    made = materialize(spark.range(5), "t")
    assert made.count() == 5 and shared_root(spark) in made.inputFiles()[0]


def test_bucketed_tables_join_without_a_shuffle(spark):
    a = writers.write_bucketed(spark.range(100).withColumn("x", F.col("id") + 1), "bucketed_a", fresh_path(spark, "a"), "id", 4)
    b = writers.write_bucketed(spark.range(50).withColumn("y", F.col("id") * 2), "bucketed_b", fresh_path(spark, "b"), "id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = a.join(b, "id").groupBy("id").agg(F.sum("y").alias("s"))
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_word_list_with_quotes(spark):
    path = fresh_path(spark, "words")
    spark.createDataFrame([('" NN x O',), ("EU NNP I-NP I-ORG",), ("",)], "v string").coalesce(1).write.text(path)
    rows = readers.read_delimited(spark, path, " ", "w string, p string, c string, t string", quote="").collect()
    assert [(r.w, r.t) for r in rows] == [('"', "O"), ("EU", "I-ORG")]


def test_every_row_has_a_bucket(spark):
    from tidemark.operators.models import hash_split

    df = spark.createDataFrame([("a",), (None,)], "k string")
    one, two = hash_split(df, "k", 50)
    assert one.count() + two.count() == 2


def test_clean_up(spark):
    import os

    df = materialize(spark.range(5), "kept-for-now")
    path = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.exists(path) and clean_up(spark) >= 1 and not os.path.exists(path)
    assert clean_up(spark) == 0


def test_buckets_of_a_join_go_by_what_it_reads(spark):
    """A join's own estimate is the product of its sides, which would ask for more buckets than Spark allows."""
    a, b = (materialize(spark.range(20_000).withColumn("x", F.col("id") + 1), name) for name in "ab")
    joined = a.join(b.withColumnRenamed("x", "y"), "id")
    assert writers.buckets_for(joined) == 1
    assert 1 < writers.buckets_for(joined, 10_000) < 1_000
    assert writers.buckets_for(spark.range(20_000_000), 1) == 100_000


def test_shuffle_files_go_when_the_table_is_written(spark):
    import glob
    import time

    dirs = [str(d) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def files():
        return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*")}

    before = files()
    made = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "sums")
    waited = time.time() + 20
    while files() - before and time.time() < waited:
        time.sleep(0.2)
    assert not files() - before and made.count() == 7
