from pyspark.sql import functions as F

from tidemark.operators.mapping import Rule
from tidemark.operators import models
from tidemark.scratch import fresh_path
from tidemark.streaming import flows

START = 1_000_000_000  # a stream's first watermark is the epoch, so nothing may lie before it


def test_restart_goes_on_without_repeats(spark):
    src, out, mark = (fresh_path(spark, n) for n in ("src", "out", "mark"))
    schema = "id bigint, ts timestamp"

    def rows(a, b):
        return spark.range(a, b).select("id", F.timestamp_seconds(F.col("id") * 3600 + START).alias("ts"))

    for a, b in [(0, 30), (30, 50)]:
        rows(a, b).coalesce(1).write.mode("append").parquet(src)
        stream = flows.ingest_time_partitions(flows.read_stream(spark, src, schema), "ts", ["id"], watermark="2 hours")
        flows.start_write(stream, out, mark, "dt").awaitTermination()
    got = spark.read.schema("id string, ts timestamp, dt string").parquet(out)
    assert got.count() == 50 and got.select("id").distinct().count() == 50
    assert got.where("dt <> date_format(ts, 'yyyy-MM-dd')").isEmpty()


def test_repeats_within_the_watermark_go(spark):
    src, out, mark = (fresh_path(spark, n) for n in ("src", "out", "mark"))
    one = spark.range(20).select("id", F.timestamp_seconds(F.col("id") + START).alias("ts"))
    one.unionByName(one).repartition(3).write.parquet(src)
    stream = flows.ingest_time_partitions(flows.read_stream(spark, src, "id bigint, ts timestamp"), "ts", ["id"], "hour")
    flows.start_write(stream, out, mark, "dt").awaitTermination()
    assert spark.read.parquet(out).count() == 20


def test_sessions_close_behind_the_watermark(spark):
    src, out, mark = (fresh_path(spark, n) for n in ("src", "out", "mark"))
    rows = [("a", 0, 1), ("a", 30, 2), ("a", 61, 4), ("b", 10, 8), ("z", 1000, 16)]
    df = spark.createDataFrame(rows, "k string, s int, n int").select("k", F.timestamp_seconds(F.col("s") + START).alias("ts"), "n")
    df.coalesce(1).write.parquet(src)
    stream = flows.stream_sessions(flows.read_stream(spark, src, df.schema), "k", "ts", "n", "30 seconds", "10 seconds")
    flows.start_write(stream, out, mark).awaitTermination()
    got = sorted((r.k, r.total_bytes_l, r.total_requests_l, (r.session_end - r.session_start).seconds) for r in spark.read.parquet(out).collect())
    assert got == [("a", 3, 2, 30), ("a", 4, 1, 0), ("b", 8, 1, 0)]  # z is still open


def test_scores_on_arrival(spark):
    train = spark.createDataFrame([("good day", 1.0), ("fine good", 1.0), ("bad day", 0.0), ("awful bad", 0.0)], "body_t string, label double")
    model = models.text_classifier("linear_svm", ["body_t"], num_features=100).fit(train)
    src, out, mark = (fresh_path(spark, n) for n in ("src", "out", "mark"))
    docs = spark.createDataFrame([(1, "a good one"), (2, "bad one"), (3, None)], "id int, text string")
    docs.write.parquet(src)
    stream = flows.score_stream(
        flows.read_stream(spark, src, docs.schema), [Rule("text", "body_t", "move")], model, ["body_t"], "prediction", "sentiment_d"
    )
    flows.start_write(stream, out, mark).awaitTermination()
    assert {r.id: r.sentiment_d for r in spark.read.parquet(out).collect()} == {1: 1.0, 2: 0.0, 3: None}


def test_a_table_that_is_a_folder_arrives_whole(spark):
    from tidemark.plans.streams import _stream

    root = fresh_path(spark, "tables")
    spark.range(50).repartition(3).write.parquet(f"{root}/events.parquet")
    spark.range(9).write.parquet(f"{root}/orders.parquet")
    out = fresh_path(spark, "out")
    flows.start_write(_stream(spark, root, "events"), out, fresh_path(spark, "mark")).awaitTermination()
    assert sorted(r.id for r in spark.read.schema("id bigint").parquet(out).collect()) == list(range(50))
