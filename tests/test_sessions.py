import random
from itertools import groupby

import pytest
from pyspark.sql import Window, functions as F

from tidemark.operators import sessions

SCHEMA = "client string, ms bigint, n int"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.timestamp_millis("ms"))


def by_hand(rows, gap):
    """(client, ms, n) -> (diff, session), straight from the definition."""
    out = {}
    for client, group in groupby(sorted(rows, key=lambda r: (r[0], r[1], r[2])), key=lambda r: r[0]):
        last, session, first_of_tie = None, 0, True
        for _, ms, n in group:
            diff = None if last is None else ms - last
            if diff is not None and diff > gap:
                session += 1
            out[(client, ms, n)] = session
            last = ms
    return out


def test_gaps_by_hand(spark):
    rows = [("a", 0, 1), ("a", 30_000, 2), ("a", 60_001, 3), ("a", 60_001, 4), ("b", 5, 5)]
    got = {(r.client, r.n): (r.diff_ms, r.session_id) for r in sessions.sessionize(frame(spark, rows), "client", "ts").collect()}
    assert got[("a", 1)] == (None, 0)
    assert got[("a", 2)] == (30_000, 0)  # exactly the gap does not break
    assert {got[("a", 3)][1], got[("a", 4)][1]} == {1}  # one millisecond more does; ties share
    assert sorted([got[("a", 3)][0], got[("a", 4)][0]]) == [0, 30_001]
    assert got[("b", 5)] == (None, 0)
    summary = sessions.session_summary(sessions.sessionize(frame(spark, rows), "client", "ts"), "client", "ts", "n").collect()
    assert {(r.id, r.session_len_ms_l, r.total_requests_l, r.total_bytes_l) for r in summary} == {
        ("a||0", 30_000, 2, 3), ("a||1", 0, 2, 7), ("b||0", 0, 1, 5),
    }


@pytest.mark.parametrize("slice_ms", [1_000, 45_000, 3_600_000, 10**12])
def test_slices_do_not_change_the_result(spark, slice_ms):
    rng = random.Random(7)
    rows = []
    for client in "abcde":
        at = -50_000_000
        for n in range(120 if client < "c" else 60):
            at += rng.choice([0, 1, 500, 29_999, 30_000, 30_001, 90_000, 7_200_000])
            rows.append((client, at, n))
    want = by_hand(rows, 30_000)
    got = sessions.sessionize(frame(spark, rows), "client", "ts", 30_000, slice_ms).collect()
    assert len(got) == len(rows)
    assert {(r.client, r.ms, r.n): r.session_id for r in got} == want


def test_equals_the_plain_window(spark, sf_dir):
    logs = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    w = Window.partitionBy("user_id").orderBy("ts")
    plain = logs.withColumn("d", F.unix_millis("ts") - F.lag(F.unix_millis("ts")).over(w)).withColumn(
        "s", F.sum(F.when(F.col("d") > 21_600_000, 1).otherwise(0)).over(w)
    )
    ours = sessions.sessionize(logs, "user_id", "ts", 21_600_000)
    assert ours.select("event_id", "diff_ms", "session_id").exceptAll(plain.select("event_id", "d", "s")).isEmpty()


def test_rows_without_key_or_instant_stay_outside_sessions(spark):
    rows = [(None, 5, 1), ("a", None, 2), ("a", 7, 3)]
    got = {r.n: (r.diff_ms, r.session_id) for r in sessions.sessionize(frame(spark, rows), "client", "ts").collect()}
    assert got == {1: (None, None), 2: (None, None), 3: (None, 0)}
    summary = sessions.session_summary(sessions.sessionize(frame(spark, rows), "client", "ts"), "client", "ts", "n")
    assert [r.id for r in summary.collect()] == ["a||0"]


def test_invariants(spark, sf_dir):
    logs = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    with_ids = sessions.sessionize(logs, "user_id", "ts", 21_600_000)
    total = sessions.session_summary(with_ids, "user_id", "ts", "value")
    assert total.agg(F.sum("total_requests_l")).first()[0] == logs.count()
    assert total.where("session_len_ms_l < 0").isEmpty()
    breaks = with_ids.groupBy("user_id").agg(F.count_if(F.col("diff_ms") > 21_600_000).alias("b"))
    per_user = total.groupBy("user_id").count().join(breaks, "user_id")
    assert per_user.where("count <> b + 1").isEmpty()


def test_hot_key_is_spread(spark):
    """A client with nine tenths of the rows must not end up in one task."""
    hot = spark.range(45_000).select(F.lit("hot").alias("client"), (F.col("id") * 1_000).alias("ms"), F.col("id").cast("int").alias("n"))
    cold = spark.range(5_000).select(
        F.concat(F.lit("c"), (F.col("id") % 50).cast("string")).alias("client"), (F.col("id") * 9_000).alias("ms"), F.col("id").cast("int").alias("n")
    )
    logs = hot.unionByName(cold).withColumn("ts", F.timestamp_millis("ms"))
    out = sessions.sessionize(logs, "client", "ts").withColumn("task", F.spark_partition_id())
    per_task = [r["count"] for r in out.groupBy("task").count().collect()]
    assert sum(per_task) == 50_000
    assert max(per_task) < 25_000
    plain = sessions.sessionize(logs, "client", "ts", slice_ms=10**12).exceptAll(out.drop("task"))
    assert plain.isEmpty()


def test_null_keys_stay_whole(spark):
    rows = [(None if n % 3 else "a", n * 1_000, n) for n in range(300)]
    out = sessions.sessionize(frame(spark, rows), "client", "ts", slice_ms=20_000)
    assert out.count() == 300 and out.where("session_id IS NULL").count() == 200
    assert out.where("client = 'a'").agg(F.max("session_id")).first()[0] == 0


def test_two_key_columns(spark):
    rows = [("a", 0, 1), ("a", 40_000, 1), ("a", 0, 2), ("a", 10, 2)]
    out = sessions.sessionize(frame(spark, rows), ["client", "n"], "ts", slice_ms=1_000)
    assert sorted((r.n, r.ms, r.session_id) for r in out.collect()) == [(1, 0, 0), (1, 40_000, 1), (2, 0, 0), (2, 10, 0)]


def test_many_large_keys_and_a_burst(spark):
    """More large keys than any list of them would hold, and one key with a burst inside one slice, on one path with two scans."""
    many = spark.range(120_000).select((F.col("id") % 12_000).cast("string").alias("client"), (F.floor(F.col("id") / 12_000) * 20_000 * (1 + F.col("id") % 2)).alias("ms"))
    burst = spark.range(20_000).select(F.lit("burst").alias("client"), (F.col("id") % 900).alias("ms"))
    logs = many.unionByName(burst).withColumn("ts", F.timestamp_millis("ms"))
    out = sessions.sessionize(logs, "client", "ts", 30_000)
    ends = {r[0]: r[1:] for r in out.where("client IN ('0', '1', 'burst')").groupBy("client").agg(F.max("session_id"), F.count("*")).collect()}
    assert ends == {"0": (0, 10), "1": (9, 10), "burst": (0, 20_000)}
    assert out.where("session_id IS NULL").isEmpty()


def test_two_scans(spark, sf_dir):
    logs = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    plan = sessions.sessionize(logs, "user_id", "ts")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 2
