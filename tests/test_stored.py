"""Tables that grow batch by batch: upserts, sessions and click sums."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.sessions import session_summary, sessionize
from tidemark.scratch import fresh_path
from tidemark.streaming import flows, stored

KEYED = "k int, v int, s string"


def held(spark, path):
    return {(r.k, r.v, r.s) for r in stored.read_stored(spark, path, KEYED).collect()}


def test_upsert_batches(spark):
    path = fresh_path(spark, "t")
    frame = lambda rows: spark.createDataFrame(rows, KEYED)
    assert held(spark, path) == set() and stored.manifest(spark, path) is None
    assert stored.upsert_batch(path, 0, frame([(k, 1, "a") for k in range(40)]), "k", ["v"], parts=8)
    first = stored.manifest(spark, path)["parts"]
    assert stored.upsert_batch(path, 1, frame([(3, 2, "b"), (3, 3, "c"), (4, 0, "old"), (99, 1, "new"), (None, 1, "n")]), "k", ["v"], parts=8)
    want = {(k, 1, "a") for k in range(40) if k != 3} | {(3, 3, "c"), (99, 1, "new"), (None, 1, "n")}
    assert held(spark, path) == want
    # only the parts of changed keys are written again
    second = stored.manifest(spark, path)["parts"]
    assert {p for p in second if second[p] == 1} != set(second) and all(second[p] == 0 for p in first if second[p] != 1)
    # a batch that is in already, or an older one, changes nothing
    for batch in (1, 0):
        assert not stored.upsert_batch(path, batch, frame([(3, 9, "again")]), "k", ["v"], parts=8)
    assert held(spark, path) == want
    # ties go to the later batch, and an empty batch is one
    assert stored.upsert_batch(path, 2, frame([(3, 3, "tie")]), "k", ["v"], parts=8) and stored.upsert_batch(path, 3, frame([]), "k", ["v"], parts=8)
    want = want - {(3, 3, "c")} | {(3, 3, "tie")}
    assert held(spark, path) == want
    assert stored.vacuum(spark, path) > 0 and held(spark, path) == want and stored.vacuum(spark, path) == 0


def test_a_batch_that_died_is_not_seen(spark, monkeypatch):
    path = fresh_path(spark, "t")
    stored.upsert_batch(path, 0, spark.createDataFrame([(1, 1, "a")], KEYED), "k", ["v"], parts=2)
    with monkeypatch.context() as m:
        m.setattr(stored, "_publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            stored.upsert_batch(path, 1, spark.createDataFrame([(1, 2, "half"), (2, 2, "half")], KEYED), "k", ["v"], parts=2)
    assert held(spark, path) == {(1, 1, "a")}
    stored.upsert_batch(path, 1, spark.createDataFrame([(1, 2, "whole")], KEYED), "k", ["v"], parts=2)
    assert held(spark, path) == {(1, 2, "whole")}


def test_upsert_stream_repeats_a_batch_without_effect(spark, monkeypatch):
    path, source, mark = (fresh_path(spark, n) for n in ("t", "source", "mark"))
    calls = []
    inner = stored.upsert_batch
    # the stream's own commit fails once, after the table's; the restart runs the same batch again

    def fails_after(target, batch, *rest):
        calls.append(inner(target, batch, *rest))
        if len(calls) == 2:
            raise OSError("lost after the commit")

    monkeypatch.setattr(stored, "upsert_batch", fails_after)
    for i in range(3):
        spark.createDataFrame([(1, i, f"v{i}"), (10 + i, 0, "x")], KEYED).coalesce(1).write.mode("append").parquet(source)
        for _ in range(2):
            try:
                stored.upsert_stream(flows.read_stream(spark, source, KEYED), path, mark, "k", ["v"], parts=2).awaitTermination()
                break
            except Exception as lost:
                assert "lost after the commit" in str(lost)
    assert calls == [True, True, False, True]
    assert held(spark, path) == {(1, 2, "v2"), (10, 0, "x"), (11, 0, "x"), (12, 0, "x")}


BEGIN = datetime(2024, 1, 1)
ROWS = "k string, ts timestamp, n int"


def sessions(spark, path, kind):
    rows = stored.read_stored(spark, path, kind).withColumn("open", F.lit(True)).unionByName(stored.read_emitted(spark, path, kind).withColumn("open", F.lit(False)))
    return sorted((r.k, (r.session_start - BEGIN).total_seconds(), (r.session_end - BEGIN).total_seconds(), r.total, r["count"], r.open) for r in rows.collect())


def test_sessions_of_three_batches(spark):
    """Gap 30 s, watermark 60 s behind the batches before."""
    path = fresh_path(spark, "s")
    at = lambda s: BEGIN + timedelta(seconds=s)
    batches = [
        [("a", 0, 1), ("a", 20, 2), ("b", 100, 4), (None, 50, 9), ("b", None, 9)],
        # 45 and 70 are late but taken: they lengthen b's session backwards as far as 70; 39 is beyond the watermark of 40
        [("b", 45, 8), ("b", 70, 16), ("a", 39, 32), ("c", 200, 64)],
        [("c", 231, 128), ("c", 200, 256), ("b", 139, 512), ("d", 400, 1024)],  # 231 is more than the gap after 200; 139 is beyond 140
        [],
    ]
    kind = None
    for i, rows in enumerate(batches):
        df = spark.createDataFrame([(k, at(s) if s is not None else None, n) for k, s, n in rows], ROWS)
        kind = kind or stored.session_schema(df, "k", "ts", "n")
        assert stored.sessions_batch(path, i, df, "k", "ts", "n", 30_000, 60_000, parts=4)
        assert not stored.sessions_batch(path, i, df, "k", "ts", "n", 30_000, 60_000, parts=4)
        if i == 0:
            assert sessions(spark, path, kind) == [("a", 0, 20, 3, 2, True), ("b", 100, 100, 4, 1, True)]
    assert sessions(spark, path, kind) == [
        ("a", 0, 20, 3, 2, False), ("b", 45, 100, 28, 3, False), ("c", 200, 200, 320, 2, False), ("c", 231, 231, 128, 1, False), ("d", 400, 400, 1024, 1, True),
    ]


def test_sessions_equal_those_of_all_rows_at_once(spark):
    """Rows in any order within the delay: bridged sessions and a key with most rows come out as from one pass."""
    rng = random.Random(8)
    rows = sorted((rng.randrange(4000), "hot" if rng.random() < 0.5 else f"k{rng.randrange(5)}", rng.randrange(10)) for _ in range(600))
    mixed = sorted(rows, key=lambda r: r[0] + rng.randrange(300))
    path, source, mark = (fresh_path(spark, n) for n in ("s", "source", "mark"))
    every = spark.createDataFrame([(k, BEGIN + timedelta(seconds=s), n) for s, k, n in mixed], ROWS)
    kind = stored.session_schema(every, "k", "ts", "n")
    for i in range(0, 600, 200):
        part = spark.createDataFrame([(k, BEGIN + timedelta(seconds=s), n) for s, k, n in mixed[i : i + 200]], ROWS)
        part.coalesce(1).write.mode("append").parquet(source)
        stored.sessions_stream(flows.read_stream(spark, source, ROWS), path, mark, "k", "ts", "n", 20_000, 400_000, parts=4).awaitTermination()
    want = session_summary(sessionize(every, "k", "ts", 20_000), "k", "ts", "n").collect()
    got = sessions(spark, path, kind)
    assert [r[:5] for r in got] == sorted((r.k, (r.session_start - BEGIN).total_seconds(), (r.session_end - BEGIN).total_seconds(), r.total_bytes_l, r.total_requests_l) for r in want)
    assert {r[5] for r in got} == {True, False}


def test_two_loads_of_clicks_are_one(spark):
    rng = random.Random(9)
    rows = [(f"q{rng.randrange(3)}", f"d{rng.randrange(4)}", BEGIN + timedelta(hours=i), rng.randrange(1, 5)) for i in range(200)]
    schema = "query string, doc_id string, ts timestamp, w int"
    one, two = fresh_path(spark, "one"), fresh_path(spark, "two")
    stored.add_clicks(one, 0, spark.createDataFrame(rows, schema), weight="w")
    stored.add_clicks(two, 0, spark.createDataFrame(rows[:90], schema), weight="w")
    before = stored.manifest(spark, two)["parts"]
    stored.add_clicks(two, 1, spark.createDataFrame(rows[50:] + [("q0", "d0", None, 7)], schema), weight="w")
    stored.add_clicks(two, 2, spark.createDataFrame(rows, schema), weight="w")  # nothing new
    after = stored.manifest(spark, two)["parts"]
    assert sum(after[p] == before[p] for p in before) == len(before) - 1  # the last day only was opened again
    for half_life in (None, 2.0):
        got = [{(r.query, r.doc_id): r.weight for r in stored.stored_click_weights(spark, p, half_life).collect()} for p in (one, two)]
        assert got[0] == pytest.approx(got[1])
    last = max(r[2] for r in rows).date()
    want = {}
    for q, d, ts, w in rows:
        want[(q, d)] = want.get((q, d), 0) + w * 0.5 ** ((last - ts.date()).days / 2)
    assert got[0] == pytest.approx(want)
    assert stored.stored_click_weights(spark, fresh_path(spark, "none")).count() == 0
