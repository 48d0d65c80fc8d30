"""What the physical plans must and must not hold."""

from pathlib import Path

import pytest

from tidemark.plans import ORACLES, QUERIES

# queries that train a model or run a stream while they are built; their plans are Spark ML's own
SLOW = {n for n in QUERIES if n.startswith(("m0", "m1", "st0", "k08", "r03_als", "x10"))}


def plan_of(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    plan = plan_of(spark, sf_dir, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert bad not in plan


@pytest.mark.parametrize(
    "name,wanted",
    [
        ("s06_parquet_scan", ["GreaterThanOrEqual(l_quantity,49.0)", "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>"]),
        ("f03_time_range", ["GreaterThanOrEqual(ts,", "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>"]),
        ("j05_semi", ["LeftSemi", "EqualTo(p_type,PROMO)"]),
        ("t01_topk", ["TakeOrderedAndProject"]),
        ("a05_popular_topk", ["TakeOrderedAndProject", "BroadcastHashJoin"]),
        ("w03_latest_per_key", ["WindowGroupLimit", "Partial"]),
        ("r05_boost_ranking", ["WindowGroupLimit", "partial_count"]),
        ("a07_session_agg", ["partial_sum"]),
        ("a11_column_profile", ["partial_count", "WindowGroupLimit"]),
    ],
)
def test_plan_holds(spark, sf_dir, name, wanted):
    plan = plan_of(spark, sf_dir, name)
    for text in wanted:
        assert text in plan


def test_sessions_shuffle_the_rows_once(spark, sf_dir):
    """The join to the slice rows takes the windowed rows as they are: no exchange, no sort in between."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan_of(spark, sf_dir, "a07_session_agg").splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    window = next(i for i, line in enumerate(lines) if i > join and "Window" in line)
    assert not any("Exchange" in line or "Sort " in line for line in lines[join + 1 : window])
    # the rows by slice, the slices by slice, by key and by slice again, and the totals
    scans = [line for line in lines if "Exchange hashpartitioning(clientip" in line]
    assert len(scans) == 5 and sum("_slice" in line for line in scans) == 3


def test_every_query_is_checked():
    """A query has SQL, or, where a trained model or a sketch is its result, SQL for what must hold of it under its name with a suffix."""
    held_by = {"x06_hashing_tf_counts": "x06_hashing_tf"}
    assert set(ORACLES) <= set(QUERIES)
    assert {q for q in QUERIES if q not in ORACLES and held_by.get(q, f"{q}_checked") not in ORACLES} == set()


def test_library_keeps_to_the_rules():
    root = Path(__file__).resolve().parent.parent
    for file in (root / "tidemark").rglob("*.py"):
        text = file.read_text()
        for bad in ("crossJoin", "localCheckpoint", ".toPandas(", "monotonically_increasing_id() %", ".rdd.map"):
            assert bad not in text, (file, bad)
