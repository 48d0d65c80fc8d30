"""Filters, joins, facets and catalogue calls on inline rows."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import catalog, facets, joins, predicates


@pytest.fixture(scope="module")
def ratings(spark):
    rows = [(u, m, 1 + (u * m) % 5) for u in range(12) for m in range(8) if (u + m) % 3]
    return spark.createDataFrame(rows, "user_id int, movie_id int, rating int")


def test_require_and_ranges(spark):
    df = spark.createDataFrame([(1, "5.5", "a"), (2, "abc", ""), (3, None, None), (4, "91", "b")], "id int, lat string, s string")
    assert [r.id for r in predicates.require(df, "s", "lat").collect()] == [1, 2, 4]
    assert [r.id for r in predicates.require(df, "s", non_empty=True).collect()] == [1, 4]
    assert [r.id for r in predicates.in_range(df, {"lat": (-90, 90)}).collect()] == [1]


def test_time_range_is_inclusive(spark):
    df = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ'2024-01-01', TIMESTAMP_NTZ'2024-01-02', INTERVAL 6 HOURS)) AS ts")
    assert predicates.time_range(df, "ts", "2024-01-01 06:00:00", "2024-01-01 18:00:00").count() == 3


def test_text_match_by_analyzer(spark):
    df = spark.createDataFrame([("Love, actually",), ("glove",), ("LOVE",)], "t string")
    assert predicates.text_match(df, "t", "love").count() == 2
    assert predicates.text_match(df, "t", "LOVE", "whitespace").count() == 1


def test_where_in_keeps_left_rows_once(spark, ratings):
    sub = spark.createDataFrame([(1,), (1,), (2,)], "m int")
    assert predicates.where_in(ratings, "movie_id", sub, "m").count() == ratings.where("movie_id IN (1, 2)").count()


def test_sample_is_repeatable(ratings):
    key = F.concat_ws("-", "user_id", "movie_id")
    a = predicates.sample_rows(ratings.repartition(5), key, 30, 9)
    assert a.exceptAll(predicates.sample_rows(ratings, key, 30, 9)).isEmpty()
    assert 0 < a.count() < ratings.count()


def test_topk_join_and_strategies(spark, ratings):
    movies = spark.range(8).select(F.col("id").cast("int").alias("movie_id"), F.concat(F.lit("m"), F.col("id").cast("string")).alias("title"))
    out = joins.join_topk(movies, ratings, "movie_id", [F.count(F.lit(1)).alias("n")], [F.col("n").desc(), F.col("movie_id")], 3)
    want = ratings.groupBy("movie_id").count().orderBy(F.col("count").desc(), "movie_id").limit(3).collect()
    assert {r.movie_id for r in out.collect()} == {r.movie_id for r in want}
    counts = {s: joins.hash_join(ratings, movies, "movie_id", s).count() for s in ("hash", "merge", "auto")}
    assert set(counts.values()) == {ratings.count()}
    assert "SortMergeJoin" in joins.hash_join(ratings, movies, "movie_id", "merge")._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        joins.hash_join(ratings, movies, "movie_id", "magic")


def test_profile(spark):
    df = spark.createDataFrame([("a", 1, ["x", "y"]), ("a", 3, []), ("b", None, None), (None, 2, ["x"])], "c string, n int, l array<string>")
    rows = {(r["column"], r["value"]): r for r in facets.column_profile(df, ["c", "n", "l"], top_n=1).collect()}
    assert rows[("c", "a")]["n"] == 2 and rows[("l", "x")]["n"] == 2 and len(rows) == 3
    n = rows[("n", None)]
    assert (n["n"], n["nulls"], n["min"], n["max"], n["avg"]) == (3, 1, 1.0, 3.0, 2.0)


def test_collect_by_key(spark):
    df = spark.sql("SELECT array(named_struct('k', 'p', 'v', 'z'), named_struct('k', 'q', 'v', 'a'), named_struct('k', 'p', 'v', 'b'), named_struct('k', 'p', 'v', 'b')) AS a")
    row = df.select(facets.collect_by_key(F.col("a"), "k", "v", ["p", "q", "r"]).alias("m"), facets.collect_by_key(F.col("a"), "k", "v", ["p"], True).alias("s")).first()
    assert row["m"] == {"p": ["z", "b", "b"], "q": ["a"], "r": []} and row["s"] == {"p": ["b", "z"]}


def test_page_and_sets(spark, ratings):
    assert facets.page(ratings, [F.col("user_id"), F.col("movie_id")], 4, F.col("rating") == 1).count() == 4
    assert facets.page(ratings, [F.col("user_id")]).count() == ratings.count()
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    assert [r.x for r in facets.common_pairs(a, a.where("x = 1")).collect()] == [1]


def test_histogram_and_grid(spark):
    df = spark.sql("SELECT explode(sequence(TIMESTAMP'2024-01-01', TIMESTAMP'2024-01-03', INTERVAL 8 HOURS)) AS ts")
    assert sorted(r.n for r in facets.time_histogram(df, "ts", "day").collect()) == [1, 3, 3]
    pts = spark.createDataFrame([(44.9, -93.2), (44.8, -93.3), (0.0, 0.0)], "lat double, lon double")
    grid = facets.geo_grid(pts, "lat", "lon", (-126.0, 23.0, -67.0, 51.0)).collect()
    assert sum(r.n for r in grid) == 2


def test_catalogue(spark, ratings):
    ratings.createOrReplaceTempView("cat_ratings")
    out = catalog.cache_as(spark, "SELECT movie_id, count(*) AS n FROM cat_ratings GROUP BY movie_id", "cat_counts")
    assert spark.catalog.isCached("cat_counts") and out.agg(F.sum("n")).first()[0] == ratings.count()
    assert catalog.set_cached(spark, "cat_counts", False) is False
    names = {r.tableName for r in catalog.show_tables(spark, "cat_*").collect()}
    assert names == {"cat_ratings", "cat_counts"}
    assert {r.table_name: r.n for r in catalog.table_sizes(spark, "cat_*").collect()}["cat_ratings"] == ratings.count()
    assert catalog.table_sizes(spark, "no_such_*").collect() == []
    assert [(r.column_name, r.data_type, r.nulls) for r in catalog.describe(spark, "cat_ratings").collect()] == [
        ("user_id", "int", 0), ("movie_id", "int", 0), ("rating", "int", 0),
    ]
    catalog.define_view(ratings, "cat_best", F.col("rating") == 5, ["user_id"])
    assert spark.table("cat_best").columns == ["user_id"]
    assert catalog.first_rows(spark, "cat_best", 2).count() == 2


def test_exact_profile(spark):
    """Distinct counts and quantiles as Spark's own aggregates give them, from values that no single task holds."""
    from tidemark.operators import facets

    df = spark.range(0, 5_001, 1, 5).selectExpr("id % 977 AS a", "IF(id % 3 = 0, NULL, id * id % 211) AS b", "7 AS c", "CAST(NULL AS INT) AS d")
    got = {r["column"]: r for r in facets.exact_profile(df, ["a", "b", "c", "d"], [0.0, 0.45, 0.55, 1.0]).collect()}
    want = df.selectExpr(*(f"count(DISTINCT {c}) AS n_{c}" for c in "abc"), *(f"percentile({c}, array(0.0, 0.45, 0.55, 1.0)) AS q_{c}" for c in "abc")).first()
    assert set(got) == {"a", "b", "c"}
    for c in "abc":
        assert got[c]["distinct"] == want[f"n_{c}"] and got[c]["quantiles"] == pytest.approx(want[f"q_{c}"], rel=1e-12)
