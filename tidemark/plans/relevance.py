"""Click signals, recommendations and ranking evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.scalars import hash_bucket
from tidemark.operators import recommend, signals
from tidemark.plans import bindings as b
from tidemark.plans.registry import query

_WEIGHTS = f"{b.CLICKS}, weights AS (SELECT query, item AS doc_id, count(*) AS weight FROM clicks GROUP BY query, item)"


def _weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.click_weights(b.clicks(spark, sf_dir).withColumnRenamed("item", "doc_id"))


@query("r01_interactions", f"WITH {b.CLICKS} SELECT user_id, item, count(*) AS weight FROM clicks GROUP BY user_id, item")
def r01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.interactions(b.clicks(spark, sf_dir))


@query(
    "r02_item_catalog",
    f"WITH {b.CLICKS} SELECT DISTINCT query || '-' || item AS id, query AS artist, item AS song FROM clicks",
)
def r02(spark: SparkSession, sf_dir: str) -> DataFrame:
    listens = b.clicks(spark, sf_dir).select(F.col("query").alias("artist"), F.col("item").alias("song"), "user_id")
    return signals.catalogue(listens, "artist", "song")


def _similar_sql(source: str, user: str, item: str, n: int) -> str:
    return f"""base AS (SELECT DISTINCT {user} AS u, {item} AS i FROM {source}),
        sizes AS (SELECT i, count(*) AS size FROM base GROUP BY i),
        pairs AS (SELECT a.i AS item, b.i AS other, count(*) AS common FROM base a JOIN base b ON a.u = b.u AND a.i <> b.i GROUP BY a.i, b.i)
        SELECT item, other, common, round(common / sqrt(sa.size * sb.size), 6) AS similarity,
          CAST(row_number() OVER (PARTITION BY item ORDER BY CAST(common * common AS DOUBLE) / sb.size DESC, other) AS INTEGER) AS rank
        FROM pairs JOIN sizes sa ON sa.i = item JOIN sizes sb ON sb.i = other
        QUALIFY rank <= {n}"""


@query("r04_items_for_item", f"WITH {b.CLICKS}, {_similar_sql('clicks', 'user_id', 'item', 10)}")
def r04(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = recommend.similar_items(signals.interactions(b.clicks(spark, sf_dir)), 10)
    return out.withColumn("similarity", F.round("similarity", 6))


@query("r04_similar_movies", f"WITH {b.RATINGS}, {_similar_sql('ratings', 'user_id', 'movie_id', 5)}")
def r04_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    inter = signals.interactions(b.ratings(spark, sf_dir), "user_id", "movie_id")
    return recommend.similar_items(inter, 5, item="movie_id").withColumn("similarity", F.round("similarity", 6))


@query("r04_items_for_item_bounded", f"WITH {b.CLICKS}, {_similar_sql('clicks', 'user_id', 'item', 10)}")
def r04_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = recommend.top_similar(signals.interactions(b.clicks(spark, sf_dir)), 10)
    return out.withColumn("similarity", F.round("similarity", 6))


@query("r04_similar_movies_bounded", f"WITH {b.RATINGS}, {_similar_sql('ratings', 'user_id', 'movie_id', 5)}")
def r04_movies_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    inter = signals.interactions(b.ratings(spark, sf_dir), "user_id", "movie_id")
    return recommend.top_similar(inter, 5, item="movie_id").withColumn("similarity", F.round("similarity", 6))


_NEAR = _similar_sql("clicks", "user_id", "item", 10)


@query(
    "r03_items_for_user",
    f"""WITH {b.CLICKS}, near AS (WITH {_NEAR}),
        inter AS (SELECT user_id, item, count(*) AS weight FROM clicks GROUP BY user_id, item),
        scored AS (SELECT user_id, other AS item, sum(weight * CAST(round(similarity * 1000000) AS BIGINT)) AS parts
          FROM inter JOIN near USING (item) GROUP BY user_id, other)
        SELECT user_id, item, CAST(parts AS DOUBLE) / 1000000 AS score,
          CAST(row_number() OVER (PARTITION BY user_id ORDER BY parts DESC, item) AS INTEGER) AS rank
        FROM scored ANTI JOIN inter USING (user_id, item) QUALIFY rank <= 5""",
)
def r03(spark: SparkSession, sf_dir: str) -> DataFrame:
    inter = signals.interactions(b.clicks(spark, sf_dir))
    return recommend.items_for_users(inter, recommend.similar_items(inter, 10), 5)


@query(
    "r03_items_for_user_all",
    f"""WITH {b.CLICKS}, near AS (WITH {_similar_sql("clicks", "user_id", "item", 1 << 30)}),
        inter AS (SELECT user_id, item, count(*) AS weight FROM clicks GROUP BY user_id, item),
        scored AS (SELECT user_id, other AS item, sum(weight * CAST(round(similarity * 1000000) AS BIGINT)) AS parts
          FROM inter JOIN near USING (item) GROUP BY user_id, other)
        SELECT user_id, item, CAST(parts AS DOUBLE) / 1000000 AS score,
          CAST(row_number() OVER (PARTITION BY user_id ORDER BY parts DESC, item) AS INTEGER) AS rank
        FROM scored ANTI JOIN inter USING (user_id, item) QUALIFY rank <= 5""",
)
def r03_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From every item that shares a user with one of the user's items."""
    inter = signals.interactions(b.clicks(spark, sf_dir))
    return recommend.items_for_users(inter, recommend.all_similarities(inter), 5)


def _factor_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    inter = signals.interactions(b.ratings(spark, sf_dir), "user_id", "movie_id")
    return recommend.recommend_for_users(inter, 5, item="movie_id")


@query("r03_als_items_for_user")
def r03_als(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, movie_id, score, rank)."""
    return _factor_items(spark, sf_dir)


@query(
    "r03_als_items_for_user_checked",
    f"""WITH {b.RATINGS} SELECT user_id, least(5, (SELECT count(DISTINCT movie_id) FROM ratings)) AS n, true AS ranks, true AS by_score
        FROM (SELECT DISTINCT user_id FROM ratings)""",
)
def r03_als_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _factor_items(spark, sf_dir)
    lists = found.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("rank", "score", "movie_id"))).alias("l"))
    ranks = F.transform("l", lambda x: x["rank"]) == F.sequence(F.lit(1), F.size("l"))
    scores = F.transform("l", lambda x: x["score"])
    distinct = F.size(F.array_distinct(F.transform("l", lambda x: x["movie_id"])))
    return lists.select(F.col("user_id").cast("bigint").alias("user_id"), distinct.cast("bigint").alias("n"), ranks.alias("ranks"), (scores == F.sort_array(scores, asc=False)).alias("by_score"))


_BOOSTS = """boosts AS (SELECT query, doc_id, weight, CAST(row_number() OVER (PARTITION BY query ORDER BY weight DESC, doc_id) AS INTEGER) AS rank
    FROM weights)"""


@query("r05_boost_ranking", f"WITH {_WEIGHTS}, {_BOOSTS} SELECT query, doc_id, weight, rank FROM boosts WHERE rank <= 20")
def r05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.boosts(_weights(spark, sf_dir), 20)


@query(
    "r06_boost_parse",
    f"""WITH {_WEIGHTS} SELECT query, doc_id, CASE WHEN query <> 'q3' THEN doc_id END AS boost_doc,
        CASE WHEN query <> 'q4' THEN CAST(weight AS DOUBLE) END AS boost_weight, query IN ('q3', 'q4') AS rejected FROM weights""",
)
def r06(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = signals.boost_text("doc_id", "weight")
    # two of the queries have boosts that lack a part
    broken = F.when(F.col("query") == "q3", F.replace(text, F.lit("v='"), F.lit("v=")))
    broken = broken.when(F.col("query") == "q4", F.replace(text, F.lit(".0)"), F.lit("x)"))).otherwise(text)
    return signals.parse_boosts(_weights(spark, sf_dir).withColumn("boost", broken), "boost").drop("boost", "weight")


@query(
    "r07_rank_regression",
    f"""WITH {_WEIGHTS}, {_BOOSTS}, top3 AS (SELECT query, list(doc_id ORDER BY rank) AS docs FROM boosts WHERE rank <= 3 GROUP BY query)
        SELECT query, array_to_string(CASE WHEN query IN ('q1', 'q5') THEN list_reverse(docs) ELSE docs END, ',') AS expected,
          array_to_string(docs, ',') AS produced, query NOT IN ('q1', 'q5') AS passed FROM top3""",
)
def r07(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = _weights(spark, sf_dir)
    top = signals.boosts(weights, 3).groupBy("query").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "doc_id"))), lambda r: r["doc_id"]).alias("rank")
    )
    # two expectations are turned round, which must be noticed
    expected = top.withColumn("rank", F.when(F.col("query").isin("q1", "q5"), F.reverse("rank")).otherwise(F.col("rank")))
    checked = signals.rank_check(expected, signals.boosts(weights, 20))
    return checked.withColumns({c: F.array_join(c, ",") for c in ("expected", "produced")})


@query(
    "r08_variant_assign",
    """SELECT event_id, CASE WHEN CAST(('0x' || substr(md5('variant:' || user_id), 1, 8)) AS BIGINT) % 10000 < 5000 THEN 'v1' ELSE 'v2' END AS variant
        FROM events""",
)
def r08(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = b.table(spark, sf_dir, "events").select("event_id", "user_id")
    return signals.assign_variant(events, "user_id", [("v1", 1.0), ("v2", 1.0)]).drop("user_id")


_TRUTH = """truth AS (SELECT query, doc_id, weight, CAST(greatest(1, ceil(weight * 3 / max(weight) OVER (PARTITION BY query))) AS BIGINT) AS grade
    FROM weights WHERE weight >= 2)"""


@query("r09_ground_truth", f"WITH {_WEIGHTS}, {_TRUTH} SELECT query, doc_id, weight, grade FROM truth")
def r09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.ground_truth(_weights(spark, sf_dir), min_weight=2)


_METRICS = f"""WITH {_WEIGHTS}, {_BOOSTS}, {_TRUTH},
    shuffled AS (SELECT query, doc_id, CAST(row_number() OVER (PARTITION BY query
      ORDER BY CAST(('0x' || substr(md5('order:' || doc_id), 1, 8)) AS BIGINT) % 10000, doc_id) AS INTEGER) AS rank FROM weights),
    results AS (SELECT 'v1' AS variant, query, doc_id, rank FROM boosts WHERE rank <= 10
      UNION ALL SELECT 'v2', query, doc_id, rank FROM shuffled WHERE rank <= 10 AND query <> 'q3'),
    hits AS (SELECT variant, query, rank, grade, sum(CASE WHEN grade IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY variant, query ORDER BY rank) AS seen
      FROM results LEFT JOIN truth USING (query, doc_id)),
    found AS (SELECT variant, query, count(grade) AS n, min(rank) FILTER (grade IS NOT NULL) AS first_hit,
      sum(CAST(seen AS DOUBLE) / rank) FILTER (grade IS NOT NULL) AS ps, sum(grade / log2(rank + 1)) AS dcg FROM hits GROUP BY variant, query),
    ideal AS (SELECT query, count(*) AS relevant, sum(grade / log2(place + 1)) FILTER (place <= 10) AS idcg FROM
      (SELECT query, grade, row_number() OVER (PARTITION BY query ORDER BY grade DESC, doc_id) AS place FROM truth) GROUP BY query),
    metrics AS (SELECT variant, query, coalesce(n, 0) / 10.0::DOUBLE AS precision_at_k, CAST(coalesce(n, 0) AS DOUBLE) / relevant AS recall_at_k,
      coalesce(1.0::DOUBLE / first_hit, 0) AS reciprocal_rank, coalesce(ps / relevant, 0) AS average_precision, coalesce(dcg / idcg, 0) AS ndcg_at_k
      FROM ideal CROSS JOIN (SELECT DISTINCT variant FROM results) LEFT JOIN found USING (variant, query))"""
_NAMES = ["precision_at_k", "recall_at_k", "reciprocal_rank", "average_precision", "ndcg_at_k"]


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = _weights(spark, sf_dir)
    by_clicks = signals.boosts(weights, 10)
    # the other variant shows the documents in an order that knows nothing of clicks
    mixed = weights.withColumn("weight", -hash_bucket("doc_id", 10_000, "order"))
    # ... and shows nothing at all for one query
    others = signals.boosts(mixed, 10).where("query <> 'q3'").withColumn("variant", F.lit("v2"))
    results = by_clicks.withColumn("variant", F.lit("v1")).unionByName(others)
    return signals.ranking_metrics(results.drop("weight"), signals.ground_truth(weights, min_weight=2), 10)


@query("r10_ranking_metrics", f"{_METRICS} SELECT variant, query, {', '.join(f'round({n}, 6) AS {n}' for n in _NAMES)} FROM metrics")
def r10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, sf_dir).withColumns({n: F.round(n, 6) for n in _NAMES})


@query(
    "r10_mean_metrics",
    f"{_METRICS} SELECT variant, count(*) AS queries, {', '.join(f'round(avg({n}), 6) AS {n}' for n in _NAMES)} FROM metrics GROUP BY variant",
)
def r10_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.mean_metrics(_metrics(spark, sf_dir)).withColumns({n: F.round(n, 6) for n in _NAMES})
