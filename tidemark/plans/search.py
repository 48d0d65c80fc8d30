"""Filters, joins, top-k, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.geo import distance_km
from tidemark.functions.scalars import iso
from tidemark.operators import facets, joins, predicates, token_index
from tidemark.plans import bindings as b
from tidemark.plans.registry import query
from tidemark.scratch import fresh_path, materialize
from tidemark.sources import writers

_BUCKET = "CAST(('0x' || substr(md5('{seed}:' || {key}), 1, 8)) AS BIGINT) % 100"


# ---- filters -------------------------------------------------------------------------------------------


@query(
    "f01_exists",
    """WITH k AS (SELECT event_id, json_extract_string(props, '$.k') AS k,
        CASE WHEN event_type <> 'error' THEN event_type END AS kind FROM events)
        SELECT event_id, k, kind FROM k WHERE k IS NOT NULL AND kind IS NOT NULL""",
)
def f01(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = b.table(spark, sf_dir, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"),
    )
    return predicates.require(events, "k", "kind")


@query(
    "f02_numeric_range",
    f"""WITH {b.HOMES} SELECT user_id, round(latitude, 4) AS latitude, CAST(longitude AS VARCHAR) IS NOT NULL AS known FROM homes
        WHERE latitude BETWEEN 44.5 AND 45.25 AND longitude BETWEEN -180 AND 180""",
)
def f02(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the longitude arrives as text, as it does from a delimited file
    points = b.homes(spark, sf_dir).withColumn("longitude", F.col("longitude").cast("string"))
    near = predicates.in_range(points, {"latitude": (44.5, 45.25), "longitude": (-180, 180)})
    return near.select("user_id", F.round("latitude", 4).alias("latitude"), F.col("longitude").isNotNull().alias("known"))


@query("f02_rating_range", f"WITH {b.RATINGS} SELECT user_id, movie_id, rating FROM ratings WHERE rating >= 4")
def f02_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicates.in_range(b.ratings(spark, sf_dir), {"rating": (4, None)}).select("user_id", "movie_id", "rating")


@query(
    "f03_time_range",
    f"""SELECT event_id, {b.iso_sql('ts')} AS ts FROM events
        WHERE ts BETWEEN '2024-01-10 00:00:00' AND '2024-01-10 12:00:00'""",
)
def f03(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = predicates.time_range(b.table(spark, sf_dir, "events"), "ts", "2024-01-10 00:00:00", "2024-01-10 12:00:00")
    return hit.select("event_id", iso("ts").alias("ts"))


@query(
    "f04_facet_filters",
    f"""WITH {b.USERS}, {b.RATINGS} SELECT user_id, movie_id, rating, occupation FROM users JOIN ratings USING (user_id)
        WHERE gender = 'F' AND occupation = 'MACHINERY'""",
)
def f04(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = b.ratings(spark, sf_dir).join(b.users(spark, sf_dir), "user_id")
    hit = predicates.facet_filter(joined, {"gender": "F", "occupation": "MACHINERY"})
    return hit.select("user_id", "movie_id", "rating", "occupation")


@query("f05_text_match", f"WITH {b.MOVIES} SELECT movie_id, title FROM movies WHERE list_contains({b.tokens_sql('title')}, 'blue')")
def f05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicates.text_match(b.movies(spark, sf_dir), "title", "Blue").select("movie_id", "title")


@query("f05_text_match_documents", f"SELECT doc_id FROM documents WHERE list_contains({b.tokens_sql('text')}, 'the')")
def f05_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicates.text_match(b.documents(spark, sf_dir), "text", "the").select("doc_id")


@query(
    "f06_geo_radius",
    f"WITH {b.HOMES} SELECT user_id, round({b.DISTANCE}, 3) AS km FROM homes WHERE {b.DISTANCE} <= 50",
)
def f06(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = predicates.within_km(b.homes(spark, sf_dir), "latitude", "longitude", b.CENTRE, b.RADIUS_KM)
    return near.select("user_id", F.round(distance_km("latitude", "longitude", b.CENTRE), 3).alias("km"))


_CENTRES = f"""{b.HOMES}, centres AS (SELECT place_name AS centre, state, latitude AS clat, longitude AS clon FROM zips),
    near AS (SELECT user_id, centre, state, 2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(latitude - clat) / 2), 2)
      + cos(radians(latitude)) * cos(radians(clat)) * pow(sin(radians(longitude - clon) / 2), 2)))) AS km FROM homes, centres)"""


def _near_centres(spark: SparkSession, sf_dir: str, km: float, state: str | None = None) -> DataFrame:
    centres = b.zips(spark, sf_dir)
    if state:
        centres = centres.where(F.col("state") == state)
    centres = centres.select(F.col("place_name").alias("centre"), F.col("latitude").alias("centre_latitude"), F.col("longitude").alias("centre_longitude"))
    return joins.join_near(b.homes(spark, sf_dir), centres, km)


@query("f06_near_centres", f"WITH {_CENTRES} SELECT user_id, centre, round(km, 3) AS km FROM near WHERE km <= 20")
def f06_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user with every place within 20 km."""
    return _near_centres(spark, sf_dir, 20.0).select("user_id", "centre", F.round("km", 3).alias("km"))


@query("j04_near_filtered_centres", f"WITH {_CENTRES} SELECT centre, count(*) AS n FROM near WHERE km <= 35 AND state = 'ASIA' GROUP BY centre")
def j04_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _near_centres(spark, sf_dir, 35.0, "ASIA").groupBy("centre").agg(F.count(F.lit(1)).alias("n"))


def _document_index(spark: SparkSession, sf_dir: str) -> str:
    """Two loads of documents; the second brings every tenth document again, whole."""
    docs = b.texts(spark, sf_dir).select(F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 10 > 0, F.col("text")).otherwise("the first form").alias("text"))
    path = fresh_path(spark, "token-index")
    name = "token_index_" + path.rsplit("-", 1)[1]
    token_index.index_tokens(docs, name, path, load=0, buckets=16)
    again = b.texts(spark, sf_dir).where("doc_id % 10 = 0").select(F.col("doc_id").alias("id"), "text")
    token_index.index_tokens(again, name, path, load=1, buckets=16)
    return name


@query("f05_token_index", f"SELECT doc_id FROM documents WHERE list_contains({b.tokens_sql('text')}, 'the') AND list_contains({b.tokens_sql('text')}, 'and')")
def f05_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold both words, from one or two buckets of the stored index."""
    return token_index.match_ids(spark, _document_index(spark, sf_dir), ["the", "and"]).withColumnRenamed("id", "doc_id")


@query(
    "f07_token_index",
    f"""SELECT source, count(*) AS n FROM documents WHERE doc_id IN (SELECT doc_id FROM documents
        WHERE list_contains({b.tokens_sql('text')}, 'form') OR list_contains({b.tokens_sql('text')}, 'und')) GROUP BY source""",
)
def f07_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = token_index.match_ids(spark, _document_index(spark, sf_dir), ["form", "und"], every=False)
    hit = token_index.matches(ids, b.documents(spark, sf_dir).select("doc_id", "source"), "doc_id")
    return hit.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query(
    "f07_in_subquery",
    f"""WITH {b.RATINGS}, {b.MOVIES} SELECT movie_id, count(*) AS n FROM ratings
        WHERE movie_id IN (SELECT movie_id FROM movies WHERE list_contains({b.tokens_sql('title')}, 'small'))
        GROUP BY movie_id ORDER BY n DESC, movie_id LIMIT 100""",
)
def f07(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_movie = b.ratings(spark, sf_dir).groupBy("movie_id").agg(F.count(F.lit(1)).alias("n"))
    small = predicates.text_match(b.movies(spark, sf_dir), "title", "small")
    hit = predicates.where_in(per_movie, "movie_id", small, "movie_id")
    return facets.topk(hit, [F.col("n").desc(), F.col("movie_id")], 100)


@query("f08_having", f"WITH {b.RATINGS} SELECT movie_id, count(*) AS n FROM ratings GROUP BY movie_id HAVING count(*) > 30")
def f08(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = facets.facet(b.ratings(spark, sf_dir), "movie_id", [F.count(F.lit(1)).alias("n")])
    return predicates.having(counts, F.col("n") > 30)


_SAMPLE = _BUCKET.format(seed=2121, key="user_id || '-' || movie_id")


@query("f09_sample", f"WITH {b.RATINGS} SELECT user_id, movie_id, rating FROM ratings WHERE {_SAMPLE} < 10")
def f09(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = predicates.sample_rows(b.ratings(spark, sf_dir), F.concat_ws("-", "user_id", "movie_id"), 10, seed=2121)
    return picked.select("user_id", "movie_id", "rating")


@query(
    "f10_drop_incomplete",
    """SELECT event_id, event_type, item FROM (SELECT event_id, event_type,
        CASE WHEN event_type IN ('click', 'purchase') THEN json_extract_string(props, '$.k') ELSE '' END AS item FROM events)
        WHERE item <> ''""",
)
def f10(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    events = b.table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.when(F.col("event_type").isin("click", "purchase"), k).otherwise("").alias("item")
    )
    return predicates.require(events, "item", non_empty=True)


# ---- joins ---------------------------------------------------------------------------------------------


@query("j01_inner", f"WITH {b.RATINGS}, {b.MOVIES} SELECT movie_id, title, user_id, rating FROM ratings JOIN movies USING (movie_id)")
def j01(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = joins.join_inner(b.ratings(spark, sf_dir), b.movies(spark, sf_dir), "movie_id")
    return joined.select("movie_id", "title", "user_id", "rating")


@query(
    "j02_left_outer",
    f"""WITH {b.RATINGS}, {b.MOVIES}, m AS (SELECT movie_id, count(*) AS n, max(rating) AS best FROM ratings WHERE rating >= 5
        GROUP BY movie_id) SELECT movie_id, title, n, best FROM movies LEFT JOIN m USING (movie_id)""",
)
def j02(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = b.ratings(spark, sf_dir).where("rating >= 5").groupBy("movie_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("rating").alias("best")
    )
    return joins.join_left(b.movies(spark, sf_dir).select("movie_id", "title"), top, "movie_id", ["n", "best"])


@query(
    "j03_join_topk_subquery",
    f"""WITH {b.RATINGS}, {b.USERS}, agg AS (SELECT user_id, count(*) AS n, CAST(sum(rating) AS BIGINT) AS total FROM ratings
        GROUP BY user_id ORDER BY n DESC, user_id LIMIT 10) SELECT user_id, occupation, n, total FROM users JOIN agg USING (user_id)""",
)
def j03(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = joins.join_topk(
        b.users(spark, sf_dir), b.ratings(spark, sf_dir), "user_id",
        [F.count(F.lit(1)).alias("n"), F.sum("rating").alias("total")], [F.col("n").desc(), F.col("user_id")], 10,
    )
    return out.select("user_id", "occupation", "n", "total")


@query(
    "j04_join_filtered_subquery",
    f"""WITH {b.USERS}, {b.ZIPS}, near AS (SELECT zip_code, place_name FROM zips WHERE {b.DISTANCE} <= 50)
        SELECT place_name, count(*) AS n FROM users JOIN near USING (zip_code) WHERE gender = 'F' GROUP BY place_name""",
)
def j04(spark: SparkSession, sf_dir: str) -> DataFrame:
    women = predicates.facet_filter(b.users(spark, sf_dir), {"gender": "F"})
    near = distance_km("latitude", "longitude", b.CENTRE) <= b.RADIUS_KM
    # users are counted per place before the join, so a place with most of them is one row there
    per_zip = women.groupBy("zip_code").agg(F.count(F.lit(1)).alias("c"))
    joined = joins.join_filtered(per_zip, b.zips(spark, sf_dir), near, "zip_code")
    return facets.facet(joined, "place_name", [F.sum("c").alias("n")])


@query(
    "j05_semi",
    f"""WITH {b.RATINGS}, {b.MOVIES} SELECT user_id, movie_id, rating FROM ratings
        WHERE movie_id IN (SELECT movie_id FROM movies WHERE rated = 'PROMO')""",
)
def j05(spark: SparkSession, sf_dir: str) -> DataFrame:
    promo = predicates.facet_filter(b.movies(spark, sf_dir), {"rated": "PROMO"})
    return joins.semi(b.ratings(spark, sf_dir), promo, "movie_id").select("user_id", "movie_id", "rating")


@query(
    "j06_hash_join_hint",
    f"WITH {b.RATINGS}, {b.MOVIES} SELECT user_id, movie_id, rating, title FROM ratings JOIN movies USING (movie_id)",
)
def j06(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = joins.hash_join(b.ratings(spark, sf_dir), b.movies(spark, sf_dir), "movie_id", "hash")
    return joined.select("user_id", "movie_id", "rating", "title")


@query(
    "j06_broadcast_join",
    f"WITH {b.USERS}, {b.ZIPS} SELECT user_id, zip_code, state FROM users JOIN zips USING (zip_code)",
)
def j06_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = joins.hash_join(b.users(spark, sf_dir), b.zips(spark, sf_dir), "zip_code", "auto")
    return joined.select("user_id", "zip_code", "state")


@query(
    "j06_bucketed_join",
    f"""WITH {b.RATINGS}, {b.MOVIES} SELECT movie_id, title, count(*) AS n, CAST(sum(rating) AS BIGINT) AS total
        FROM ratings JOIN movies USING (movie_id) GROUP BY movie_id, title""",
)
def j06_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings, movies = b.ratings(spark, sf_dir), b.movies(spark, sf_dir).select("movie_id", "title")
    buckets, names = writers.buckets_for(ratings), []

    def stored(df: DataFrame, name: str) -> DataFrame:
        path = fresh_path(spark, name)
        names.append(path.rsplit("/", 1)[1].replace("-", "_"))
        return writers.write_bucketed(df, names[-1], path, "movie_id", buckets)

    joined = stored(ratings, "ratings-by-movie").join(stored(movies, "movies-by-movie"), "movie_id")
    out = materialize(joined.groupBy("movie_id", "title").agg(F.count(F.lit(1)).alias("n"), F.sum("rating").alias("total")), "by-movie")
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return out


@query(
    "j07_three_way",
    f"""WITH {b.USERS}, {b.ZIPS}, {b.RATINGS}, {b.MOVIES} SELECT user_id, gender, place_name, title, movie_id, rating
        FROM users JOIN zips USING (zip_code) JOIN ratings USING (user_id) JOIN movies USING (movie_id)
        WHERE {b.DISTANCE} <= 50""",
)
def j07(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = predicates.within_km(b.zips(spark, sf_dir), "latitude", "longitude", b.CENTRE, b.RADIUS_KM)
    near_users = joins.join_inner(b.users(spark, sf_dir), near, "zip_code")
    movie_ratings = joins.join_inner(b.ratings(spark, sf_dir), b.movies(spark, sf_dir), "movie_id")
    return joins.join_inner(movie_ratings, near_users, "user_id").select(
        "user_id", "gender", "place_name", "title", "movie_id", "rating"
    )


# ---- top-k, sorting, sets ------------------------------------------------------------------------------


@query(
    "t01_topk",
    f"WITH {b.RATINGS} SELECT movie_id, count(*) AS n FROM ratings GROUP BY movie_id ORDER BY n DESC, movie_id LIMIT 100",
)
def t01(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = facets.facet(b.ratings(spark, sf_dir), "movie_id", [F.count(F.lit(1)).alias("n")])
    return facets.topk(counts, [F.col("n").desc(), F.col("movie_id")], 100)


_USER_BUCKET = _BUCKET.format(seed=7, key="user_id")


@query(
    "t02_sort_sample_page",
    f"""WITH {b.USERS} SELECT user_id, age, gender FROM users WHERE gender = 'M' AND {_USER_BUCKET} < 20
        ORDER BY age, user_id LIMIT 25""",
)
def t02(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = predicates.sample_rows(b.users(spark, sf_dir), "user_id", 20, seed=7).select("user_id", "age", "gender")
    return facets.page(picked, [F.col("age"), F.col("user_id")], 25, where=F.col("gender") == "M")


@query("t03_sort_by_key", f"WITH {b.USERS} SELECT user_id, age, occupation FROM users ORDER BY user_id")
def t03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facets.ordered(b.users(spark, sf_dir).select("user_id", "age", "occupation"), "user_id")


@query("u01_distinct", f"WITH {b.RATINGS}, {b.MOVIES} SELECT DISTINCT rated, rating FROM ratings JOIN movies USING (movie_id)")
def u01(spark: SparkSession, sf_dir: str) -> DataFrame:
    # distinct before the join as well: at most one row per movie and rating goes through it
    pairs = facets.distinct_pairs(b.ratings(spark, sf_dir), "movie_id", "rating")
    return facets.distinct_pairs(pairs.join(b.movies(spark, sf_dir), "movie_id"), "rated", "rating")


@query(
    "u02_intersect",
    f"""WITH {b.RATINGS} SELECT user_id, movie_id FROM ratings WHERE rating >= 4
        INTERSECT SELECT user_id, movie_id FROM ratings WHERE rating <= 2""",
)
def u02(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = b.ratings(spark, sf_dir)
    liked, disliked = r.where("rating >= 4"), r.where("rating <= 2")
    return facets.common_pairs(liked.select("user_id", "movie_id"), disliked.select("user_id", "movie_id"))
