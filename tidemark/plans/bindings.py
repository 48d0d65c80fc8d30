"""The tables the queries run on, as Spark frames and as the matching SQL view texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sources.readers import spread

# The point and radius of the geo queries.
CENTRE = (44.9609, -93.2642)
RADIUS_KM = 50.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. Its timestamps have no zone; they are read as UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("clientip"), "ts", F.col("event_type").alias("verb"),
        F.col("value").cast("decimal(18,2)").alias("bytes"),
    )


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .where("event_type = 'click'")
        .select(
            "user_id", F.get_json_object("props", "$.k").alias("item"),
            F.concat(F.lit("q"), (F.col("user_id") % 10).cast("string")).alias("query"), "ts",
        )
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("movie_id"),
        (1 + (F.col("l_linenumber") - 1) % 5).alias("rating"), F.col("l_shipdate").alias("rating_timestamp"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("movie_id"), F.col("p_name").alias("title"), F.col("p_type").alias("rated"),
        F.col("p_brand").alias("maker"), F.col("p_size").alias("flags"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), (18 + F.col("c_custkey") % 60).alias("age"),
        F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.col("c_mktsegment").alias("occupation"), F.col("c_nationkey").alias("zip_code"),
    )


def zips(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    step = (F.col("n_nationkey") - 12) * F.lit(0.1)
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_nationkey").alias("zip_code"), F.col("n_name").alias("place_name"), F.col("r_name").alias("state"),
        (F.lit(CENTRE[0]) + step).alias("latitude"), (F.lit(CENTRE[1]) + step).alias("longitude"),
    )


def homes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user at a point near their place."""
    shift = (F.col("user_id") % 100) * F.lit(0.001)
    return users(spark, sf_dir).join(zips(spark, sf_dir), "zip_code").select(
        "user_id", "gender", "place_name", (F.col("latitude") + shift).alias("latitude"),
        (F.col("longitude") + shift).alias("longitude"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for costly work on each text; the given table is one file with one row group, so it is dealt over the tasks: those that
    run at once, or four for each that reads it (32 MB by Spark's defaults), so that a task's share does not grow with the table."""
    docs = documents(spark, sf_dir)
    scans = docs._jdf.queryExecution().toRdd().getNumPartitions()  # a bare scan: nothing runs
    return spread(docs, max(spark.sparkContext.defaultParallelism, 4 * scans))


# The same views as SQL, to be put behind WITH.
LOGS = """logs AS (SELECT CAST(user_id AS VARCHAR) AS clientip, ts, event_type AS verb,
  CAST(value AS DECIMAL(18,2)) AS bytes, epoch_us(ts) // 1000 AS ms FROM events)"""
CLICKS = """clicks AS (SELECT user_id, json_extract_string(props, '$.k') AS item,
  'q' || CAST(user_id % 10 AS VARCHAR) AS query, ts FROM events WHERE event_type = 'click')"""
RATINGS = """ratings AS (SELECT o_custkey AS user_id, l_partkey AS movie_id, 1 + (l_linenumber - 1) % 5 AS rating,
  l_shipdate AS rating_timestamp FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
MOVIES = """movies AS (SELECT p_partkey AS movie_id, p_name AS title, p_type AS rated, p_brand AS maker,
  p_size AS flags FROM part)"""
USERS = """users AS (SELECT c_custkey AS user_id, 18 + c_custkey % 60 AS age,
  CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, c_mktsegment AS occupation,
  c_nationkey AS zip_code FROM customer)"""
ZIPS = """zips AS (SELECT n_nationkey AS zip_code, n_name AS place_name, r_name AS state,
  CAST(44.9609 AS DOUBLE) + (n_nationkey - 12) * CAST(0.1 AS DOUBLE) AS latitude,
  CAST(-93.2642 AS DOUBLE) + (n_nationkey - 12) * CAST(0.1 AS DOUBLE) AS longitude
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""
HOMES = f"""{USERS}, {ZIPS}, homes AS (SELECT user_id, gender, place_name,
  latitude + (user_id % 100) * CAST(0.001 AS DOUBLE) AS latitude,
  longitude + (user_id % 100) * CAST(0.001 AS DOUBLE) AS longitude FROM users JOIN zips USING (zip_code))"""
DISTANCE = """2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(latitude - 44.9609) / 2), 2)
  + cos(radians(latitude)) * cos(radians(44.9609)) * pow(sin(radians(longitude + 93.2642) / 2), 2))))"""
ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S') || '.' || lpad(CAST((epoch_us({0}) // 1000) % 1000 AS VARCHAR), 3, '0') || 'Z'"


def iso_sql(column: str) -> str:
    return ISO.format(column)


TOKENS = "[x FOR x IN regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{N}}]+') IF x <> '']"


def tokens_sql(column: str) -> str:
    return TOKENS.format(column)
