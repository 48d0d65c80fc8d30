"""Projection, field mapping and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import scalars as s
from tidemark.functions.dates import normalize_date
from tidemark.operators import mapping
from tidemark.operators.mapping import Rule
from tidemark.plans import bindings as b
from tidemark.plans.registry import query

# Names of the flags of a row, in the order of their bits.
FLAGS = [
    "boxed", "bulk", "coated", "cold", "custom", "export", "fragile", "heavy", "import", "large", "light", "liquid", "matte", "new",
    "polished", "rare", "sealed", "small", "used",
]


_SECOND = "CAST(date_trunc('second', ts) AS TIMESTAMP)"


@query("p01_rename_select", "SELECT c_custkey AS user_id, c_name AS name, c_nationkey AS zip_code, c_mktsegment AS occupation FROM customer")
def p01(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = b.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment").toDF("_c0", "_c1", "_c2", "_c3")
    return mapping.rename_select(raw, ["user_id", "name", "zip_code", "occupation"])


@query(
    "p02_add_drop_rename",
    f"WITH {b.RATINGS} SELECT user_id AS \"userId\", movie_id, rating, rating * 2 AS stars, {b.iso_sql('rating_timestamp')} AS timestamp_tdt FROM ratings",
)
def p02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.reshape(
        b.ratings(spark, sf_dir),
        add={"timestamp_tdt": s.iso("rating_timestamp"), "stars": F.col("rating") * 2},
        drop=["rating_timestamp"], rename={"user_id": "userId"},
    )


@query(
    "p03_cast_to_int",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(trunc(l_extendedprice) AS INTEGER) AS price, CAST(trunc(l_quantity) AS INTEGER) AS quantity,
        CAST(NULL AS INTEGER) AS flag FROM lineitem""",
)
def p03(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("l_extendedprice").cast("string")
    return b.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", s.to_int(text).alias("price"),
        s.to_int(F.col("l_quantity").cast("string")).alias("quantity"), s.to_int("l_returnflag").alias("flag"),
    )


@query("p04_epoch_to_ts", f"SELECT event_id, {b.iso_sql(_SECOND)} AS moment FROM events")
def p04(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")
    return b.table(spark, sf_dir, "events").select("event_id", s.iso(s.secs_to_ts(seconds)).alias("moment"))


@query("p05_ms_to_iso", f"SELECT event_id, {b.iso_sql('ts')} AS moment FROM events")
def p05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "events").select("event_id", s.ms_to_iso(s.epoch_ms("ts")).alias("moment"))


@query(
    "p06_composite_id",
    """SELECT concat_ws('-', CAST(user_id AS VARCHAR), CASE WHEN event_type <> 'view' THEN event_type END,
        CAST(epoch_us(ts) // 1000 AS VARCHAR)) AS id, event_id FROM events""",
)
def p06(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") != "view", F.col("event_type"))
    return b.table(spark, sf_dir, "events").select(s.make_id(["user_id", kind, s.epoch_ms("ts")], "-").alias("id"), "event_id")


@query("p07_row_id", "SELECT count(*) AS n, count(*) AS ids FROM lineitem")
def p07(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = mapping.with_row_id(b.table(spark, sf_dir, "lineitem").select("l_orderkey"))
    # repeats per id are counted, not the distinct ids, so the check stays a plain grouped count
    per_id = numbered.groupBy("id").agg(F.count(F.lit(1)).alias("c"))
    return per_id.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("ids"))


@query(
    "p08_regex_extract",
    """SELECT page_id, nullif(regexp_extract(url, '^https?://[^/]+/(?:.+/)*([^/]+)/([^/]+)$', 1), '') AS folder_s,
        CASE WHEN regexp_matches(url, '[?&]page=([0-9]+)') THEN regexp_extract(url, '[?&]page=([0-9]+)', 1) ELSE 'none' END AS page_s FROM pages""",
)
def p08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "pages").select(
        "page_id", s.regex_group("url", "^https?://[^/]+/(?:.+/)*([^/]+)/([^/]+)$", 1).alias("folder_s"),
        s.regex_group("url", "[?&]page=([0-9]+)", 1, on_no_match="none").alias("page_s"),
    )


# a visit: some fields at the top, some below `details`, and a visitor under one of two names
def _visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.col("event_id") % 2 == 0
    user = F.col("user_id").cast("string")
    return b.table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("kind"),
        s.epoch_ms("ts").alias("seen"), F.lit("run 1").alias("internal_run"),
        F.struct(
            F.when(even, user).alias("visitor"), F.when(~even, user).alias("guest"),
            F.get_json_object("props", "$.k").alias("shown"), F.col("value").cast("decimal(18,2)").cast("string").alias("amount"),
            F.concat(F.lit("q"), (F.col("user_id") % 10).cast("string")).alias("asked"), F.lit("web").alias("sent_by"),
            F.col("event_type").alias("section"),
        ).alias("details"),
    )


RULES = [
    Rule("/^internal_/", operation="delete"),
    Rule("kind", "kind_s", "copy"),
    Rule("seen", "seen_tdt", "move"),
    Rule("details.asked", "asked_s", "copy"),
    Rule("details.asked", "asked_t", "move"),
    Rule("details.shown", "shown_s", "move"),
    Rule("details.visitor", "person_s", "move"),
    Rule("details.guest", "person_s", "move"),
    Rule("event_id", "event_id", "keep"),
    Rule("/^details[.]([a-z]+)$/", "visit.$1_s", "move"),
]


@query(
    "p09_field_mapping",
    """SELECT event_id, CASE WHEN event_type <> 'view' THEN event_type END AS kind_s, epoch_us(ts) // 1000 AS seen_tdt,
        'q' || (user_id % 10) AS asked_s, 'q' || (user_id % 10) AS asked_t, json_extract_string(props, '$.k') AS shown_s,
        CAST(user_id AS VARCHAR) AS person_s, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS "visit.amount_s",
        event_type AS "visit.section_s", CASE WHEN event_type <> 'view' THEN event_type END AS kind FROM events""",
)
def p09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.map_fields(_visits(spark, sf_dir), RULES, unmapped=Rule("/./", operation="delete"))


PLACE_RULES = [Rule("/^([a-z]+)_north$/", "$1_lat_lon", "move"), Rule("/^([a-z]+)_east$/", "$1_lat_lon", "move")]


@query(
    "p09_geo_fields",
    f"WITH {b.HOMES} SELECT user_id, CAST(round(latitude, 3) AS VARCHAR) || ',' || CAST(round(longitude, 3) AS VARCHAR) AS home_lat_lon FROM homes",
)
def p09_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    homes = b.homes(spark, sf_dir).select(
        "user_id", F.round("latitude", 3).alias("home_north"), F.round("longitude", 3).alias("home_east")
    )
    mapped = mapping.map_fields(homes, PLACE_RULES)
    return mapped.withColumn("home_lat_lon", F.array_join(F.col("home_lat_lon").cast("array<string>"), ","))


@query(
    "p10_type_suffix_names",
    f"""SELECT event_id AS event_id_l, {b.iso_sql('ts')} AS ts_tdt, user_id AS user_id_l, event_type AS event_type_s, event_type AS event_type_t,
        value AS value_d, CASE WHEN len(body) <= 100 THEN body END AS body_s, body AS body_t, 'x' AS known_s
        FROM (SELECT *, repeat(event_type, CAST(user_id % 30 AS INTEGER)) AS body FROM events)""",
)
def p10(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = b.table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.repeat("event_type", (F.col("user_id") % 30).cast("int")).alias("body"), F.lit("x").alias("known_s"),
    )
    return mapping.suffix_names(events).withColumn("ts_tdt", s.iso("ts_tdt"))


@query(
    "p11_signal_format",
    """SELECT event_id, kind AS type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM
        (SELECT *, CASE WHEN event_type = 'view' THEN 'general' ELSE event_type END AS kind FROM events)
        WHERE kind IN ('general', 'click', 'purchase')""",
)
def p11(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = b.table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("type"), F.col("props").alias("params")
    )
    return mapping.format_signals(events, params_schema="k int", allowed_types=["general", "click", "purchase"])


@query(
    "p12_conditional_enrich",
    """SELECT event_id, CASE WHEN song IS NOT NULL THEN 'click' END AS type_s, CASE WHEN song IS NOT NULL THEN event_type || '-' || song END AS doc_id_s
        FROM (SELECT *, CASE WHEN event_id % 3 > 0 THEN json_extract_string(props, '$.k') END AS song FROM events)""",
)
def p12(spark: SparkSession, sf_dir: str) -> DataFrame:
    song = F.when(F.col("event_id") % 3 > 0, F.get_json_object("props", "$.k"))
    events = b.table(spark, sf_dir, "events").withColumn("song", song)
    return mapping.mark_clicks(events, "song", "event_type").select("event_id", "type_s", "doc_id_s")


@query(
    "p13_sparse_pairs",
    f"""SELECT event_id, name, value FROM (
          SELECT event_id, 'ts' AS name, {b.iso_sql('ts')} AS value FROM events
          UNION ALL SELECT event_id, 'user_id', CAST(user_id AS VARCHAR) FROM events
          UNION ALL SELECT event_id, 'event_type', CASE WHEN event_type <> 'view' THEN event_type END FROM events) WHERE value IS NOT NULL""",
)
def p13(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = b.table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("event_type")
    )
    return events.select("event_id", F.inline(mapping.to_pairs(events, exclude=["event_id"])))


@query(
    "p14_json_field_parse",
    """SELECT event_id, json_extract_string(props, '$.k') AS location, event_type AS person, CAST(NULL AS VARCHAR) AS organization FROM events""",
)
def p14(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    tagged = F.to_json(F.create_map(F.lit("LOC"), F.array(k, k), F.lit("PER"), F.array(F.col("event_type"))))
    events = b.table(spark, sf_dir, "events").select("event_id", tagged.alias("ner_json"))
    parsed = mapping.parse_json_field(events, "ner_json", {"LOC": "location", "PER": "person", "ORG": "organization"})
    return parsed.select(
        "event_id", F.col("location")[1].alias("location"), F.array_join("person", ",").alias("person"),
        F.array_join("organization", ",").alias("organization"),
    )


_FLAG = "CASE WHEN (flags >> {i}) & 1 = 1 THEN '{g}' END"


@query(
    "p15_flags_to_labels",
    f"WITH {b.MOVIES} SELECT movie_id, concat_ws(',', "
    + ", ".join(_FLAG.format(i=i, g=g) for i, g in enumerate(FLAGS))
    + ") AS genre, CAST(bit_count(flags & 524287) AS INTEGER) AS n FROM movies",
)
def p15(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = [F.getbit(F.col("flags"), F.lit(i)).cast("string") for i in range(len(FLAGS))]
    genre = s.flags_to_array(flags, FLAGS)
    return b.movies(spark, sf_dir).select("movie_id", F.array_join(genre, ",").alias("genre"), F.size(genre).alias("n"))


@query(
    "p16_split_to_list",
    """SELECT p_partkey, p_name || '+' || p_type || '+' || p_brand AS items, 3 AS n FROM part""",
)
def p16(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = F.concat("p_name", F.lit(", "), "p_type", F.lit(","), "p_brand", F.lit(",,"))
    items = s.split_list(joined)
    return b.table(spark, sf_dir, "part").select("p_partkey", F.array_join(items, "+").alias("items"), F.size(items).alias("n"))


@query(
    "p17_geo_point",
    f"WITH {b.HOMES} SELECT user_id, CAST(round(latitude, 3) AS DECIMAL(9,3)) || ',' || CAST(round(longitude, 3) AS DECIMAL(9,3)) AS geo_point FROM homes",
)
def p17(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat, lon = (F.round(F.col(c), 3).cast("decimal(9,3)") for c in ("latitude", "longitude"))
    return b.homes(spark, sf_dir).select("user_id", s.geo_point(lat, lon).alias("geo_point"))


@query(
    "p18_relabel",
    f"""WITH {b.RATINGS} SELECT user_id, movie_id, CASE rating WHEN 5 THEN 'excellent' WHEN 4 THEN 'good' WHEN 3 THEN 'avg' WHEN 2 THEN 'poor'
        ELSE CAST(rating AS VARCHAR) END AS label FROM ratings""",
)
def p18(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = s.relabel("rating", {5: "excellent", 4: "good", 3: "avg", 2: "poor"})
    return b.ratings(spark, sf_dir).select("user_id", "movie_id", label.alias("label"))


# ---- scalar functions ----------------------------------------------------------------------------------


@query(
    "scalar_time",
    f"""SELECT event_id, epoch_us(ts) // 1000 AS ms, {b.iso_sql('ts')} AS iso, strftime(ts, '%Y-%m-%d') AS day,
        (epoch_us(ts) + 4 * 3600000000) // 1000 AS from_local_ms FROM events""",
)
def scalar_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("ts").cast("timestamp")
    # the same wall clock four hours west of Greenwich, written out and parsed back
    text = F.date_format(at, "dd MMM yyyy HH:mm:ss")
    parsed = normalize_date(F.concat(text, F.lit(" -0400")))
    return b.table(spark, sf_dir, "events").select(
        "event_id", s.epoch_ms("ts").alias("ms"), s.iso("ts").alias("iso"), F.date_format(at, "yyyy-MM-dd").alias("day"),
        (F.unix_millis(parsed) + s.epoch_ms("ts") % 1000).alias("from_local_ms"),
    )


@query(
    "scalar_text",
    """SELECT p_partkey, CASE WHEN p_size > 25 THEN 'big' ELSE 'small' END AS size_word, concat_ws('/', p_type, p_brand) AS path,
        p_name || ':' || p_brand AS both_parts, replace(p_name, ' ', '_') AS joined, regexp_replace(p_name, '[aeiou]', '*', 'g') AS no_vowels,
        regexp_replace(p_name, '[aeiou]', '*') AS first_vowel, upper(trim('  ' || p_name || ' ')) AS loud, lower(p_type) AS quiet,
        len(p_name) > 9 AS long_name FROM part""",
)
def scalar_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("p_name")
    return b.table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_size") > 25, "big").otherwise("small").alias("size_word"),
        F.concat_ws("/", "p_type", "p_brand").alias("path"), F.concat(name, F.lit(":"), "p_brand").alias("both_parts"),
        F.replace(name, F.lit(" "), F.lit("_")).alias("joined"), F.regexp_replace(name, "[aeiou]", "*").alias("no_vowels"),
        F.regexp_replace(name, "^([^aeiou]*)[aeiou]", "$1*").alias("first_vowel"),
        F.upper(F.trim(F.concat(F.lit("  "), name, F.lit(" ")))).alias("loud"), F.lower("p_type").alias("quiet"),
        (F.length(name) > 9).alias("long_name"),
    )


@query(
    "scalar_regex",
    """SELECT page_id, regexp_extract(url, '//([^/]+)/', 1) AS host, array_to_string(regexp_extract_all(url, '[0-9]+'), ',') AS numbers,
        array_to_string(regexp_split_to_array(url, '[/?#]+'), ' ') AS parts FROM pages""",
)
def scalar_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("url", "//([^/]+)/", 1).alias("host"),
        F.array_join(F.regexp_extract_all("url", F.lit("[0-9]+"), 0), ",").alias("numbers"),
        F.array_join(F.split("url", "[/?#]+"), " ").alias("parts"),
    )


@query(
    "scalar_lists",
    """SELECT event_id, 'kind=' || event_type || '|k=' || json_extract_string(props, '$.k') || '|other=none' AS found,
        '{"k":' || json_extract_string(props, '$.k') || ',"type":"' || event_type || '"}' AS as_json, event_type || '+x+y' AS flat FROM events""",
)
def scalar_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.from_json("props", "map<string,string>")
    lookup = F.coalesce(F.try_element_at(k, F.lit("missing")), F.lit("none"))
    typed = F.from_json("props", "k int")
    return b.table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("kind="), "event_type", F.lit("|k="), F.try_element_at(k, F.lit("k")), F.lit("|other="), lookup).alias("found"),
        F.to_json(F.struct(typed["k"].alias("k"), F.col("event_type").alias("type"))).alias("as_json"),
        F.array_join(F.flatten(F.array(F.array("event_type"), F.array(F.lit("x"), F.lit("y")))), "+").alias("flat"),
    )


@query(
    "scalar_math",
    """SELECT p_partkey, CASE WHEN p_size + k > 0 THEN round(2.0 * p_size * k / (p_size + k), 6) END AS mean, round(1 - p_size / 50.0::DOUBLE, 6) AS rest,
        CASE WHEN k <> 0 THEN round(CAST(p_size AS DOUBLE) / k, 6) END AS ratio FROM (SELECT *, p_partkey % 5 AS k FROM part)""",
)
def scalar_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, k = F.col("p_size"), F.col("p_partkey") % 5
    return b.table(spark, sf_dir, "part").select(
        "p_partkey", F.round(s.safe_ratio(2 * size * k, size + k), 6).alias("mean"),
        F.round(1 - size / F.lit(50.0), 6).alias("rest"), F.round(s.safe_ratio(size, k), 6).alias("ratio"),
    )
