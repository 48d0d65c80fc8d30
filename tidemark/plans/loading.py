"""Sources, sinks and load control: each query writes what it reads from the given tables and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.functions.scalars import iso, split_list
from tidemark.operators.mapping import Rule, Stage, map_fields, regex_extract, run_stages, suffix_names
from tidemark.plans import bindings as b
from tidemark.plans.registry import query
from tidemark.scratch import fresh_path
from tidemark.sources import readers, sink, writers
from tidemark.sources.jobs import LoadSpec, bulk_load

_EVENT_SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props struct<k:int>"


# ---- sources -------------------------------------------------------------------------------------------


@query(
    "s01_log_parse",
    """SELECT event_id, event_type = 'signup' AS rejected,
        CASE WHEN event_type <> 'signup' THEN '10.0.' || (user_id // 256) || '.' || (user_id % 256) END AS clientip,
        CASE WHEN event_type <> 'signup' THEN 'GET' END AS verb,
        CASE WHEN event_type <> 'signup' THEN '/' || event_type || '/' || json_extract_string(props, '$.k') END AS request,
        CASE WHEN event_type <> 'signup' THEN '1.1' END AS httpversion,
        CASE event_type WHEN 'signup' THEN NULL WHEN 'error' THEN '500' ELSE '200' END AS response,
        CASE WHEN event_type NOT IN ('signup', 'error') THEN CAST(round(value * 100) AS BIGINT) END AS bytes,
        CASE WHEN event_type <> 'signup' THEN epoch_us(ts) // 1000000 END AS seconds FROM events""",
)
def s01(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    ip = F.concat(F.lit("10.0."), F.expr("user_id div 256").cast("string"), F.lit("."), (F.col("user_id") % 256).cast("string"))
    size = F.when(kind == "error", "-").otherwise(F.round(F.col("value") * 100).cast("bigint").cast("string"))
    line = F.concat(
        ip, F.lit(" - - ["), F.date_format(F.col("ts").cast("timestamp"), "dd/MMM/yyyy:HH:mm:ss"), F.lit(' +0000] "GET /'),
        kind, F.lit("/"), F.get_json_object("props", "$.k"), F.lit(' HTTP/1.1" '), F.when(kind == "error", "500").otherwise("200"),
        F.lit(" "), size,
    )
    broken = F.lit("connection reset by peer")
    path = fresh_path(spark, "access-log")
    lines = b.table(spark, sf_dir, "events").select(
        F.concat(F.col("event_id").cast("string"), F.lit("\t"), F.when(kind == "signup", broken).otherwise(line))
    )
    lines.write.text(path)
    raw = readers.read_lines(spark, path).select(
        F.substring_index("value", "\t", 1).cast("bigint").alias("event_id"),
        F.substring_index("value", "\t", -1).alias("line"),
    )
    parsed = readers.parse_access_log(raw, "line")
    return parsed.select(
        "event_id", "rejected", "clientip", "verb", "request", "httpversion", "response", "bytes",
        F.unix_seconds("ts").alias("seconds"),
    )


@query(
    "s02_json_scan",
    f"""SELECT event_id, {b.iso_sql('ts')} AS ts, user_id, event_type, value,
        CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
)
def s02(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "json")
    events = b.table(spark, sf_dir, "events")
    events.withColumn("ts", iso("ts")).withColumn("props", F.from_json("props", "k int")).write.json(path)
    back = readers.read_json(spark, path, _EVENT_SCHEMA)
    return back.select("event_id", iso("ts").alias("ts"), "user_id", "event_type", "value", F.col("props.k").alias("k"))


@query(
    "s03_nested_explode",
    """SELECT query, doc_id, count(*) AS rows, CAST(sum(c) AS BIGINT) AS total FROM (
          SELECT 'q' || (user_id % 10) AS query, 'd' || json_extract_string(props, '$.k') AS doc_id, event_id % 7 + 1 AS c FROM events
          UNION ALL SELECT 'q' || (user_id % 10), 'u' || user_id, event_id % 5 FROM events)
        GROUP BY query, doc_id""",
)
def s03(spark: SparkSession, sf_dir: str) -> DataFrame:
    signal = "struct<docId:string,count:string>"
    events = b.table(spark, sf_dir, "events")
    first = F.struct(
        F.concat(F.lit("d"), F.get_json_object("props", "$.k")).alias("docId"),
        (F.col("event_id") % 7 + 1).cast("string").alias("count"),
    ).cast(signal)
    second = F.struct(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("docId"), (F.col("event_id") % 5).cast("string").alias("count")
    ).cast(signal)
    entry = F.struct(F.array(first, second).alias("signals"), F.array(first["docId"]).alias("rank"))
    name = F.concat(F.lit("q"), (F.col("user_id") % 10).cast("string"))
    path = fresh_path(spark, "signals")
    events.select(F.to_json(F.create_map(name, entry))).write.text(path)
    flat = readers.explode_signals(readers.read_lines(spark, path), "value")
    return flat.groupBy("query", "doc_id").agg(F.count(F.lit(1)).alias("rows"), F.sum("count").alias("total"))


_CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def _delimited(spark: SparkSession, sf_dir: str, sep: str) -> DataFrame:
    path = fresh_path(spark, "delimited")
    b.table(spark, sf_dir, "customer").write.option("sep", sep).csv(path)
    return readers.read_delimited(spark, path, sep, _CUSTOMER)


@query("s04_csv_delim", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _delimited(spark, sf_dir, "|")


@query("s04_csv_delim_tab", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s04_tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _delimited(spark, sf_dir, "\t")


@query(
    "s05_csv_header",
    """SELECT p_partkey AS part_id, p_name || ' 32" wide, ' || p_type AS title, p_brand || ' "new"' AS maker_name FROM part""",
)
def s05(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "csv-header")
    # quoted by hand, so that the quotes inside a field stay bare
    quoted = b.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("Part Id"),
        F.concat(F.lit('"'), F.col("p_name"), F.lit(' 32" wide, '), F.col("p_type"), F.lit('"')).alias("Title"),
        F.concat(F.lit('"'), F.col("p_brand"), F.lit(' "new""')).alias("Maker Name"),
    )
    plain = quoted.select(F.concat_ws(",", F.col("Part Id").cast("string"), "Title", "Maker Name").alias("Part Id,Title,Maker Name"))
    plain.write.options(header=True, quote="", sep="\u0001", escapeQuotes=False).csv(path)
    schema = StructType().add("Part Id", "long").add("Title", "string").add("Maker Name", "string")
    back = readers.read_delimited(spark, path, ",", schema, header=True)
    return back.select(
        F.col("`Part Id`").alias("part_id"), F.col("Title").alias("title"), F.col("`Maker Name`").alias("maker_name")
    )


@query("s06_parquet_scan", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity >= 49")
def s06(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = readers.read_parquet(spark, f"{sf_dir}/lineitem.parquet")
    return lines.where("l_quantity >= 49").select("l_orderkey", "l_partkey", "l_quantity")


@query(
    "s07_binary_corpus",
    """SELECT lang, count(*) AS documents, CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes,
        CAST(sum(len(text) - len(replace(text, chr(10), '')) + 1) AS BIGINT) AS lines FROM documents GROUP BY lang""",
)
def s07(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "corpus")
    docs = b.documents(spark, sf_dir).select("lang", F.concat("text", F.lit("\n\u0004")).alias("value"))
    # files of at most 200 documents, so that no file grows with the table
    docs.write.partitionBy("lang").options(maxRecordsPerFile=200, lineSep="\n").text(path)
    files = readers.read_corpus(spark, path, "ISO-8859-1", "*.txt")
    # one byte is one character in this encoding; \u0004 and its line end mark where a document stops
    marks = F.length("content") - F.length(F.replace("content", F.lit("\u0004"), F.lit("")))
    ends = F.length("content") - F.length(F.replace("content", F.lit("\n"), F.lit("")))
    return (
        files.select(F.regexp_extract("path", "lang=([^/]+)/", 1).alias("lang"), marks.alias("m"), ends.alias("e"), F.length("content").alias("c"))
        .groupBy("lang")
        .agg(
            F.sum("m").alias("documents"), (F.sum("c") - 2 * F.sum("m")).alias("bytes"), (F.sum("e") - F.sum("m")).alias("lines")
        )
    )


@query(
    "s08_filtered_scan",
    """SELECT event_id, user_id, kind, value FROM (SELECT *, CASE WHEN value >= 5 THEN event_type END AS kind FROM events)
        WHERE kind IS NOT NULL AND user_id IS NOT NULL""",
)
def s08(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = b.table(spark, sf_dir, "events").withColumn("kind", F.when(F.col("value") >= 5, F.col("event_type")))
    return readers.scan(events, ["kind", "user_id"], ["event_id", "user_id", "kind", "value"])


_RANGE = ("2024-01-10 06:00:00", "2024-01-12 18:00:00")


@query(
    "s09_time_range_scan",
    f"""SELECT event_id, {b.iso_sql('ts')} AS ts, event_type, strftime(ts, '%Y-%m-%d') AS dt FROM events
        WHERE ts BETWEEN '{_RANGE[0]}' AND '{_RANGE[1]}'""",
)
def s09(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "by-day")
    events = b.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    writers.write_time_partitions(events, path, "ts")
    back = readers.read_time_partitions(spark, path, "ts", events.schema.add("dt", "string"), *_RANGE)
    return back.select("event_id", iso("ts").alias("ts"), "event_type", "dt")


# ---- sinks and load control ----------------------------------------------------------------------------


@query("k01_overwrite", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def k01(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "overwrite")
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    writers.write_table(orders.where("o_orderstatus <> 'F'"), path)
    writers.write_table(orders.where("o_orderstatus = 'F'"), path)
    return writers.read_back(spark, path, orders.schema).drop("o_orderstatus")


_UPSERT_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


@query(
    "k02_keyed_upsert",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_linestatus, {b.iso_sql('l_shipdate')} AS l_shipdate
        FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
        l_suppkey DESC, l_extendedprice DESC, l_linestatus DESC) = 1""",
)
def k02(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches into a stored table; the second holds a few keys only, so few of its parts are written again."""
    lines = b.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_linestatus", "l_shipdate"
    )
    path, key = fresh_path(spark, "upserts"), ["l_orderkey", "l_linenumber"]
    few = F.col("l_orderkey") % 100 == 0
    order = [*_UPSERT_ORDER, "l_linestatus"]
    for batch in (lines.where("l_linestatus = 'F'"), lines.where("l_linestatus <> 'F'").where(few), lines.where("l_linestatus <> 'F'").where(~few)):
        writers.upsert_table(path, batch, key, order, parts=16)
    return writers.read_upserted(spark, path, lines.schema).withColumn("l_shipdate", iso("l_shipdate"))


@query("k03_batched_write", "SELECT count(*) AS n, true AS all_within_batch FROM lineitem")
def k03(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "batches")
    lines = b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    writers.write_batched(lines, path, 5_000)
    files = spark.read.schema(lines.schema).parquet(path).groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("c"))
    return files.agg(F.sum("c").alias("n"), (F.max("c") <= 5_000).alias("all_within_batch"))


@query(
    "k03_batch_sink",
    """SELECT l_returnflag, count(*) AS n, sum(l_orderkey) AS keys, true AS within_batch FROM lineitem GROUP BY l_returnflag""",
)
def k03_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines handed over in batches by the registered sink, two writes, the first of which the second replaces; read back."""
    path = fresh_path(spark, "sink")
    lines = b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag")
    sink.write_in_batches(lines.where("l_returnflag = 'R'"), path, 500)
    sink.write_in_batches(lines, path, 5_000, mode="overwrite")
    rows = spark.read.schema("l_orderkey long, l_returnflag string").json(path, recursiveFileLookup=True)
    batches = rows.withColumn("file", F.col("_metadata.file_path")).groupBy("l_returnflag", "file").agg(F.count(F.lit(1)).alias("c"), F.sum("l_orderkey").alias("k"))
    return batches.groupBy("l_returnflag").agg(F.sum("c").alias("n"), F.sum("k").alias("keys"), (F.max("c") <= 5_000).alias("within_batch"))


@query("k04_output_partitions", "SELECT count(*) AS n, CAST(24 AS BIGINT) AS partitions FROM lineitem")
def k04(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "spread")
    lines = b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    writers.write_table(writers.with_output_partitions(lines, 24), path)
    files = spark.read.schema(lines.schema).parquet(path).groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("c"))
    return files.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("partitions"))


@query(
    "k05_clear_or_append",
    """SELECT 'a' AS data_source, o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY ALL
        UNION ALL SELECT 'b', o_orderstatus, count(*) FROM orders WHERE o_orderstatus IN ('O', 'F') GROUP BY ALL""",
)
def k05(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "sources")
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    for status, source, clear in [("F", "a", True), ("O", "b", True), ("P", "a", True), ("F", "b", False)]:
        writers.load(orders.where(F.col("o_orderstatus") == status), path, source, clear)
    back = spark.read.schema(orders.schema.add("data_source", "string")).parquet(path)
    return back.groupBy("data_source", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


_CONTRACT = StructType().add("event_id", "string").add("value", "integer").add("event_type", "string").add("props", "long").add("note", "string")


@query(
    "k06_schema_contract",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(trunc(value) AS INTEGER) AS value, event_type, CAST(NULL AS BIGINT) AS props,
        CAST(NULL AS VARCHAR) AS note, 1 AS rejected_fields FROM events""",
)
def k06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.enforce_schema(b.table(spark, sf_dir, "events"), _CONTRACT)


@query(
    "k07_time_partition_retention",
    """SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n FROM events WHERE strftime(ts, '%Y-%m-%d') IN
        (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS d FROM events ORDER BY d DESC LIMIT 10) GROUP BY ALL""",
)
def k07(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "retention")
    events = b.table(spark, sf_dir, "events").select("event_id", "ts")
    # two runs; the second pushes days out that the first has stored
    for run in (F.col("event_id") % 3 == 0, F.col("event_id") % 3 != 0):
        writers.write_time_partitions(events.where(run), path, "ts", max_active=10, mode="append", delete_expired=True)
    back = spark.read.schema(events.schema.add("dt", "string")).parquet(path)
    return back.groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


@query(
    "k07_hour_partitions",
    "SELECT strftime(ts, '%Y-%m-%d-%H') AS dt, count(*) AS n FROM events GROUP BY ALL",
)
def k07_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "hours")
    events = b.table(spark, sf_dir, "events").select("event_id", "ts")
    writers.write_time_partitions(events, path, "ts", period="hour")
    back = spark.read.schema(events.schema.add("dt", "string")).parquet(path)
    return back.groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


@query(
    "k09_bulk_load_job",
    """SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS title, p_type || ',' || p_brand AS genre, 2 AS genres,
        p_retailprice AS price, 'parts' AS data_source FROM part""",
)
def k09(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "bulk-in")
    parts = b.table(spark, sf_dir, "part")
    parts.select(
        "p_partkey", "p_name", F.concat_ws("|", "p_type", "p_brand").alias("genres"), "p_retailprice"
    ).write.option("header", True).csv(path)
    spec = LoadSpec(
        source="parts", format="csv", path=path, schema="partId string, title string, genres string, price double",
        read_options={"header": "true"}, transform=lambda df: df.withColumn("genre", split_list("genres", "|")).drop("genres"),
        sql="select partId as id, title, genre, size(genre) as genres, price from _input", output_partitions=8, batch_size=5_000,
        output=fresh_path(spark, "bulk-out"),
    )
    return bulk_load(spark, spec).withColumn("genre", F.array_join("genre", ","))


@query(
    "k10_load_pipeline",
    """SELECT page_id AS page_id_l, CASE WHEN len(url) <= 100 THEN url END AS path_s, url AS path_t,
        nullif(regexp_extract(url, '^https?://[^/]+/(?:.+/)*([^/]+)/([^/]+)$', 1), '') AS folder_s, CAST(len(html) AS INTEGER) AS size_i FROM pages""",
)
def k10(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = b.table(spark, sf_dir, "pages").withColumn("size", F.length("html"))
    stages = [
        Stage("folder", lambda df: regex_extract(df, "url", "^https?://[^/]+/(?:.+/)*([^/]+)/([^/]+)$", 1, "folder_s")),
        Stage("log", lambda df: df.limit(0), skip=True),
        Stage("fields", lambda df: map_fields(df, [Rule("url", "path", "move"), Rule("html", operation="delete")])),
        Stage("names", suffix_names),
    ]
    return run_stages(pages, stages)
