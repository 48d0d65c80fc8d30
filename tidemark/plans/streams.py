"""Streaming queries, run over the given tables until the input is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.scalars import epoch_ms, iso
from tidemark.operators.mapping import Rule
from tidemark.plans import bindings as b
from tidemark.plans.learning import quick_model
from tidemark.plans.registry import query
from tidemark.scratch import fresh_path
from tidemark.streaming import flows, stored


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of its files; it is one file or a folder of them. The path is a pattern, as Spark takes a plain one for a folder."""
    schema = b.table(spark, sf_dir, name).schema
    return flows.read_stream(spark, f"{sf_dir}/{name}[.]parquet", schema, "*")


def _run(spark: SparkSession, df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    out = fresh_path(spark, label)
    run = flows.start_write(df, out, fresh_path(spark, label + "-checkpoint"), partition_by)
    run.awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


RULES = [Rule("text", "body_t", "move"), Rule("source", "source_s", "copy"), Rule("n_chars", operation="delete")]


@query("st01_score_on_arrival")
def st01(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source_s, the_lang_s)."""
    model = quick_model(spark, sf_dir)
    scored = flows.score_stream(_stream(spark, sf_dir, "documents"), RULES, model, ["body_t"], "predicted_label", "the_lang_s")
    return _run(spark, scored, "scored").select("doc_id", "lang", "source_s", "the_lang_s")


@query("st01_score_on_arrival_checked", "SELECT doc_id, lang, source AS source_s, true AS scored FROM documents")
def st01_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.coalesce(F.length("the_lang_s") > 0, F.lit(False))
    return st01(spark, sf_dir).select("doc_id", "lang", "source_s", known.alias("scored"))


@query(
    "st02_time_partition_ingest",
    "SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n, count(*) AS ids FROM events GROUP BY ALL",
)
def st02(spark: SparkSession, sf_dir: str) -> DataFrame:
    # every event arrives twice
    once = _stream(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    twice = once.unionByName(_stream(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type"))
    ingested = flows.ingest_time_partitions(twice, "ts", ["user_id", "event_id"])
    table = _run(spark, ingested, "ingested", "dt")
    per_id = table.groupBy("dt", "id").agg(F.count(F.lit(1)).alias("c"))
    return per_id.groupBy("dt").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("ids"))


@query(
    "st03_stream_sessions",
    f"""WITH {b.LOGS}, gaps AS (SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY clientip ORDER BY ts) AS d FROM logs),
        s AS (SELECT *, sum(CASE WHEN d > 21600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY clientip ORDER BY ts) AS sid FROM gaps),
        closed AS (SELECT clientip, min(ts) AS a, max(ts) AS z, sum(bytes) AS total, count(*) AS n FROM s GROUP BY clientip, sid)
        SELECT clientip, {b.iso_sql('a')} AS session_start, {b.iso_sql('z')} AS session_end, CAST(total AS DOUBLE) AS total_bytes_l,
          n AS total_requests_l FROM closed
        WHERE epoch_us(z) + 21600000000 <= (SELECT max(epoch_us(ts)) // 1000 * 1000 - 600000000 FROM events)""",
)
def st03(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _stream(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("clientip"), "ts", F.col("value").cast("decimal(18,2)").alias("bytes")
    )
    closed = flows.stream_sessions(events, "clientip", "ts", "bytes", gap="6 hours", watermark="10 minutes")
    out = _run(spark, closed, "sessions")
    return out.withColumns(
        {"session_start": iso("session_start"), "session_end": iso("session_end"), "total_bytes_l": F.col("total_bytes_l").cast("double")}
    )


def _arrive(spark: SparkSession, batches: list[DataFrame], label: str, start) -> None:
    """Let batches arrive in a folder one after the other, and run the stream after each."""
    source, mark = fresh_path(spark, f"{label}-source"), fresh_path(spark, f"{label}-checkpoint")
    for batch in batches:
        batch.write.mode("append").parquet(source)
        start(flows.read_stream(spark, source, batch.schema), mark).awaitTermination()


_CHANGES = """changes AS (SELECT o_orderkey, v AS version, CASE v WHEN 1 THEN o_orderstatus ELSE 'V' || v END AS status, o_totalprice * v AS total
    FROM orders, unnest([1, 2, 3]) AS t(v) WHERE v = 1 OR o_orderkey % (3 * v) < 3)"""


@query(
    "st04_stream_upsert",
    f"WITH {_CHANGES} SELECT o_orderkey, version, status, total FROM changes QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) = 1",
)
def st04(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders change over three micro-batches; the last one also brings first versions again, which must not win."""
    orders = b.table(spark, sf_dir, "orders")

    def version(v: int) -> DataFrame:
        rows = orders if v == 1 else orders.where(F.col("o_orderkey") % (3 * v) < 3)
        status = F.col("o_orderstatus") if v == 1 else F.lit(f"V{v}")
        return rows.select("o_orderkey", F.lit(v).alias("version"), status.alias("status"), (F.col("o_totalprice") * v).alias("total"))

    path, again = fresh_path(spark, "upserted"), version(1).where("o_orderkey % 2 = 0")
    batches = [version(1), version(2), version(3).unionByName(again)]
    _arrive(spark, batches, "upsert", lambda stream, mark: stored.upsert_stream(stream, path, mark, "o_orderkey", ["version"], parts=16))
    return stored.read_stored(spark, path, batches[0].schema)


# Thirds of the time line in ms, every 50th event a third late; the watermark lies a sixth of it behind.
_ARRIVALS = f"""{b.LOGS.replace("FROM events", ", event_id FROM events")}, span AS (SELECT min(ms) AS lo, max(ms) - min(ms) + 1 AS len FROM logs),
    arrived AS (SELECT logs.*, least(2, (3 * (ms - lo)) // len + CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END) AS batch, len // 6 AS delay FROM logs, span),
    marks AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM arrived GROUP BY batch),
    taken AS (SELECT a.* FROM arrived a JOIN marks m USING (batch) WHERE m.latest IS NULL OR epoch_us(a.ts) >= epoch_us(m.latest) - delay * 1000)"""


@query(
    "st05_incremental_sessions",
    f"""WITH {_ARRIVALS}, gaps AS (SELECT *, ms - lag(ms) OVER (PARTITION BY clientip ORDER BY ts) AS d FROM taken),
        s AS (SELECT *, sum(CASE WHEN d > 21600000 THEN 1 ELSE 0 END) OVER (PARTITION BY clientip ORDER BY ts) AS sid FROM gaps)
        SELECT clientip, {b.iso_sql('min(ts)')} AS session_start, {b.iso_sql('max(ts)')} AS session_end, CAST(sum(bytes) AS DOUBLE) AS total_bytes_l,
          count(*) AS total_requests_l, epoch_us(max(ts)) // 1000 + 21600000 < (SELECT (max(epoch_us(ts)) - max(delay) * 1000) // 1000 FROM arrived) AS closed
        FROM s GROUP BY clientip, sid""",
)
def st05(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of events, the later ones with late rows inside and beyond the watermark; open and closed sessions."""
    events = b.table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").cast("string").alias("clientip"), "ts", F.col("value").cast("decimal(18,2)").alias("bytes"), epoch_ms("ts").alias("ms")
    )
    low, high = events.agg(F.min("ms"), F.max("ms")).head()
    length = high - low + 1
    late = F.when(F.col("event_id") % 50 == 0, 1).otherwise(0)
    arrived = events.withColumn("batch", F.least(F.lit(2), F.floor((3 * (F.col("ms") - low)) / length) + late))
    batches = [arrived.where(F.col("batch") == i).select("clientip", "ts", "bytes") for i in range(3)]
    path = fresh_path(spark, "sessions-state")
    _arrive(
        spark, batches, "sessions",
        lambda stream, mark: stored.sessions_stream(stream, path, mark, "clientip", "ts", "bytes", gap_ms=21_600_000, delay_ms=length // 6, parts=8),
    )
    kind = stored.session_schema(batches[0], "clientip", "ts", "bytes")
    found = stored.read_stored(spark, path, kind).withColumn("closed", F.lit(False)).unionByName(
        stored.read_emitted(spark, path, kind).withColumn("closed", F.lit(True))
    )
    return found.select(
        "clientip", iso("session_start").alias("session_start"), iso("session_end").alias("session_end"), F.col("total").cast("double").alias("total_bytes_l"),
        F.col("count").alias("total_requests_l"), "closed",
    )


_DAYS = f"""{b.CLICKS}, days AS (SELECT query, item AS doc_id, CAST(ts AS DATE) AS dt, count(*) AS n FROM clicks GROUP BY ALL)"""


def _loaded_clicks(spark: SparkSession, sf_dir: str) -> str:
    """Two loads, the second of all clicks, of which those after the first one's last instant are new."""
    clicks = b.clicks(spark, sf_dir).withColumnRenamed("item", "doc_id")
    path = fresh_path(spark, "click-sums")
    low, high = clicks.agg(F.unix_micros(F.min("ts").cast("timestamp")), F.unix_micros(F.max("ts").cast("timestamp"))).head()
    half = F.unix_micros(F.col("ts").cast("timestamp")) <= (low + high) // 2
    stored.add_clicks(path, 0, clicks.where(half))
    stored.add_clicks(path, 1, clicks)
    return path


@query("a10_click_weight_incremental", f"WITH {_DAYS} SELECT query, doc_id, CAST(sum(n) AS DOUBLE) AS weight FROM days GROUP BY query, doc_id")
def a10_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored.stored_click_weights(spark, _loaded_clicks(spark, sf_dir))


@query(
    "a10_click_weight_decayed",
    f"""WITH {_DAYS} SELECT query, doc_id, round(sum(n * pow(0.5::DOUBLE, date_diff('day', dt, (SELECT max(dt) FROM days)) / 7.0::DOUBLE)), 6) AS weight
        FROM days GROUP BY query, doc_id""",
)
def a10_decayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = stored.stored_click_weights(spark, _loaded_clicks(spark, sf_dir), half_life_days=7)
    return weights.withColumn("weight", F.round("weight", 6))


_PROFILED = ["user_id", "event_type", "value"]


def _stored_profiles(spark: SparkSession, sf_dir: str) -> str:
    """Two loads of events; one day comes in both halves, as the hours of it."""
    events = b.table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    middle = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    path, late = fresh_path(spark, "profiles"), F.coalesce(F.col("ts").cast("timestamp_ntz") >= middle, F.lit(False))
    stored.add_profile(path, 0, events.where(~late), _PROFILED, "day")
    stored.add_profile(path, 1, events.where(late), _PROFILED, "day")
    return path


@query("a11_stored_profile")
def a11_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(column, n, nulls, min, max, distinct, median) from the sketches of all days."""
    return stored.stored_profile(spark, _stored_profiles(spark, sf_dir))


@query(
    "a11_stored_profile_checked",
    """WITH v AS (SELECT 'user_id' AS "column", CAST(user_id AS DOUBLE) AS x, CAST(user_id AS VARCHAR) AS s, strftime(ts, '%Y-%m-%d') AS part FROM events
          UNION ALL SELECT 'event_type', NULL, event_type, strftime(ts, '%Y-%m-%d') FROM events
          UNION ALL SELECT 'value', CAST(value AS DOUBLE), CAST(value AS VARCHAR), strftime(ts, '%Y-%m-%d') FROM events)
        SELECT part, "column", count(*) AS n, count(*) - count(s) AS nulls, min(x) AS min, max(x) AS max, true AS distinct_near, true AS median_near
        FROM v GROUP BY ALL""",
)
def a11_stored_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and bounds per day and column, and whether the estimates are within a tenth of the exact numbers."""
    found = stored.stored_profile(spark, _stored_profiles(spark, sf_dir), by_part=True)
    events = b.table(spark, sf_dir, "events").withColumn("part", F.date_format("ts", "yyyy-MM-dd"))
    exact = events.groupBy("part").agg(*(F.countDistinct(c).alias(f"n_{c}") for c in _PROFILED), *(
        F.percentile(c, F.array(F.lit(0.4), F.lit(0.6))).alias(f"q_{c}") for c in _PROFILED if c != "event_type"
    ))
    none = F.lit(None).cast("array<double>")
    exact = exact.select("part", F.inline(F.array(*(
        F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("exact"), (none if c == "event_type" else F.col(f"q_{c}")).alias("around")) for c in _PROFILED
    ))))
    both = found.join(exact, ["part", "column"])
    return both.select(
        "part", "column", "n", "nulls", "min", "max", (F.abs(F.col("distinct") - F.col("exact")) <= 1 + 0.1 * F.col("exact")).alias("distinct_near"),
        F.coalesce(F.col("median").between(F.col("around")[0], F.col("around")[1]), F.lit(True)).alias("median_near"),
    )
