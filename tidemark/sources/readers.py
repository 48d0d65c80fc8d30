"""Readers: log lines, JSON, delimited text, Parquet, raw files, time partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.functions.types import as_list

# The Common Log Format.
LOG_PATTERN = (
    '^(\\S+) (\\S+) (\\S+) \\[([^\\]]+)\\] "(?:(\\S+) ([^" ]+)(?: HTTP/([0-9.]+))?|([^"]*))" (\\d{3}) (\\d+|-)$'
)
LOG_TIME = "dd/MMM/yyyy:HH:mm:ss Z"
_LOG_GROUPS = {
    "clientip": 1, "ident": 2, "auth": 3, "timestamp": 4, "verb": 5, "request": 6, "httpversion": 7,
    "rawrequest": 8, "response": 9,
}


def parse_access_log(df: DataFrame, line_col: str = "value") -> DataFrame:
    """Add the fields of a Common Log Format line. A broken line keeps null fields and `rejected` true.

    The groups come out of one pass over the line, joined by a control character and cut again.
    """
    line = F.col(line_col)
    mark = "\u0001"
    joined = F.regexp_replace(line, LOG_PATTERN, mark.join(f"${i}" for i in range(1, 11)))
    out = df.withColumn("_parts", F.when(line.rlike(LOG_PATTERN), F.split(joined, mark)))
    fields = {name: F.nullif(F.get("_parts", F.lit(group - 1)), F.lit("")) for name, group in _LOG_GROUPS.items()}
    size = F.get("_parts", F.lit(9))
    return out.withColumns(
        {
            **fields,
            "bytes": F.when(size != "-", size.try_cast("bigint")),
            "ts": F.try_to_timestamp(fields["timestamp"], F.lit(LOG_TIME)),
            "rejected": F.col("_parts").isNull(),
        }
    ).drop("_parts")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines with a declared schema, so no pass over the data is spent on guessing it."""
    return spark.read.schema(schema).json(path)


def read_delimited(
    spark: SparkSession, path: str, sep: str, schema: StructType | str, header: bool = False, quote: str = '"'
) -> DataFrame:
    """Delimited text. Quotes inside a quoted field may be bare: only quote + separator ends the field.

    `quote=""` reads quotes as plain characters, as word lists need it.
    """
    return (
        spark.read.schema(schema)
        .options(sep=sep, header=header, quote=quote, escape='"', unescapedQuoteHandling="STOP_AT_CLOSING_QUOTE")
        .csv(path)
    )


def read_parquet(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_corpus(spark: SparkSession, path: str, encoding: str = "ISO-8859-1", pattern: str = "*") -> DataFrame:
    """Every file below `path` as one row: its path and its decoded text."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    )
    return files.select("path", F.decode("content", encoding).alias("content"))


def explode_signals(df: DataFrame, json_col: str) -> DataFrame:
    """`{query: {signals: [{docId, count}], rank: [...]}}` to one row (query, doc_id, count) per signal."""
    # the outer forms keep Spark from parsing the text once more to see if it is empty
    flat = _signal_entries(df, json_col).select("query", F.inline_outer("entry.signals").alias("doc_id", "count"))
    return flat.where(F.col("doc_id").isNotNull()).select("query", "doc_id", F.col("count").try_cast("int").alias("count"))


def explode_ranks(df: DataFrame, json_col: str) -> DataFrame:
    """The `rank` lists of the same shape: one row (query, doc_id, rank) for each place, from 1."""
    flat = _signal_entries(df, json_col).select("query", F.posexplode_outer("entry.rank").alias("at", "doc_id"))
    return flat.where(F.col("doc_id").isNotNull()).select("query", "doc_id", (F.col("at") + 1).alias("rank"))


def _signal_entries(df: DataFrame, json_col: str) -> DataFrame:
    shape = "map<string,struct<signals:array<struct<docId:string,count:string>>,rank:array<string>>>"
    return df.select(F.explode_outer(F.from_json(json_col, shape)).alias("query", "entry"))


def scan(df: DataFrame, require: str | list[str], fields: list[str], splits: int | None = None) -> DataFrame:
    """Rows that have all `require` columns, cut to `fields`. Both reach the Parquet scan.

    Parallelism follows `spark.sql.files.maxPartitionBytes`; give `splits` only to force a number, as it
    costs a shuffle.
    """
    out = df
    for name in as_list(require):
        out = out.where(F.col(name).isNotNull())
    out = out.select(*fields)
    return out.repartition(splits) if splits else out


def read_time_partitions(
    spark: SparkSession,
    path: str,
    ts: str,
    schema: StructType | str,
    start: str | None = None,
    end: str | None = None,
    period: str = "day",
) -> DataFrame:
    """Read a table written by `write_time_partitions`, all of it or an inclusive range of instants.

    The range is put on the partition column too, so only the folders it touches are listed and read.
    """
    df = spark.read.schema(schema).parquet(path)
    label = partition_format(period)
    if start is not None:
        first = F.lit(start).cast("timestamp")
        df = df.where((F.col("dt") >= F.date_format(first, label)) & (F.col(ts) >= first))
    if end is not None:
        last = F.lit(end).cast("timestamp")
        df = df.where((F.col("dt") <= F.date_format(last, label)) & (F.col(ts) <= last))
    return df


def partition_format(period: str) -> str:
    """Text form of a partition's name; it sorts like time does."""
    formats = {"day": "yyyy-MM-dd", "hour": "yyyy-MM-dd-HH"}
    if period not in formats:
        raise ValueError(f"period must be one of {sorted(formats)}")
    return formats[period]


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """The rows dealt evenly over `partitions` tasks (None: as many as the session runs at once), for costly row work.

    A caller's choice, never made by looking at the size: it pays where few files with few row groups feed
    work that takes much longer than a shuffle, and costs one exchange of the columns that are used.
    """
    return df.repartition(partitions or df.sparkSession.sparkContext.defaultParallelism)
