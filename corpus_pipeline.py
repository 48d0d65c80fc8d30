"""From raw documents to token ids: toxicity, near duplicates, repeated passages, benchmark passages, byte-pair encoding.

Each stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept; between stages the documents are a table in the
shared folder. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, decontaminate, ngram_join, substrings, toxicity
from tidemark.llm.queries import tokenizer_path
from tidemark.scratch import materialize

#: SQL has no trained model, so run() is tested against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects go; it is trained on the labelled documents that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels, where=~toxicity.held_out(F.col("doc_id")))
    return toxicity.drop_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group of texts that are linked by a Jaccard coefficient of 0.8 over five-word shingles."""
    return ngram_join.keep_one(docs, size=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut out. Documents that lose nothing keep their text as it is; those that lose all go."""
    rows = substrings.remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("doc.text"))
    left = rows.where("n_removed = 0 OR kept <> ''")
    changed = {"text": text, "n_chars": F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("doc.n_chars"))}
    return left.select(*(changed.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text they decode to."""
    rules = bpe.read_rules(tokenizer_path())
    encoded = bpe.encode(docs, bpe.build_lexicon(docs, "text", rules), rules, decoded=True)
    return encoded.select("doc.doc_id", "doc.lang", "doc.source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("decontamination", drop_contaminated),
    ("encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
