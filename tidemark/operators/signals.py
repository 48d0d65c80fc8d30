"""Click signals: weights, interactions, item catalogue, boosts, ranking checks and metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.scalars import hash_bucket, make_id, safe_ratio
from tidemark.functions.types import ColumnLike, as_col


def click_weights(signals: DataFrame, weight: str | None = None) -> DataFrame:
    """One row per (query, doc_id) with the summed weight (the row count without a weight column).

    A plain sum: no decay by age or type.
    """
    total = F.sum(weight) if weight else F.count(F.lit(1))
    return signals.groupBy("query", "doc_id").agg(total.alias("weight"))


def interactions(clicks: DataFrame, user: str = "user_id", item: str = "item") -> DataFrame:
    """(user, item, weight), the weight being the number of clicks."""
    return clicks.groupBy(user, item).agg(F.count(F.lit(1)).alias("weight"))


def catalogue(clicks: DataFrame, group: str, item: str) -> DataFrame:
    """Distinct items as (id = group-item, group, item); rows without both are left out."""
    known = clicks.where(F.col(group).isNotNull() & (F.col(group) != "") & F.col(item).isNotNull() & (F.col(item) != ""))
    return known.select(make_id([group, item], "-").alias("id"), group, item).distinct()


def boosts(weights: DataFrame, n: int) -> DataFrame:
    """The `n` heaviest documents per query as (query, doc_id, weight, rank), ties by doc_id."""
    order = Window.partitionBy("query").orderBy(F.col("weight").desc(), F.col("doc_id"))
    return weights.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def boost_text(doc_id: ColumnLike, weight: ColumnLike) -> Column:
    """A boost as function-query text, the form that `parse_boost` reads."""
    return F.format_string(
        "map(query({!field f='id' v='%s'}), 0, 0, 1, %.1f)", as_col(doc_id).cast("string"), as_col(weight).cast("double")
    )


def parse_boosts(df: DataFrame, col: str) -> DataFrame:
    """Add `boost_doc`, `boost_weight` and `rejected` (true where either part is not found)."""
    doc = F.nullif(F.regexp_extract(col, "v='(\\w+)", 1), F.lit(""))
    weight = F.nullif(F.regexp_extract(col, "(\\d+(?:\\.\\d+)?)\\)", 1), F.lit("")).try_cast("double")
    return df.withColumns({"boost_doc": doc, "boost_weight": weight, "rejected": doc.isNull() | weight.isNull()})


def rank_check(expected: DataFrame, produced: DataFrame) -> DataFrame:
    """Per query, whether the `expected` list (query, rank array) is the beginning of what was produced.

    `produced` has (query, doc_id, rank) with ranks from 1. Only as many ranks as the expected list has
    are kept before they are put in a list.
    """
    wanted = expected.select("query", F.col("rank").alias("expected"))
    near = produced.join(wanted, "query").where(F.col("rank") <= F.size("expected"))
    lists = near.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("rank", "doc_id"))).alias("_got"))
    got = F.coalesce(F.transform("_got", lambda g: g["doc_id"]), F.array().cast("array<string>"))
    return (
        wanted.join(lists, "query", "left")
        .withColumn("produced", got)
        .select("query", "expected", "produced", (F.col("produced") == F.col("expected")).alias("passed"))
    )


def assign_variant(
    df: DataFrame, id_col: ColumnLike, weights: Sequence[tuple[str, float]], seed: str = "variant"
) -> DataFrame:
    """Add `variant`: the same id always gets the same one, in proportion to the weights."""
    total = float(sum(w for _, w in weights))
    bucket = hash_bucket(id_col, 10_000, seed)
    out, upto = None, 0.0
    for name, weight in weights[:-1]:
        upto += weight
        edge = round(10_000 * upto / total)
        out = F.when(bucket < edge, name) if out is None else out.when(bucket < edge, name)
    last = F.lit(weights[-1][0])
    return df.withColumn("variant", last if out is None else out.otherwise(last))


def ground_truth(weights: DataFrame, min_weight: float = 1, grades: int = 3) -> DataFrame:
    """Relevant documents per query with a grade from 1 to `grades`: (query, doc_id, weight, grade).

    The grade is the weight's share of the query's heaviest document, in equal steps. This definition is
    this library's own; it needs the maximum of a query only, never a query's sorted list.
    """
    kept = weights.where(F.col("weight") >= min_weight)
    heaviest = kept.groupBy("query").agg(F.max("weight").alias("_max"))
    return kept.join(heaviest, "query").select(
        "query", "doc_id", "weight",
        F.greatest(F.lit(1), F.ceil(F.col("weight") * grades / F.col("_max"))).cast("bigint").alias("grade"),
    )


def ranking_metrics(results: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """Per variant and query: precision@k, recall@k, reciprocal rank, average precision and nDCG@k.

    `results` has (variant, query, doc_id, rank) with ranks from 1; `truth` has (query, doc_id, grade).
    Gain is the grade, the discount 1/log2(rank + 1). Queries without relevant documents are left out; a
    variant that shows nothing for a query with relevant documents scores 0 there.
    Averages go over the relevant documents of the query, found or not.
    """
    top = results.where(F.col("rank") <= k)
    graded = top.join(truth.select("query", "doc_id", "grade"), ["query", "doc_id"], "left")
    by_rank = Window.partitionBy("variant", "query").orderBy("rank")
    hit = F.col("grade").isNotNull()
    graded = graded.withColumn("_hits", F.sum(hit.cast("int")).over(by_rank.rowsBetween(Window.unboundedPreceding, 0)))
    found = graded.groupBy("variant", "query").agg(
        F.count_if(hit).alias("hits"),
        F.min(F.when(hit, F.col("rank"))).alias("first_hit"),
        F.sum(F.when(hit, F.col("_hits") / F.col("rank"))).alias("precision_sum"),
        F.sum(F.when(hit, F.col("grade") / F.log2(F.col("rank") + 1))).alias("dcg"),
    )
    # the best possible list needs the k highest grades only
    best = Window.partitionBy("query").orderBy(F.col("grade").desc(), F.col("doc_id"))
    ideal = (
        truth.withColumn("_place", F.row_number().over(best))
        .where(F.col("_place") <= k)
        .groupBy("query")
        .agg(F.sum(F.col("grade") / F.log2(F.col("_place") + 1)).alias("idcg"))
    )
    relevant = truth.groupBy("query").agg(F.count(F.lit(1)).alias("relevant"))
    variants = results.select(F.sort_array(F.collect_set("variant"))).scalar()  # a handful
    return (
        relevant.withColumn("variant", F.explode(variants))
        .join(found, ["variant", "query"], "left")
        .join(ideal, "query")
        .select(
            "variant",
            "query",
            (F.coalesce("hits", F.lit(0)) / F.lit(float(k))).alias("precision_at_k"),
            safe_ratio(F.coalesce("hits", F.lit(0)), F.col("relevant")).alias("recall_at_k"),
            F.coalesce(1 / F.col("first_hit"), F.lit(0.0)).alias("reciprocal_rank"),
            F.coalesce(F.col("precision_sum") / F.col("relevant"), F.lit(0.0)).alias("average_precision"),
            F.coalesce(F.col("dcg") / F.col("idcg"), F.lit(0.0)).alias("ndcg_at_k"),
        )
    )


def mean_metrics(per_query: DataFrame) -> DataFrame:
    """Mean of each metric per variant."""
    names = ["precision_at_k", "recall_at_k", "reciprocal_rank", "average_precision", "ndcg_at_k"]
    return per_query.groupBy("variant").agg(F.count(F.lit(1)).alias("queries"), *[F.avg(n).alias(n) for n in names])
