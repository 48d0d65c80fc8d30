"""Text features and models with pyspark.ml: pipelines, tuning, scoring, saving."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LinearSVC, LogisticRegression, NaiveBayes
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    IDF,
    ElementwiseProduct,
    HashingTF,
    IndexToString,
    Normalizer,
    StringIndexer,
    Word2Vec,
)
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.scalars import hash_bucket, safe_ratio
from tidemark.functions.text import KINDS, analyze
from tidemark.functions.types import ColumnLike, as_col, let
from tidemark.scratch import discard, materialize


class Analyzer(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Tokens of one or more text columns as a pipeline stage, so a grid can vary `kind` and `prefix`."""

    kind = Param(Params._dummy(), "kind", "analyzer, one of " + ", ".join(KINDS), TypeConverters.toString)
    prefix = Param(Params._dummy(), "prefix", "mark tokens with their column", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None, kind="standard", prefix=False):
        super().__init__()
        self._setDefault(kind="standard", prefix=False)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        words = analyze(self.getInputCols(), self.getOrDefault(self.kind), self.getOrDefault(self.prefix))
        return df.withColumn(self.getOutputCol(), words)


class TokenWeight(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Tokens of several columns in one list, each column repeated `weight` times, so that its counts
    weigh that much more. An absent value adds nothing."""

    weights = Param(Params._dummy(), "weights", "repeat count per input column", TypeConverters.toListInt)
    kind = Param(Params._dummy(), "kind", "analyzer", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None, weights=None, kind="standard"):
        super().__init__()
        self._setDefault(kind="standard")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        kind = self.getOrDefault(self.kind)
        parts = [
            F.flatten(F.array_repeat(analyze([c], kind), w))
            for c, w in zip(self.getInputCols(), self.getOrDefault(self.weights))
        ]
        return df.withColumn(self.getOutputCol(), F.concat(*parts))


class FrequencyBounds(Estimator):
    """Blanks the buckets of a vector column whose share of documents (with a value there) is out of bounds.

    Fitting is one aggregate over vectors of a fixed length; the fitted stage is Spark's own element-wise product.
    """

    def __init__(self, input_col: str, output_col: str, min_df: float, max_df: float):
        super().__init__()
        self.input_col, self.output_col, self.min_df, self.max_df = input_col, output_col, min_df, max_df

    def setOutputCol(self, value: str) -> FrequencyBounds:  # noqa: N802
        self.output_col = value
        return self

    def _fit(self, df: DataFrame) -> ElementwiseProduct:
        found = df.select(Summarizer.numNonZeros(F.col(self.input_col)).alias("n"), F.count(self.input_col).alias("rows")).first()
        low, high = self.min_df * found["rows"], self.max_df * found["rows"]
        mask = Vectors.dense([1.0 if low <= n <= high else 0.0 for n in found["n"]])
        return ElementwiseProduct(scalingVec=mask, inputCol=self.input_col, outputCol=self.output_col)


def vectorize(
    weights: Mapping[str, int],
    num_features: int = 10_000,
    idf: bool = False,
    norm: float | None = 2.0,
    min_df: float = 0.0,
    max_df: float = 1.0,
    analyzer: str = "html_standard_stop",
) -> list:
    """Stages from text columns with weights to the column `features`.

    Terms are hashed, with or without bounds on the share of documents a term occurs in; the bounds hold for
    the buckets of the hash, whose number is fixed.
    """
    cols = list(weights)
    stages: list = [TokenWeight(inputCols=cols, outputCol="words", weights=[weights[c] for c in cols], kind=analyzer)]
    bounded = min_df > 0 or max_df < 1
    stages.append(HashingTF(inputCol="words", outputCol="hashed" if bounded else "counts", numFeatures=num_features))
    if bounded:
        stages.append(FrequencyBounds("hashed", "counts", min_df, max_df))
    if idf:
        stages.append(IDF(inputCol="counts", outputCol="tfidf"))
    if norm:
        stages.append(Normalizer(inputCol="tfidf" if idf else "counts", outputCol="features", p=norm))
    else:
        stages[-1].setOutputCol("features")
    return stages


def field_classifier(kind: str, weights: Mapping[str, int], labels: Sequence[str], idf: bool = True, norm: float | None = 2.0, **params) -> Pipeline:
    """Classifier over several weighted text columns; `params` go to `vectorize` where it knows them, else
    to the classifier."""
    known = {k: params.pop(k) for k in ("num_features", "min_df", "max_df", "analyzer") if k in params}
    stages = vectorize(weights, idf=idf, norm=norm, **known)
    stages.append(classifier_stage(kind, featuresCol="features", **params))
    stages.append(IndexToString(inputCol="prediction", outputCol="predicted_label", labels=list(labels)))
    return Pipeline(stages=stages)


def label_index(df: DataFrame, col: str, out: str = "label"):
    """Fitted indexer: labels by frequency, the most frequent first, ties by name."""
    return StringIndexer(inputCol=col, outputCol=out, stringOrderType="frequencyDesc", handleInvalid="skip").fit(df)


def hash_split(df: DataFrame, key: ColumnLike, pct: int, seed: int | str = 0) -> tuple[DataFrame, DataFrame]:
    """(pct %, the rest), decided by a hash of the key: rows with the same key, such as copies of one
    text, never end up on both sides."""
    bucket = hash_bucket(key, 100, seed)
    return df.where(bucket < pct), df.where(bucket >= pct)


def classifier_stage(kind: str, **params):
    """naive_bayes (smoothing), logistic (L2 0.01, 10 iterations) or linear_svm."""
    if kind == "naive_bayes":
        return NaiveBayes(**{"smoothing": 1.0, **params})
    if kind == "logistic":
        return LogisticRegression(**{"regParam": 0.01, "elasticNetParam": 0.0, "maxIter": 10, **params})
    if kind == "linear_svm":
        return LinearSVC(**{"maxIter": 10, "regParam": 0.01, **params})
    raise ValueError(f"unknown classifier {kind!r}")


def text_classifier(
    kind: str,
    text_cols: Sequence[str],
    labels: Sequence[str] | None = None,
    num_features: int = 10_000,
    analyzer: str = "standard",
    idf: bool = False,
    norm: float | None = None,
    **params,
) -> Pipeline:
    """Pipeline text -> tokens -> hashed counts (-> idf -> norm) -> classifier (-> label text).

    It expects the numeric column `label`; with `labels` the prediction also comes as text.
    """
    stages: list = [
        Analyzer(inputCols=list(text_cols), outputCol="words", kind=analyzer),
        HashingTF(inputCol="words", outputCol="tf", numFeatures=num_features),
    ]
    last = "tf"
    if idf:
        stages.append(IDF(inputCol=last, outputCol="tfidf"))
        last = "tfidf"
    if norm:
        stages.append(Normalizer(inputCol=last, outputCol="normed", p=norm))
        last = "normed"
    stages.append(classifier_stage(kind, featuresCol=last, **params))
    if labels:
        stages.append(IndexToString(inputCol="prediction", outputCol="predicted_label", labels=list(labels)))
    return Pipeline(stages=stages)


def fit_stored(pipeline: Pipeline, df: DataFrame) -> PipelineModel:
    """Fit a pipeline whose classifier goes over its rows many times: the features are worked out once and stored for it."""
    stages, fitted, rows = pipeline.getStages(), [], df
    for i, stage in enumerate(stages):
        if isinstance(stage, Estimator):
            if hasattr(stage, "getFeaturesCol"):
                rows = materialize(rows.select(stage.getLabelCol(), stage.getFeaturesCol()), "features")
            stage = stage.fit(rows)
        fitted.append(stage)
        if any(isinstance(s, Estimator) for s in stages[i + 1 :]):
            rows = stage.transform(rows)
    return PipelineModel(fitted)


def tune(
    pipeline: Estimator, grid: list, train: DataFrame, folds: int = 4, metric: str = "accuracy", parallelism: int = 4, seed: int = 7
) -> CrossValidatorModel:
    """Cross-validated choice over a parameter grid, on all rows of `train`; `parallelism` settings are fitted at a time.

    Rows get their fold once. What the stages before the first estimator make of a row depends on no other row, so it is worked out and stored
    once for each of their settings; fits and predictions of that setting read its folds, and the table goes before the next one is made.
    """
    evaluator = MulticlassClassificationEvaluator(metricName=metric)
    stages = pipeline.getStages() if isinstance(pipeline, Pipeline) else [pipeline]
    first = next(i for i, stage in enumerate(stages) if isinstance(stage, Estimator))
    head, tail = PipelineModel(stages[:first]), Pipeline(stages=stages[first:])
    own = {stage.uid for stage in stages[:first]}
    groups: dict[tuple, list[int]] = {}
    for i, setting in enumerate(grid):
        groups.setdefault(tuple(sorted((p.parent, p.name, repr(v)) for p, v in setting.items() if p.parent in own)), []).append(i)
    fold = F.least(F.floor(F.rand(seed) * folds), F.lit(folds - 1)).cast("int")
    dealt = materialize(train.withColumn("_fold", fold), "tune")
    metrics = np.zeros((folds, len(grid)))
    for members in groups.values():
        made = head.transform(dealt, {p: v for p, v in grid[members[0]].items() if p.parent in own})
        used = [c for c in made.columns if c in _columns_used([*stages[first:], evaluator])]
        rows = materialize(made.select(*used, "_fold"), "tune", by="_fold")
        rest = [{p: v for p, v in grid[i].items() if p.parent not in own} for i in members]

        def measure(task: tuple[int, int]) -> tuple[int, int, float]:
            k, at = task
            model = tail.fit(rows.where(F.col("_fold") != k), rest[at])
            return k, members[at], evaluator.evaluate(model.transform(rows.where(F.col("_fold") == k), rest[at]))

        tasks = [(k, at) for k in range(folds) for at in range(len(members))]
        with ThreadPool(min(parallelism, len(tasks))) as pool:
            for k, i, value in pool.imap_unordered(inheritable_thread_target(train.sparkSession)(measure), tasks):
                metrics[k, i] = value
        discard(rows)
    means = metrics.mean(axis=0)
    best = pipeline.fit(dealt, grid[int(means.argmax() if evaluator.isLargerBetter() else means.argmin())])
    discard(dealt)
    validator = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds, parallelism=parallelism, seed=seed)
    return validator._copyValues(CrossValidatorModel(best, means.tolist(), None, metrics.std(axis=0).tolist()))


def _columns_used(stages: Sequence[Params]) -> set[str]:
    """Names of columns that the parameters of `stages` may stand for."""
    values = [stage.getOrDefault(p) for stage in stages for p in stage.params if stage.isDefined(p)]
    return {name for value in values for name in (value if isinstance(value, list) else [value]) if isinstance(name, str)}


def text_features(text_cols: Sequence[str], num_features: int, analyzer: str = "standard_stop") -> Pipeline:
    """Hashed term counts of all columns together, scaled to unit length, as `features`."""
    return Pipeline(
        stages=[
            Analyzer(inputCols=list(text_cols), outputCol="words", kind=analyzer),
            HashingTF(inputCol="words", outputCol="tf", numFeatures=num_features),
            Normalizer(inputCol="tf", outputCol="features", p=2.0),
        ]
    )


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("n"))


def accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    """One row: rows, share predicted right, and 1 - that share. An unscored row counts as wrong."""
    right = F.count_if(F.col(label).eqNullSafe(F.col(pred)))
    share = safe_ratio(right, F.count(F.lit(1)))
    return df.agg(F.count(F.lit(1)).alias("n"), share.alias("accuracy"), (1 - share).alias("error"))


def cluster(df: DataFrame, features: str, k: int, iters: int = 100, seed: int = 7) -> tuple[PipelineModel, DataFrame]:
    """k-means over a vector column; returns the model and the rows with `cluster`."""
    model = Pipeline(stages=[KMeans(featuresCol=features, predictionCol="cluster", k=k, maxIter=iters, seed=seed)]).fit(df)
    return model, model.transform(df)


def score(df: DataFrame, model: Transformer, text_cols: Sequence[str], source: str, out_col: str) -> DataFrame:
    """Input columns plus the model's `source` column as `out_col`. Rows in which every text is null or
    empty stay, with a null score."""
    has_text = F.lit(False)
    for c in text_cols:
        has_text = has_text | (F.coalesce(F.trim(F.col(c)), F.lit("")) != "")
    scored = model.transform(df)
    value = F.when(has_text, F.col(source))
    return scored.withColumn("_score", value).select(*df.columns, F.col("_score").alias(out_col))


def save_with_meta(spark: SparkSession, model, path: str, meta: Mapping[str, str]) -> None:
    """Save a model, and what is needed to use it as one JSON line in a folder next to it."""
    model.write().overwrite().save(path)
    row = spark.createDataFrame([(json.dumps(dict(meta), sort_keys=True),)], "value string")
    row.coalesce(1).write.mode("overwrite").text(path + ".meta")


def load_meta(spark: SparkSession, path: str) -> dict[str, str]:
    return json.loads(spark.read.text(path + ".meta").first()["value"])


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def terms_of(df: DataFrame, words: Column, *keep: str) -> DataFrame:
    """One row per list element, as `term`.

    The outer form is on purpose: for the plain one Spark tests the list's size below the projection that
    makes it, and so splits every text twice.
    """
    return df.select(*keep, F.explode_outer(words).alias("term")).where(F.col("term").isNotNull())


def document_frequency(df: DataFrame, tokens_col: str, min_df: float = 0.0, max_df: float = 1.0) -> DataFrame:
    """(term, df, idf) with idf = ln((n + 1) / (df + 1)), for terms in a share of documents within bounds.

    Repeats are removed within the row, so counting needs one shuffle, with partial counts before it.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    terms = terms_of(df, F.array_distinct(tokens_col)).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    counted = terms.withColumn("_total", total)
    share = F.col("df") / F.col("_total")
    return counted.where((share >= min_df) & (share <= max_df)).select(
        "term", "df", F.log((F.col("_total") + 1) / (F.col("df") + 1)).alias("idf")
    )


def term_counts(df: DataFrame, id_col: str, tokens_col: str) -> DataFrame:
    """(id, term, n)."""
    return terms_of(df, F.col(tokens_col), id_col).groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("n"))


def l2_normalize(col: ColumnLike) -> Column:
    """Array of numbers to unit length, in double; an all-zero array stays."""
    return let(F.transform(as_col(col), lambda v: v.cast("double")), _unit)


def _unit(values: Column) -> Column:
    norm = F.sqrt(F.aggregate(values, F.lit(0.0), lambda s, v: s + v * v))
    return let(norm, lambda n: F.transform(values, lambda v: F.when(n == 0, v).otherwise(v / n)))


def word_vectors(input_col: str, output_col: str, dim: int, window: int = 5, step: float = 0.025, iters: int = 1,
                 max_sentence: int = 1000, seed: int = 1234, partitions: int = 1, min_count: int = 0) -> Word2Vec:
    """Word vector estimator; `partitions` trades training speed for accuracy. Spark holds its vocabulary on the driver, so it is
    for vocabularies that fit there; a `min_count` leaves rarer words without a vector."""
    if dim <= 0:
        raise ValueError("dimension 0 means no word vectors; leave the stage out")
    return Word2Vec(
        vectorSize=dim, windowSize=window, stepSize=step, maxIter=iters, maxSentenceLength=max_sentence, seed=seed,
        numPartitions=partitions, minCount=min_count, inputCol=input_col, outputCol=output_col,
    )
