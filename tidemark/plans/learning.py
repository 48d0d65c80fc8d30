"""Training, evaluation and scoring."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.scalars import hash_bucket
from tidemark.functions.text import tokens
from tidemark.operators import models
from tidemark.plans import bindings as b
from tidemark.plans.registry import query
from tidemark.scratch import fresh_path, materialize


@query(
    "m01_label_index",
    """SELECT lang, CAST(row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS DOUBLE) AS label, count(*) AS n, lang AS restored
        FROM documents GROUP BY lang""",
)
def m01(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = b.documents(spark, sf_dir).select("doc_id", "lang")
    indexer = models.label_index(docs, "lang")
    counted = indexer.transform(docs).groupBy("lang", "label").agg(F.count(F.lit(1)).alias("n"))
    return IndexToString(inputCol="label", outputCol="restored", labels=indexer.labels).transform(counted)


_SPLIT = "CAST(('0x' || substr(md5('split:' || text), 1, 8)) AS BIGINT) % 100 < 70"


@query("m02_split", f"SELECT doc_id, CASE WHEN {_SPLIT} THEN 'train' ELSE 'test' END AS part FROM documents")
def m02(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = models.hash_split(b.documents(spark, sf_dir).select("doc_id", "text"), "text", 70, "split")
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.select("doc_id", "part")


def _labelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Documents with the language as label, split by a hash of the text; and the label names."""
    docs = b.texts(spark, sf_dir).select("doc_id", "text", "lang", "source")
    indexer = models.label_index(docs.select("lang"), "lang")
    train, test = models.hash_split(indexer.transform(docs), "text", 70, "split")
    return train, test, indexer.labels


def _checked(predicted: DataFrame, col: str, labels: list[str]) -> DataFrame:
    """What must hold of predictions on rows kept back: their number, no label from outside, better than the commonest label."""
    known = F.coalesce(F.col(col).isin(labels), F.lit(False))
    right = F.avg((F.col(col) == F.col("lang")).cast("int"))
    most = predicted.groupBy("lang").count().agg(F.max("count")).scalar()
    out = predicted.agg(F.count(F.lit(1)).alias("n"), F.min(known).alias("known"), right.alias("right"))
    return out.select("n", "known", (F.col("right") * F.col("n") > most).alias("above_majority"))


_KEPT_BACK = "CAST(('0x' || substr(md5('split:' || coalesce(text, '')), 1, 8)) AS BIGINT) % 100 >= 70"
_CHECKED_SQL = f"SELECT count(*) AS n, true AS known, true AS above_majority FROM documents WHERE {_KEPT_BACK}"


def _predictions(spark: SparkSession, sf_dir: str, kind: str, **params) -> tuple[DataFrame, list[str]]:
    train, test, labels = _labelled(spark, sf_dir)
    return models.text_classifier(kind, ["text"], labels, **params).fit(train).transform(test), labels


@query("m03_naive_bayes")
def m03(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confusion matrix on the rows kept back."""
    predicted, _ = _predictions(spark, sf_dir, "naive_bayes", num_features=5_000)
    return models.confusion(predicted, "lang", "predicted_label")


@query("m03_naive_bayes_checked", _CHECKED_SQL)
def m03_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(*_with_column(_predictions(spark, sf_dir, "naive_bayes", num_features=5_000)))


def _with_column(predicted: tuple[DataFrame, list[str]]) -> tuple[DataFrame, str, list[str]]:
    return predicted[0], "predicted_label", predicted[1]


def _tuned(spark: SparkSession, sf_dir: str):
    """24 settings (analyzer, prefix, size, smoothing) by 4 folds over all rows to train on, on which the winner is fitted too.

    Returns the settings, the winner, its metric, the number of folds, the predictions and the labels."""
    train, test, labels = _labelled(spark, sf_dir)
    pipeline = models.text_classifier("naive_bayes", ["text"], labels, num_features=5_000)
    analyzer, hashing, bayes = pipeline.getStages()[:3]
    grid = (
        ParamGridBuilder().addGrid(analyzer.kind, ["whitespace", "standard"]).addGrid(analyzer.prefix, [False, True])
        .addGrid(hashing.numFeatures, [1_000, 5_000]).addGrid(bayes.smoothing, [1.0, 0.5, 0.25]).build()
    )
    tuned = models.tune(pipeline, grid, train.select("doc_id", "text", "lang", "label"), folds=4, parallelism=8)
    at = max(range(len(grid)), key=lambda i: tuned.avgMetrics[i])
    best = {p.name: v for p, v in grid[at].items()}
    return grid, best, tuned.avgMetrics[at], tuned.getNumFolds(), tuned.bestModel.transform(test), labels


@query("m04_cross_validate")
def m04(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winning setting, its mean metric over the folds, and its accuracy on the rows kept back."""
    grid, best, metric, folds, predicted, _ = _tuned(spark, sf_dir)
    setting = [F.lit(v).alias(k) for k, v in sorted(best.items())]
    return models.accuracy(predicted, "lang", "predicted_label").select(
        F.lit(len(grid)).alias("settings"), F.lit(folds).alias("folds"), *setting, F.lit(metric).alias("metric"), "n", "accuracy", "error"
    )


@query("m04_cross_validate_checked", f"SELECT 24 AS settings, 4 AS folds, * FROM ({_CHECKED_SQL})")
def m04_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid, _, _, folds, predicted, labels = _tuned(spark, sf_dir)
    checked = _checked(predicted, "predicted_label", labels)
    return checked.select(F.lit(len(grid)).alias("settings"), F.lit(folds).alias("folds"), "n", "known", "above_majority")


_PREDICTED = """CASE WHEN CAST(('0x' || substr(md5('guess:' || doc_id), 1, 8)) AS BIGINT) % 100 < 80 THEN lang ELSE 'en' END"""


def _saved_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    guess = F.when(hash_bucket("doc_id", 100, "guess") < 80, F.col("lang")).otherwise("en")
    return materialize(b.documents(spark, sf_dir).select("doc_id", "lang", guess.alias("predicted")), "predictions")


@query(
    "m05_accuracy",
    f"""SELECT count(*) AS n, round(avg(CASE WHEN lang = p THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy,
        round(1 - avg(CASE WHEN lang = p THEN 1.0::DOUBLE ELSE 0 END), 6) AS error FROM (SELECT lang, {_PREDICTED} AS p FROM documents)""",
)
def m05(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = models.accuracy(_saved_predictions(spark, sf_dir), "lang", "predicted")
    return out.withColumns({c: F.round(c, 6) for c in ("accuracy", "error")})


@query("m05_confusion", f"SELECT lang, {_PREDICTED} AS predicted, count(*) AS n FROM documents GROUP BY ALL")
def m05_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.confusion(_saved_predictions(spark, sf_dir), "lang", "predicted")


def _by_fields(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """Body counts three times as much as the source, which every fourth document lacks."""
    train, test, labels = _labelled(spark, sf_dir)
    train, test = (part.withColumn("origin", F.when(F.col("doc_id") % 4 > 0, F.col("source"))) for part in (train, test))
    model = models.fit_stored(models.field_classifier("logistic", {"text": 3, "origin": 1}, labels), train)
    return model.transform(test), labels


@query("m06_logistic")
def m06(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confusion matrix on the rows kept back."""
    return models.confusion(_by_fields(spark, sf_dir)[0], "lang", "predicted_label")


@query("m06_logistic_checked", _CHECKED_SQL)
def m06_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(*_with_column(_by_fields(spark, sf_dir)))


@query("m07_svm_sentiment")
def m07(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, sentiment_d): every document is scored, labelled or not."""
    docs = b.texts(spark, sf_dir).select("doc_id", "text")
    labels = b.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    pipeline = models.text_classifier("linear_svm", ["text"], idf=True, norm=2.0, num_features=5_000)
    model = models.fit_stored(pipeline, docs.join(labels, "doc_id"))
    return models.score(docs, model, ["text"], "prediction", "sentiment_d").select("doc_id", "sentiment_d")


@query("m07_svm_sentiment_checked", "SELECT doc_id, true AS scored FROM documents")
def m07_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m07(spark, sf_dir).select("doc_id", F.coalesce(F.col("sentiment_d").isin(0.0, 1.0), F.lit(False)).alias("scored"))


_IN_RANGE = "SELECT {0}, true AS in_range, (SELECT count(*) FROM {1}) >= {2} AS enough_rows FROM {1}"


def _assigned(clustered: DataFrame, key: str, k: int) -> DataFrame:
    rows = clustered.agg(F.count(F.lit(1))).scalar()
    return clustered.select(key, F.coalesce(F.col("cluster").between(0, k - 1), F.lit(False)).alias("in_range"), (rows >= k).alias("enough_rows"))


@query("m08_kmeans")
def m08(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, cluster)."""
    docs = b.texts(spark, sf_dir).select("doc_id", "text", F.col("source").alias("title"))
    features = models.text_features(["title", "text"], num_features=100_000).fit(docs).transform(docs).select("doc_id", "features")
    _, clustered = models.cluster(materialize(features, "features"), "features", k=30, iters=100)
    return clustered.select("doc_id", "cluster")


@query("m08_kmeans_checked", _IN_RANGE.format("doc_id", "documents", 30))
def m08_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assigned(m08(spark, sf_dir), "doc_id", 30)


@query("m08_kmeans_embeddings")
def m08_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, cluster)."""
    vectors = b.table(spark, sf_dir, "embeddings").select("vec_id", "label", array_to_vector(models.l2_normalize("embedding")).alias("features"))
    _, clustered = models.cluster(vectors, "features", k=10, iters=100)
    return clustered.select("vec_id", "cluster")


@query("m08_kmeans_embeddings_checked", _IN_RANGE.format("vec_id", "embeddings", 10))
def m08_embeddings_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assigned(m08_embeddings(spark, sf_dir), "vec_id", 10)


def _saved_model(spark: SparkSession, sf_dir: str) -> tuple[PipelineModel, PipelineModel, str]:
    """A fitted classifier and the same one after saving and loading."""
    train, _, labels = _labelled(spark, sf_dir)
    model = models.text_classifier("naive_bayes", ["text"], labels, num_features=5_000).fit(train)
    path = fresh_path(spark, "model")
    models.save_with_meta(
        spark, model, path, {"numFeatures": "5000", "featureFields": "text", "analyzer": "standard", "normalizer": "N"}
    )
    return model, models.load_model(path), path


@query("k08_model_save_load", "SELECT count(*) AS n, count(*) AS same FROM documents")
def k08(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, loaded, _ = _saved_model(spark, sf_dir)
    docs = b.documents(spark, sf_dir).select("doc_id", "text")
    # the loaded model scores the rows that the fitted one has scored, so no join is needed to compare
    once = models.score(docs, model, ["text"], "predicted_label", "before")
    twice = models.score(once, loaded, ["text"], "predicted_label", "after")
    return twice.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("before") == F.col("after")).alias("same"))


@query("m09_batch_score")
def m09(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, the_lang_s)."""
    _, loaded, _ = _saved_model(spark, sf_dir)
    # each tenth document arrives without text and must come out unscored
    docs = b.documents(spark, sf_dir).select("doc_id", F.when(F.col("doc_id") % 10 > 0, F.col("text")).alias("text"))
    return models.score(docs, loaded, ["text"], "predicted_label", "the_lang_s").select("doc_id", "the_lang_s")


@query("m09_batch_score_checked", "SELECT doc_id, doc_id % 10 = 0 AS unscored FROM documents")
def m09_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m09(spark, sf_dir).select("doc_id", F.col("the_lang_s").isNull().alias("unscored"))


@query(
    "m10_model_metadata",
    "SELECT count(*) AS n, '5000' AS num_features, 'text' AS feature_fields, 'standard' AS analyzer FROM documents",
)
def m10(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, loaded, path = _saved_model(spark, sf_dir)
    meta = models.load_meta(spark, path)
    # the metadata is enough to prepare the columns that the model needs
    docs = b.documents(spark, sf_dir).select(*meta["featureFields"].split(","))
    return loaded.transform(docs).agg(F.count("prediction").alias("n")).select(
        "n", F.lit(meta["numFeatures"]).alias("num_features"), F.lit(meta["featureFields"]).alias("feature_fields"),
        F.lit(meta["analyzer"]).alias("analyzer"),
    )


def quick_model(spark: SparkSession, sf_dir: str) -> PipelineModel:
    """Language classifier for the streaming queries."""
    train, _, labels = _labelled(spark, sf_dir)
    return models.text_classifier("naive_bayes", ["body_t"], labels, num_features=5_000).fit(train.withColumnRenamed("text", "body_t"))
