import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from tidemark.operators import models
from tidemark.plans import learning
from tidemark.scratch import fresh_path


@pytest.fixture(scope="module")
def texts(spark):
    """Two classes that share four fifths of their words."""
    rng = random.Random(11)
    shared = [f"w{i}" for i in range(80)]
    own = {"up": [f"u{i}" for i in range(20)], "down": [f"d{i}" for i in range(20)]}
    rows = []
    for n in range(240):
        label = "up" if n % 3 else "down"
        words = rng.choices(shared, k=16) + rng.choices(own[label], k=4)
        rng.shuffle(words)
        rows.append((n, " ".join(words), label))
    return spark.createDataFrame(rows, "id int, body string, tag string")


@pytest.mark.parametrize("kind,extra", [("naive_bayes", {}), ("logistic", {"idf": True, "norm": 2.0}), ("linear_svm", {"norm": 2.0})])
def test_classifiers_beat_the_majority(spark, texts, kind, extra):
    indexer = models.label_index(texts, "tag")
    assert indexer.labels == ["up", "down"]
    train, test = models.hash_split(indexer.transform(texts), "body", 70, 1)
    model = models.text_classifier(kind, ["body"], indexer.labels, num_features=2_000, **extra).fit(train)
    row = models.accuracy(model.transform(test), "tag", "predicted_label").first()
    assert row.accuracy > 0.9 and row.error == pytest.approx(1 - row.accuracy)


def test_split_keeps_copies_together(spark, texts):
    doubled = texts.unionByName(texts)
    train, test = models.hash_split(doubled, "body", 70, 1)
    assert train.count() + test.count() == doubled.count()
    assert train.select("body").intersect(test.select("body")).isEmpty()


def test_save_load_score_meta(spark, texts):
    indexer = models.label_index(texts, "tag")
    model = models.text_classifier("naive_bayes", ["body"], indexer.labels, num_features=1_000).fit(indexer.transform(texts))
    path = fresh_path(spark, "model")
    models.save_with_meta(spark, model, path, {"numFeatures": "1000"})
    loaded = models.load_model(path)
    assert models.load_meta(spark, path) == {"numFeatures": "1000"}
    new = texts.drop("tag").unionByName(spark.createDataFrame([(900, None), (901, "  ")], "id int, body string"))
    a = models.score(new, model, ["body"], "predicted_label", "class_s")
    b = models.score(new, loaded, ["body"], "predicted_label", "class_s")
    assert a.exceptAll(b).isEmpty() and a.columns == ["id", "body", "class_s"]
    assert {r.id for r in a.where("class_s IS NULL").collect()} == {900, 901}


def test_grid_varies_the_analyzer(spark, texts):
    indexed = models.label_index(texts, "tag").transform(texts)
    pipeline = models.text_classifier("naive_bayes", ["body"], num_features=500)
    analyzer, hashing, bayes = pipeline.getStages()
    grid = (
        ParamGridBuilder().addGrid(hashing.numFeatures, [200, 500]).addGrid(analyzer.kind, ["whitespace", "standard"])
        .addGrid(analyzer.prefix, [True, False]).addGrid(bayes.smoothing, [1.0]).build()
    )
    assert len(grid) == 8
    tuned = models.tune(pipeline, grid[:2], indexed, folds=2)
    assert len(tuned.avgMetrics) == 2 and max(tuned.avgMetrics) > 0.8


def test_tuning_is_that_of_spark(spark, texts):
    """Stored features and shared folds give the metrics and the winner of Spark's own cross-validation."""
    indexed = models.label_index(texts, "tag").transform(texts)
    pipeline = models.text_classifier("naive_bayes", ["body"], num_features=20)
    analyzer, hashing, bayes = pipeline.getStages()
    grid = ParamGridBuilder().addGrid(hashing.numFeatures, [10, 20]).addGrid(bayes.smoothing, [1.0, 9.0]).build()
    plain = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=MulticlassClassificationEvaluator(metricName="accuracy"), numFolds=3, seed=7).fit(indexed)
    tuned = models.tune(pipeline, grid, indexed, folds=3)
    assert tuned.avgMetrics == pytest.approx(plain.avgMetrics) and tuned.stdMetrics == pytest.approx(plain.stdMetrics) and tuned.getNumFolds() == 3
    assert tuned.bestModel.stages[1].getNumFeatures() == plain.bestModel.stages[1].getNumFeatures()


def test_settings_are_compared_on_all_rows(spark, tmp_path, monkeypatch):
    rows = spark.range(4_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), "id").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    seen = []
    monkeypatch.setattr(learning.models, "tune", lambda pipeline, grid, train, **more: seen.append(train.count()) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        learning._tuned(spark, str(tmp_path))
    assert seen == [learning._labelled(spark, str(tmp_path))[0].count()] and seen[0] > 2_000


def test_weighted_fields(spark):
    df = spark.createDataFrame([("apple pie", "pie"), ("apple", None)], "body string, subject string")
    from pyspark.ml import Pipeline

    out = Pipeline(stages=models.vectorize({"body": 3, "subject": 1}, num_features=64, norm=None)).fit(df).transform(df)
    totals = [sum(r.v) for r in out.select(vector_to_array("features").alias("v")).collect()]
    assert totals == [7.0, 3.0]
    unit = Pipeline(stages=models.vectorize({"body": 1}, num_features=64, idf=True)).fit(df).transform(df)
    assert unit.count() == 2


def test_frequency_bounds_and_field_classifier(spark, texts):
    from pyspark.ml import Pipeline

    df = spark.createDataFrame([("a b",), ("a c",), ("a b d",), ("a e",)], "body string")
    stages = models.vectorize({"body": 2}, norm=None, min_df=0.5, max_df=0.9, analyzer="standard")
    model = Pipeline(stages=stages).fit(df)
    # only b is in at least half and at most nine tenths of the rows
    assert [sum(r.v) for r in model.transform(df).select(vector_to_array("features").alias("v")).collect()] == [2.0, 0.0, 2.0, 0.0]
    indexer = models.label_index(texts, "tag")
    fitted = models.field_classifier("logistic", {"body": 3}, indexer.labels, num_features=1_000, maxIter=5).fit(indexer.transform(texts))
    assert models.accuracy(fitted.transform(indexer.transform(texts)), "tag", "predicted_label").first().accuracy > 0.9


def test_kmeans_finds_blobs(spark):
    rng = random.Random(2)
    rows = [(c, [c * 10 + rng.random(), -c * 10 + rng.random()]) for c in range(3) for _ in range(40)]
    df = spark.createDataFrame(rows, "truth int, v array<double>").select("truth", array_to_vector("v").alias("features"))
    _, out = models.cluster(df, "features", 3)
    assert out.groupBy("cluster").agg(F.count_distinct("truth").alias("t")).where("t <> 1").isEmpty()


def test_word_vectors(spark, texts):
    words = texts.select(F.split("body", " ").alias("words"))
    model = models.word_vectors("words", "v", dim=4).fit(words)
    assert len(model.transform(words).first().v) == 4
    with pytest.raises(ValueError):
        models.word_vectors("words", "v", dim=0)


def test_hashing_counts_every_token(spark, texts):
    df = texts.select(F.split("body", " ").alias("words"))
    out = HashingTF(inputCol="words", outputCol="tf", numFeatures=64).transform(df)
    assert {sum(r.v) for r in out.select(vector_to_array("tf").alias("v")).collect()} == {20.0}


def test_unknown_names():
    with pytest.raises(ValueError):
        models.classifier_stage("oracle")
