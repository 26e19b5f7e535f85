import pytest
from table_rows import rows
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from trackmart.ml import popularity as P


def test_category_codes_by_frequency_then_name(spark):
    df = spark.createDataFrame([("b",), ("b",), ("c",), ("a",)], "genre string")
    model = P.category_index(df, "genre")
    assert list(model.labels) == ["b", "a", "c"]
    unseen = spark.createDataFrame([("z",)], "genre string")
    assert model.transform(unseen).first()["genre_index"] == 3.0


def test_mean_imputation(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,), (float("nan"),)], "x double")
    filled = P.mean_imputer(["x"]).fit(df).transform(df)
    assert [r["x_imp"] for r in filled.collect()] == [1.0, 3.0, 2.0, 2.0]
    with pytest.raises(Exception, match="surrogate"):
        P.mean_imputer(["x"]).fit(spark.createDataFrame([(None,)], "x double"))


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(5000).withColumn("k", F.col("id").cast("string"))
    train, test = P.hash_split(df, ["k"])
    again, _ = P.hash_split(df.repartition(7), ["k"])
    assert rows(train) == rows(again)
    assert train.count() + test.count() == 5000
    assert 0.77 < train.count() / 5000 < 0.83


def test_metrics_of_perfect_and_constant_predictions(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (6.0,)], "y double")
    perfect = dict(rows(P.regression_metrics(df.withColumn("p", F.col("y")), "y", "p")))
    assert perfect == {"RMSE": 0.0, "MAE": 0.0, "R2": 1.0}
    constant = dict(rows(P.regression_metrics(df.withColumn("p", F.lit(3.0)), "y", "p")))
    assert constant["R2"] == pytest.approx(0.0)


def test_metrics_equal_the_evaluator(spark):
    df = spark.range(500).select(
        (F.col("id") % 17).cast("double").alias("y"), (F.col("id") % 11).cast("double").alias("p")
    )
    ours = dict(rows(P.regression_metrics(df, "y", "p")))
    for name in ["rmse", "mae", "r2"]:
        evaluator = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name)
        assert ours[name.upper()] == pytest.approx(evaluator.evaluate(df))


def test_comparison(spark):
    metrics = P.stack_models({
        P.FULL: spark.createDataFrame([("R2", 0.6)], "metric string, value double"),
        P.AUDIO: spark.createDataFrame([("R2", 0.2)], "metric string, value double"),
    })
    row = P.compare_models(metrics).first()
    assert row["drop"] == pytest.approx(0.4)


def test_forest_learns_and_reports(spark):
    df = spark.range(2000).select(
        F.concat(F.lit("g"), F.col("id") % 149).alias("genre"),
        ((F.col("id") % 10) * 10).cast("string").alias("popularity"),
        (F.col("id") % 10).cast("string").alias("energy"),
        F.when(F.col("id") % 9 > 0, F.col("id") % 3).cast("string").alias("tempo"),
        F.col("id").cast("string").alias("track_name"),
    )
    features = P.FeatureSet(["energy", "tempo", "absent"], "genre")
    train, test = P.hash_split(P.prepare(df, features), ["track_name"])
    model = P.fit_popularity(train, features, settings=P.ForestSettings(trees=20, depth=6))
    scored = P.score(model, test)
    assert scored.count() == test.count()
    metrics = dict(rows(P.regression_metrics(scored, "popularity", "predicted_popularity")))
    assert metrics["R2"] > 0.5
    table = rows(P.importance_table(model, spark), "rank")
    assert table[0][0] == "energy" and [r[2] for r in table] == [1, 2, 3]
    assert sum(r[1] for r in table) == pytest.approx(1.0)
    assert P.prediction_table(scored).columns == [
        "track_name", "genre", "popularity", "predicted_popularity", "energy"
    ]


def test_feature_counts():
    assert len(P.FULL_FEATURES.names()) == 23 and len(P.AUDIO_FEATURES.names()) == 13


def test_forest_on_stored_vectors_is_that_of_one_pipeline(spark):
    drawn = spark.range(400, numPartitions=1).selectExpr(
        "cast(id % 37 as int) as popularity", "if(id % 9 = 0, null, id % 37 / 2) as x",
        "cast(id % 11 as double) as y", "if(id % 5 = 0, null, concat('g', id % 3)) as genre")
    features = P.FeatureSet(["x", "y"], "genre")
    train = P.prepare(drawn, features)
    small = P.ForestSettings(trees=3, depth=3)
    scored = P.score(P.fit_popularity(train, features, settings=small), train)
    whole = Pipeline(stages=[
        P.category_index(train, "genre"), P.mean_imputer(["x", "y"]),
        P.assembler(["x_imp", "y_imp", "genre_index"]),
        RandomForestRegressor(
            featuresCol="features", labelCol="popularity", predictionCol="predicted_popularity",
            numTrees=3, maxDepth=3, maxBins=small.bins, seed=small.seed),
    ]).fit(train)
    assert rows(scored) == rows(whole.transform(train).select(scored.columns))
    # The target alone is looked at for being there; imputed inputs always are.
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("atleastnnonnulls(") <= 1


def test_forests_store_the_columns_they_read_and_leave_no_shuffle_files(spark, monkeypatch):
    from trackmart.queries import models

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    columns = [*dict.fromkeys([*P.schemas.MODEL_COLUMNS])]
    made = spark.createDataFrame([(1,) * len(columns)], ", ".join(f"{c} int" for c in columns))
    stored = []

    def store(df, name):
        stored.append((set(df.columns), spark.conf.get(setting)))
        return df

    monkeypatch.setattr(models, "master", lambda *_, **__: made)
    monkeypatch.setattr(models, "written", store)
    before = spark.conf.get(setting)
    keys = {"track_id", "track_name", "popularity"}
    models._stored_rows(spark, "none", P.AUDIO_FEATURES)
    models._stored_rows(spark, "none", P.FULL_FEATURES, P.schemas.PREDICTION_COLUMNS)
    audio, full = {*P.AUDIO_FEATURES.numeric}, {*P.FULL_FEATURES.numeric, "genre", "artist_name"}
    assert stored == [(keys | audio, "true"), (keys | full, "true")]
    assert spark.conf.get(setting) == before
