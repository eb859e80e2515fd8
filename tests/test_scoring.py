import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Observation
from pyspark.sql import functions as F

from subscriber_analytics import fixtures as fx
from subscriber_analytics.operators import features, scoring
from tests.helpers import values


def test_features_of_edge_tenures(spark):
    df = spark.createDataFrame([(t,) for t in (-1, 0, 5, 6, 72, None)], "tenure int")
    assert [r[0] for r in values(features.add_features(df), "NewClient")] == [1, 1, 1, 0, 0, 0]
    df = spark.createDataFrame([(float("nan"),), (5.5,)], "tenure double")
    assert [r[0] for r in values(features.add_features(df), "NewClient")] == [0, 1]


def test_only_present_columns_give_features(spark):
    df = spark.createDataFrame([("Yes", "No internet service")], "TechSupport string, StreamingTV string")
    assert features.add_features(df).columns == ["TechSupport", "StreamingTV", "NbServices"]
    assert values(features.add_features(df), "NbServices") == [(1,)]
    plain = spark.createDataFrame([(1,)], "x int")
    assert features.add_features(plain).columns == ["x"]


def test_cleaning(spark):
    df = spark.createDataFrame(
        [("a", " 12.5 ", 2), ("a", "bad", 1), ("b", "", 3)],
        "` customerID` string, `TotalCharges ` string, n int")
    got = values(features.clean_profiles(df, ["n"]), "customerID", "TotalCharges", "n")
    assert sorted(got) == [("a", None, 1), ("b", None, 3)]
    with pytest.raises(ValueError):
        features.clean_profiles(df)


def test_model_inputs_drop_if_present(spark):
    df = spark.createDataFrame([("a", "Yes", 1)], "customerID string, Churn string, tenure int")
    assert features.model_inputs(df).columns == ["tenure"]
    assert features.model_inputs(df, ["customerID"]).columns == ["customerID", "tenure"]


def test_logit(spark):
    scorer = scoring.LogitScorer(-1.0, {"x": 0.5}, {"k": {"a": 2.0, "b": -1.0}})
    df = spark.createDataFrame(
        [(2.0, "a"), (None, "b"), (1.0, None), (1e6, "a"), (-1e6, "a")], "x double, k string")
    got = [r[0] for r in values(scorer(df), "churn_score")]
    expected = [1 / (1 + math.exp(-z)) for z in (2.0, -2.0, -0.5)] + [1.0, 0.0]
    assert got == pytest.approx(expected)


def test_coefficients_table_and_its_copy(spark, tmp_path):
    table = spark.createDataFrame(
        [("intercept", None, -1.0), ("x", None, 0.5), ("k", "a", 2.0)],
        "feature string, level string, weight double")
    primary, copy = str(tmp_path / "primary"), str(tmp_path / "copy")
    with pytest.raises(RuntimeError):
        scoring.load_coefficients(spark, primary, copy)
    table.write.parquet(primary)
    expected = scoring.LogitScorer(-1.0, {"x": 0.5}, {"k": {"a": 2.0}})
    assert scoring.load_coefficients(spark, primary, copy) == expected
    assert scoring.load_coefficients(spark, str(tmp_path / "gone"), copy) == expected


@pytest.fixture(scope="module")
def training(spark, sf_dir):
    state = fx.order_events(spark, sf_dir).filter("churn IS NOT NULL")
    named = features.add_features(features.to_training_names(state))
    return named.select(
        "Contract", F.coalesce("tenure", F.lit(0)).alias("tenure"), "NbServices",
        F.col("MonthlyCharges").cast("double").alias("MonthlyCharges"),
        (F.col("Churn") == "Yes").cast("double").alias("label"))


def test_pipeline_scorer_and_its_fallback(spark, training, tmp_path):
    model = Pipeline(stages=[
        StringIndexer(inputCol="Contract", outputCol="c", handleInvalid="keep"),
        OneHotEncoder(inputCol="c", outputCol="cv"),
        VectorAssembler(inputCols=["cv", "tenure", "NbServices", "MonthlyCharges"], outputCol="features"),
        LogisticRegression(maxIter=5),
    ]).fit(training)
    primary, copy = str(tmp_path / "primary"), str(tmp_path / "copy")
    with pytest.raises(RuntimeError):
        scoring.load_scorer(primary, copy)
    model.write().save(primary)
    scored = scoring.load_scorer(primary, copy)(training)
    assert scored.columns == training.columns + ["churn_score"]
    low, high, n = values(scored.agg(F.min("churn_score"), F.max("churn_score"), F.count("churn_score")), "*")[0]
    assert 0 <= low < high <= 1 and n == training.count()
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    again = scoring.load_scorer(str(tmp_path / "gone"), copy)(training)
    assert values(again.agg(F.sum("churn_score")), "*")[0][0] == pytest.approx(
        values(scored.agg(F.sum("churn_score")), "*")[0][0])


def test_decision_uses_the_unrounded_score(spark):
    df = spark.createDataFrame(
        [("a", 0.49995), ("b", 0.5), ("c", 0.69996)], "customer_id string, churn_score double")
    df = df.withColumn("event_ts", F.lit("2024-01-01").cast("timestamp"))
    rows = scoring.to_score_log(df, 0.5, "m", "7")
    got = values(rows, "customer_id", F.col("churn_score").cast("string"), "churn_predicted",
                 F.col("seuil_applique").cast("string"), "model_name", "model_version", "reject_reason")
    assert got == [("a", "0.5000", 0, "0.500", "m", "7", None),
                   ("b", "0.5000", 1, "0.500", "m", "7", None),
                   ("c", "0.7000", 1, "0.500", "m", "7", None)]


def test_profile_scores_and_tiers(spark):
    df = spark.createDataFrame(
        [(1, 10, 0.0, 1.0, "a"), (2, 10, 0.0, 1.0, "a"), (3, 200, 0.0, 1.0, "b")],
        "n int, tenure int, MonthlyCharges double, TotalCharges double, customerID string")
    def scorer(inputs):
        assert "customerID" not in inputs.columns
        return inputs.withColumn("churn_score", F.lit(0.69996))
    got = values(scoring.score_profiles(df, scorer, keep=("n",)), "*")
    assert got == [(1, 0.7, True, "ELEVE", 0.5, None), (2, 0.7, True, "ELEVE", 0.5, None),
                   (3, None, None, None, 0.5, "tenure: out of range")]
    exact = scoring.score_profiles(df, scorer, threshold=0.8, keep=("n",), tier_from_stored=False)
    assert values(exact, "*")[0] == (1, 0.7, False, "MOYEN", 0.8, None)


def test_many_levels_are_one_lookup(spark):
    scorer = scoring.LogitScorer(0.0, {}, {"c": {f"v{k}": k / 20_000 for k in range(20_000)}})
    df = spark.createDataFrame([("v19999",), ("other",), (None,)], "c string")
    got = [r["churn_score"] for r in scorer(df).collect()]
    assert [round(x, 6) for x in got] == [round(1 / (1 + 2.718281828459045 ** -0.99995), 6), 0.5, 0.5]


def test_a_copy_that_cannot_be_written_does_not_stop_loading(spark, tmp_path):
    path = str(tmp_path / "model")
    spark.createDataFrame([("intercept", None, 1.0)], "feature string, level string, weight double").write.parquet(path)
    (tmp_path / "blocked").write_text("a file")
    scorer = scoring.load_coefficients(spark, path, str(tmp_path / "blocked" / "copy"))
    assert scorer.intercept == 1.0


def test_fitted_pipeline_and_its_own_weights(spark):
    from subscriber_analytics.operators.scoring import LogitScorer, PipelineScorer, fit_pipeline, logit_of

    rows = [(float(k % 40), "One year" if k % 3 else "Two year", None if k % 50 == 0 else float(k % 40 < 15)) for k in range(400)]
    training = spark.createDataFrame(rows, "tenure double, Contract string, label double")
    names, levels = ("tenure",), {"Contract": ("Two year", "it's")}
    model = fit_pipeline(training, "label", names, levels)
    own = logit_of(model, names, levels)
    assert own.numeric["tenure"] < 0 and set(own.categorical["Contract"]) == set(levels["Contract"])
    inputs = spark.createDataFrame([(1.0, "Two year"), (None, None), (39.0, "it's")], "tenure double, Contract string")
    first, second = (sorted(r["churn_score"] for r in s(inputs).collect()) for s in (PipelineScorer(model), own))
    assert max(abs(a - b) for a, b in zip(first, second)) < 1e-12 and first[-1] - first[0] > 0.1
    again = LogitScorer.from_table(own.to_table(spark))
    assert again == own


def test_a_fresh_fit_scores_in_a_session_with_observed_frames(spark):
    seen = Observation("seen")
    spark.range(10).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get == {"n": 10}
    training = spark.createDataFrame([(float(k), float(k < 5)) for k in range(20)], "tenure double, label double")
    scored = scoring.PipelineScorer(scoring.fit_pipeline(training, "label", ("tenure",), {}))(training)
    assert [r["churn_score"] > 0.5 for r in scored.sort("tenure").collect()] == [True] * 5 + [False] * 15
