"""Scorers, the decision on a score, and scoring of profiles.

A scorer is any callable that takes a DataFrame of model inputs and adds ``churn_score``, the
probability of termination, as a double.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subscriber_analytics.functions.columns import decision, risk_tier
from subscriber_analytics.operators.constraints import (
    REASON, enforce_constraints, validate_profiles,
)
from subscriber_analytics.operators.features import add_features, model_inputs, read_leniently
from subscriber_analytics.schemas import SCORE_LOG_RULES
from subscriber_analytics.session import work_dir

Scorer = Callable[[DataFrame], DataFrame]

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class LogitScorer:
    """Logistic regression as one Column expression: no Python worker, no shuffle.

    ``numeric`` maps a column to its weight (NULL counts as 0), ``categorical`` maps a column to the
    weights of its values (other values and NULL count as 0).
    """

    intercept: float
    numeric: Mapping[str, float] = field(default_factory=dict)
    categorical: Mapping[str, Mapping[str, float]] = field(default_factory=dict)

    @classmethod
    def from_table(cls, coefficients: DataFrame) -> LogitScorer:
        """Read a coefficients table ``(feature, level, weight)``. ``level`` is NULL for a numeric
        feature, and the feature ``intercept`` is the constant."""
        rows = coefficients.select("feature", "level", "weight").collect()
        intercept, numeric, categorical = 0.0, {}, {}
        for feature, level, weight in rows:
            if level is not None:
                categorical.setdefault(feature, {})[level] = weight
            elif feature == "intercept":
                intercept = weight
            else:
                numeric[feature] = weight
        return cls(intercept, numeric, categorical)

    def to_table(self, spark: SparkSession) -> DataFrame:
        """The coefficients table that ``from_table`` reads."""
        rows = [("intercept", None, float(self.intercept))]
        rows += [(name, None, float(weight)) for name, weight in self.numeric.items()]
        rows += [(name, level, float(w)) for name, weights in self.categorical.items() for level, w in weights.items()]
        return spark.createDataFrame(rows, "feature string, level string, weight double")

    def probability(self) -> Column:
        z = F.lit(float(self.intercept))
        for name, weight in self.numeric.items():
            z = z + F.lit(float(weight)) * F.coalesce(F.col(name).cast("double"), F.lit(0.0))
        for name, weights in self.categorical.items():
            # One literal map, folded when the query is planned: its size adds nothing to the plan's depth.
            table = F.from_json(F.lit(json.dumps({k: float(w) for k, w in weights.items()})), "map<string,double>")
            z = z + F.coalesce(F.try_element_at(table, F.col(name).cast("string")), F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-z))

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.withColumn("churn_score", self.probability())


@dataclass(frozen=True)
class PipelineScorer:
    """A fitted ``spark.ml`` pipeline that ends in a probabilistic binary classifier."""

    model: PipelineModel

    def __call__(self, df: DataFrame) -> DataFrame:
        scored = self.model.transform(df)
        probability = vector_to_array(F.col("probability"))[1]
        return scored.select(*df.columns, probability.alias("churn_score"))


def fit_pipeline(training: DataFrame, label: str, numeric: Sequence[str], categorical: Mapping[str, Sequence[str]],
                 strength: float = 0.01) -> PipelineModel:
    """A logistic regression over model inputs, as a ``spark.ml`` pipeline.

    ``numeric`` names number columns (NULL counts as 0), ``categorical`` the levels of text columns that get a weight;
    other levels and NULL have none. ``label`` is 1 for a termination. Rows without a label are left out.

    The model comes back from a file, without the summary of its training: that one holds the session, which
    Spark cannot send to tasks once a frame of it was observed.
    """
    parts = [f"coalesce(CAST(`{name}` AS DOUBLE), 0.0)" for name in numeric]
    for name, levels in categorical.items():
        texts = [level.replace("\\", "\\\\").replace("'", "\\'") for level in levels]
        parts += [f"CASE WHEN `{name}` = '{text}' THEN 1.0D ELSE 0.0D END" for text in texts]
    named = ", ".join(f"{part} AS _x{n}" for n, part in enumerate(parts))
    stages = [
        SQLTransformer(statement=f"SELECT *, {named} FROM __THIS__"),
        VectorAssembler(inputCols=[f"_x{n}" for n in range(len(parts))], outputCol="features"),
        LogisticRegression(labelCol=label, regParam=strength),
    ]
    path = work_dir(training.sparkSession, "model")
    Pipeline(stages=stages).fit(training.filter(F.col(label).isNotNull())).write().save(path)
    return PipelineModel.load(path)


def logit_of(model: PipelineModel, numeric: Sequence[str], categorical: Mapping[str, Sequence[str]]) -> LogitScorer:
    """The weights of ``fit_pipeline`` as a scorer without ``spark.ml``; the names are those of the fit."""
    fitted = model.stages[-1]
    weights = [float(w) for w in fitted.coefficients]
    rest = iter(weights[len(numeric):])
    return LogitScorer(
        float(fitted.intercept), dict(zip(numeric, weights, strict=False)),
        {name: {level: next(rest) for level in levels} for name, levels in categorical.items()})


def load_scorer(primary: str, fallback: str) -> PipelineScorer:
    """Load the pipeline at ``primary`` and refresh the copy at ``fallback``; if that fails, load
    the copy. Call once and reuse the scorer for every batch."""
    try:
        model = PipelineModel.load(primary)
    except Exception as failure:
        try:
            return PipelineScorer(PipelineModel.load(fallback))
        except Exception:
            raise RuntimeError(f"no model at {primary} and none at {fallback}") from failure
    _refresh(lambda: model.write().overwrite().save(fallback), fallback)
    return PipelineScorer(model)


def _refresh(save: Callable[[], None], fallback: str) -> None:
    """A copy that cannot be written is no reason to go without the model that was read."""
    try:
        save()
    except Exception:
        log.warning("the copy at %s was not refreshed", fallback, exc_info=True)


def load_coefficients(spark: SparkSession, primary: str, fallback: str) -> LogitScorer:
    """The same for a Parquet coefficients table."""
    try:
        table = spark.read.parquet(primary)
        scorer = LogitScorer.from_table(table)
    except Exception as failure:
        try:
            return LogitScorer.from_table(spark.read.parquet(fallback))
        except Exception:
            raise RuntimeError(f"no model at {primary} and none at {fallback}") from failure
    _refresh(lambda: table.write.mode("overwrite").parquet(fallback), fallback)
    return scorer


def to_score_log(scored: DataFrame, threshold: float = 0.5, model_name: str = "churn_model",
                 model_version: str = "1") -> DataFrame:
    """Scored rows as score log rows, with a reason on those that break a rule.

    The decision uses the unrounded score, the log keeps four decimals. ``predicted_ts`` is the frame's
    own if it has one, else the current time.
    """
    now = F.col("predicted_ts") if "predicted_ts" in scored.columns else F.current_timestamp()
    rows = scored.withColumns({
        "churn_predicted": decision("churn_score", threshold),
        "seuil_applique": F.lit(float(threshold)),
        "model_name": F.lit(model_name),
        "model_version": F.lit(model_version),
        "predicted_ts": now,
    })
    extra = ["arrival"] if "arrival" in scored.columns else []
    rows = rows.select(*[rule.name for rule in SCORE_LOG_RULES], *extra)
    return enforce_constraints(rows, SCORE_LOG_RULES)


def score_profiles(profiles: DataFrame, scorer: Scorer, threshold: float = 0.5,
                   keep: tuple[str, ...] = (), tier_from_stored: bool = True) -> DataFrame:
    """Score profiles that are not saved, each row on its own. An invalid one has no score, no
    decision and no tier, but its ``reject_reason``.

    The tier follows the four-decimal score that is shown, as it does in the log, or with
    ``tier_from_stored=False`` the unrounded one. ``keep`` names columns to carry along.
    """
    checked = validate_profiles(profiles)
    # A scorer never sees what made a row invalid: its numbers become 0.
    numbers = [name for name, kind in checked.dtypes if kind in ("int", "bigint", "float", "double") and name not in keep]
    good = F.col(REASON).isNull()
    checked = checked.withColumns({
        name: F.when(good, F.col(name)).otherwise(F.lit(0)).cast(kind) for name, kind in checked.dtypes if name in numbers})
    scored = scorer(model_inputs(add_features(read_leniently(checked)), (*keep, REASON)))
    scored = scored.withColumn("churn_score", F.when(good & ~F.isnan("churn_score"), F.col("churn_score")))
    shown = F.round("churn_score", 4)
    return scored.select(
        *keep,
        shown.alias("churn_score"),
        (F.col("churn_score") >= threshold).alias("churn_predicted"),
        F.when(shown.isNotNull(), risk_tier(shown if tier_from_stored else "churn_score")).alias("niveau_risque"),
        F.lit(float(threshold)).alias("seuil_applique"),
        REASON,
    )
