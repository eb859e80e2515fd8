"""Summary of scored batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscriber_analytics.functions.columns import exact_mean
from subscriber_analytics.operators.constraints import REASON


def metric_columns(accepted: Column | None = None) -> list[Column]:
    """Stored scores, positive decisions among them, and their mean.

    The decision was made on the unrounded score, which the stored one cannot give back.
    """
    accepted = F.lit(True) if accepted is None else accepted
    return [
        F.count_if(accepted).alias("nb_scores"),
        F.count_if(accepted & (F.col("churn_predicted") == 1)).alias("nb_a_risque"),
        exact_mean("churn_score", 3, accepted).alias("score_moyen"),
    ]


def batch_metrics(scores: DataFrame, by: Sequence[str] = ("batch_id",)) -> DataFrame:
    """Per batch: scored rows, decisions for termination, mean score. Rejected rows do not count."""
    accepted = F.col(REASON).isNull() if REASON in scores.columns else None
    return scores.groupBy(*by).agg(*metric_columns(accepted))
