"""The logs and reports as SQL views, and parameterised queries on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscriber_analytics.operators.state import join_360, latest_score, latest_state
from subscriber_analytics.plans import reports


def register_views(events: DataFrame, scores: DataFrame, as_of=None,
                   state: DataFrame | None = None) -> None:
    """Register both logs and the twelve views as temporary views of the session.

    Views are plans, not copies: each query reads the logs anew, with only the columns it needs.
    ``state`` replaces the latest state, for instance with one that was written out by
    ``materialize``.
    """
    state = latest_state(events) if state is None else state
    last_score = latest_score(scores)
    full = join_360(state, last_score, as_of)
    # The view names that existing dashboards query.
    views = {
        "churn_data": events,
        "churn_model": scores,
        "v_churn_data_dernier_etat": state,
        "v_dernier_score": last_score,
        "v_analyse_complete": full,
        "v_actuals_vs_predictions": reports.actual_vs_predicted(full),
        "v_clients_risque": reports.predicted_churners(full).orderBy(F.desc("churn_score")),
        "v_kpis_live": reports.live_kpis(full, as_of),
        "v_churn_par_contrat": reports.rate_by(state, "contract"),
        "v_churn_par_tenure": reports.rate_by_tenure(state),
        "v_churn_par_services": reports.rate_by_services(state),
        "v_cohortes_retention": reports.cohort_retention(state),
        "v_velocite_churn": reports.churn_velocity(state),
        "v_tendance_churn_hebdo": reports.weekly_trend(state),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)


def query(spark: SparkSession, sql: str, **parameters) -> DataFrame:
    """Run SQL with named parameters (``:name``). Values are bound, never pasted into the text."""
    return spark.sql(sql, args=parameters)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write a shared input such as the latest state once, and read it back for several reports."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
