"""Business reports.

Every report takes the latest state (``latest_state``) or the customer view (``customer_360``), so
that several reports can share one materialised input. Groups are few (contracts, bands, months), so
each aggregation is partial per task first and shuffles only group rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscriber_analytics.functions.columns import (
    HIGH_RISK, as_of_timestamp, churn_rate, count_yes, exact_mean, exact_median, is_yes,
)
from subscriber_analytics.operators.state import checked_limit, join_360, latest_score, latest_state
from subscriber_analytics.schemas import SERVICE_COLUMNS

MAX_RISK_ROWS = 500


def _rows() -> Column:
    return F.count(F.lit(1))


def actual_vs_predicted(view_360: DataFrame) -> DataFrame:
    """Outcome against prediction of the scored customers, per model version. An unknown outcome
    counts as a wrong prediction."""
    right = is_yes("churn_observe").cast("int") == F.col("churn_predicted")
    return (
        view_360.filter(F.col("churn_score").isNotNull())
        .groupBy("model_version")
        .agg(
            _rows().alias("clients_evalues"),
            F.count_if(is_yes("churn_observe")).alias("actual_churns"),
            F.count_if(F.col("churn_predicted") == 1).alias("predicted_churns"),
            exact_mean(F.when(right, 1).otherwise(0), 4).alias("accuracy_live"),
            exact_mean("churn_score", 4).alias("score_moyen"),
        )
    )


def predicted_churners(view_360: DataFrame) -> DataFrame:
    """All customers whose last score predicts termination, in no order."""
    return view_360.filter(F.col("churn_predicted") == 1).select(
        "customer_id", "churn_score", "niveau_risque", "contract", "tenure",
        F.col("monthly_charges").alias("mrr"), "signup_date", "predicted_ts",
    )


def customers_at_risk(view_360: DataFrame, n: int = 50, cap: int = MAX_RISK_ROWS) -> DataFrame:
    """The ``n`` predicted churners with the highest scores; ties by customer. More than ``cap`` is an error."""
    order = (F.desc("churn_score"), F.col("customer_id"))
    return predicted_churners(view_360).orderBy(*order).limit(checked_limit(n, cap))


def _window_start(as_of, hours: int) -> Column:
    return as_of_timestamp(as_of) - F.make_dt_interval(hours=F.lit(int(hours)))


def live_kpis(view_360: DataFrame, as_of=None, hours: int = 24) -> DataFrame:
    """One row about the customers whose last score is at most ``hours`` old.

    The view has one row per customer, so predictions and customers are the same number.
    """
    recent = view_360.filter(F.col("predicted_ts") >= _window_start(as_of, hours))
    return recent.agg(
        _rows().alias("nb_predictions_24h"),
        F.count_distinct("customer_id").alias("nb_clients_24h"),
        exact_mean("churn_score", 4).alias("score_moyen_24h"),
        exact_mean("churn_predicted", 4).alias("taux_churn_predit_24h"),
        F.count_if(F.col("churn_score") >= HIGH_RISK).alias("nb_risque_eleve_24h"),
        F.round(F.sum(F.when(F.col("churn_predicted") == 1, F.col("monthly_charges"))), 2).alias(
            "mrr_a_risque_24h"
        ),
        F.max("predicted_ts").alias("derniere_prediction_ts"),
    )


def live_kpis_from_logs(events: DataFrame, scores: DataFrame, as_of=None, hours: int = 24,
                        day_column: str | None = None) -> DataFrame:
    """``live_kpis`` that reads only the window of the score log.

    A customer's last score lies in the window if any score does, and is then the last one in it. So
    the window can be cut from the log before the latest scores are found, and the events to the
    customers of the window before their latest state is. ``day_column`` names a
    partition column with the date of ``predicted_ts`` (``ingest_date`` in our log); files of older
    days are then not opened.
    """
    start = _window_start(as_of, hours)
    recent = scores.filter(F.col("predicted_ts") >= start)
    if day_column is not None:
        recent = recent.filter(F.col(day_column) >= start.cast("date"))
    last = latest_score(recent)
    concerned = events.join(last.select("customer_id"), "customer_id", "left_semi")
    return live_kpis(join_360(latest_state(concerned), last, as_of), as_of, hours)


def rate_by(state: DataFrame, column: str = "contract") -> DataFrame:
    """Customers, churners and churn rate per value of a column; NULL is a group."""
    return state.groupBy(column).agg(
        _rows().alias("nb_clients"),
        F.count_if(is_yes("churn")).alias("nb_churn"),
        churn_rate().alias("taux_churn"),
    )


def rate_by_contract(state: DataFrame) -> DataFrame:
    """``rate_by("contract")``, highest rate first, unknown rates before all others."""
    return rate_by(state, "contract").orderBy(F.desc_nulls_first("taux_churn"), "contract")


def rate_by_tenure(state: DataFrame, low: int = 0, high: int = 72, bands: int = 12) -> DataFrame:
    """Customers and churn rate per tenure band. Bands 0 and ``bands + 1`` hold what lies below and
    above; NULL is a band of its own, the last."""
    band = F.width_bucket("tenure", F.lit(low), F.lit(high), F.lit(bands)).cast("int")
    return (
        state.groupBy(band.alias("tranche"))
        .agg(
            F.min("tenure").alias("borne_basse"),
            F.max("tenure").alias("borne_haute"),
            _rows().alias("nb_clients"),
            churn_rate().alias("taux_churn"),
        )
        .orderBy(F.asc_nulls_last("tranche"))
    )


def rate_by_services(state: DataFrame) -> DataFrame:
    """Customers and churn rate per number of subscribed services."""
    return (
        state.groupBy(count_yes(SERVICE_COLUMNS).alias("nb_services"))
        .agg(_rows().alias("nb_clients"), churn_rate().alias("taux_churn"))
        .orderBy("nb_services")
    )


def _days_to_churn() -> Column:
    return F.datediff("churn_date", "signup_date")


def cohort_retention(state: DataFrame) -> DataFrame:
    """Size, churners, churn rate and mean days to termination per month of signup."""
    return (
        state.filter(F.col("signup_date").isNotNull())
        .groupBy(F.trunc("signup_date", "month").alias("mois_cohorte"))
        .agg(
            _rows().alias("taille_cohorte"),
            F.count_if(is_yes("churn")).alias("churners"),
            churn_rate().alias("taux_churn_cohorte"),
            exact_mean(_days_to_churn(), 1).alias("duree_moy_avant_churn_jours"),
        )
        .orderBy("mois_cohorte")
    )


def recent_cohorts(state: DataFrame, n: int = 12) -> DataFrame:
    """The newest ``n`` cohorts, newest first."""
    return cohort_retention(state).orderBy(F.desc("mois_cohorte")).limit(n)


def churn_velocity(state: DataFrame) -> DataFrame:
    """Mean and median days from signup to termination per contract. Days can be negative."""
    gone = is_yes("churn") & F.col("churn_date").isNotNull() & F.col("signup_date").isNotNull()
    return (
        state.filter(gone)
        .groupBy("contract")
        .agg(
            _rows().alias("nb_churners"),
            exact_mean(_days_to_churn(), 1).alias("delai_moyen_jours"),
            exact_median(_days_to_churn(), 1).alias("delai_median_jours"),
        )
    )


def weekly_trend(state: DataFrame) -> DataFrame:
    """Terminations and their mean monthly charges per week, from Monday."""
    return (
        state.filter(is_yes("churn") & F.col("churn_date").isNotNull())
        .groupBy(F.trunc("churn_date", "week").alias("semaine"))
        .agg(
            _rows().alias("nb_churns"),
            exact_mean("monthly_charges", 2).alias("mrr_moyen_perdu"),
        )
        .orderBy("semaine")
    )


def base_summary(state: DataFrame) -> DataFrame:
    """One row about the whole customer base."""
    return state.agg(
        _rows().alias("clients_en_base"),
        churn_rate().alias("taux_churn_observe"),
        F.count_if(is_yes("churn")).alias("nb_resiliations"),
        F.round(F.sum("monthly_charges").cast("decimal(30,2)") / F.lit(1_000_000), 2)
        .cast("decimal(20,2)").alias("mrr_total_meur"),
        exact_mean("monthly_charges", 2).alias("mrr_moyen"),
        exact_mean("tenure", 1).alias("anciennete_moyenne"),
        exact_median("tenure", 1).alias("anciennete_mediane"),
    )


# The grouped reports of the dashboard: the column they group by, and their columns by those of ``all_rates``.
GROUPED_REPORTS = {
    "contract": {"contract": "contract", "nb_clients": "nb_clients", "nb_churn": "nb_churn", "taux_churn": "taux_churn"},
    "tranche": {"tranche": "tranche", "borne_basse": "borne_basse", "borne_haute": "borne_haute", "nb_clients": "nb_clients",
                "taux_churn": "taux_churn"},
    "nb_services": {"nb_services": "nb_services", "nb_clients": "nb_clients", "taux_churn": "taux_churn"},
    "mois_cohorte": {"mois_cohorte": "mois_cohorte", "nb_clients": "taille_cohorte", "nb_churn": "churners",
                     "taux_churn": "taux_churn_cohorte", "duree_moyenne_jours": "duree_moy_avant_churn_jours"},
    "semaine": {"semaine": "semaine", "nb_clients": "nb_churns", "mrr_moyen": "mrr_moyen_perdu"},
}
WHOLE_BASE = "base"


def all_rates(state: DataFrame, low: int = 0, high: int = 72, bands: int = 12) -> DataFrame:
    """The grouped reports and the whole base in one pass over the latest state, as grouping sets.

    ``rapport`` names the column that a row is grouped by, the other group columns are NULL. Partial sums
    come before the shuffle, so only group rows move: the state is read, and found, once for all reports.
    """
    gone = is_yes("churn") & F.col("churn_date").isNotNull()
    rows = state.select(
        "contract", F.width_bucket("tenure", F.lit(low), F.lit(high), F.lit(bands)).cast("int").alias("tranche"),
        count_yes(SERVICE_COLUMNS).alias("nb_services"), F.trunc("signup_date", "month").alias("mois_cohorte"),
        F.when(gone, F.trunc("churn_date", "week")).alias("semaine"),
        "churn", "tenure", "monthly_charges", _days_to_churn().alias("jours"))
    names = list(GROUPED_REPORTS)
    report = F.lit(WHOLE_BASE)
    for place, name in enumerate(reversed(names)):
        # All bits of the grouping id are set but that of the column a row is grouped by.
        report = F.when(F.grouping_id(*names) == (1 << len(names)) - 1 - (1 << place), name).otherwise(report)
    sets = [[F.col(name)] for name in names] + [[]]
    grouped = rows.groupingSets(sets, *[F.col(name) for name in names]).agg(
        report.alias("rapport"), _rows().alias("nb_clients"), F.count_if(is_yes("churn")).alias("nb_churn"),
        churn_rate().alias("taux_churn"), F.min("tenure").alias("borne_basse"), F.max("tenure").alias("borne_haute"),
        exact_mean("jours", 1).alias("duree_moyenne_jours"), exact_mean("monthly_charges", 2).alias("mrr_moyen"))
    # Customers without a signup date or a termination are in no cohort and no week.
    return grouped.filter(
        ~((F.col("rapport") == "mois_cohorte") & F.col("mois_cohorte").isNull())
        & ~((F.col("rapport") == "semaine") & F.col("semaine").isNull()))


def grouped_report(rates: DataFrame, by: str) -> DataFrame:
    """One of the grouped reports, in no order, from (a stored) ``all_rates``."""
    chosen = GROUPED_REPORTS[by]
    return rates.filter(F.col("rapport") == by).select(*[F.col(own).alias(name) for own, name in chosen.items()])


def placed(report: DataFrame) -> DataFrame:
    """An ordered report with the place of each row, from 1. For reports of a few rows: they go through one task."""
    return report.coalesce(1).withColumn("place", F.monotonically_increasing_id() + 1)


def first_row(df: DataFrame) -> DataFrame:
    """The first row of a report, or none."""
    return df.limit(1)
