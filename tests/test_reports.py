from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from subscriber_analytics.plans import reports, views
from tests.helpers import at, values

VIEW = ("customer_id string, churn_observe string, churn_score decimal(5,4), "
        "churn_predicted smallint, model_version string, predicted_ts timestamp, "
        "monthly_charges decimal(8,2), niveau_risque string, contract string, tenure int, "
        "signup_date date")


def D(text):
    return Decimal(text)


def _view(spark, rows):
    full = [(f"c{i}", label, s and D(s), p, version, t and at(t), m and D(m), None, None, None, None)
            for i, (label, s, p, version, t, m) in enumerate(rows)]
    return spark.createDataFrame(full, VIEW)


def test_unknown_label_counts_as_wrong(spark):
    view = _view(spark, [
        ("Yes", "0.9", 1, "1", None, None), ("No", "0.1", 0, "1", None, None),
        (None, "0.1", 0, "1", None, None), (None, "0.9", 1, "1", None, None),
        ("Yes", "0.2", 0, "2", None, None), ("Yes", None, None, None, None, None)])
    assert sorted(values(reports.actual_vs_predicted(view), "*")) == [
        ("1", 4, 1, 2, D("0.5000"), D("0.5000")), ("2", 1, 1, 0, D("0.0000"), D("0.2000"))]


def test_kpi_window_is_inclusive_and_always_one_row(spark):
    view = _view(spark, [
        ("No", "0.7", 1, "1", "2024-01-01 00:00:00", "10.10"),
        ("No", "0.6999", 1, "1", "2024-01-01 12:00:00", None),
        ("No", "0.1", 0, "1", "2024-01-02 00:00:00", "99.00"),
        ("No", "0.9", 1, "1", "2023-12-31 23:59:59.999999", "50.00"),
        ("No", None, None, None, None, "1.00")])
    got = values(reports.live_kpis(view, "2024-01-02 00:00:00"), "*")
    assert got == [(3, 3, D("0.5000"), D("0.6667"), 1, D("10.10"), at("2024-01-02 00:00:00"))]
    empty = values(reports.live_kpis(view, "2030-01-01 00:00:00"), "*")
    assert empty == [(0, 0, None, None, 0, None, None)]


def test_at_risk_order_and_limit(spark):
    view = _view(spark, [("No", s, p, "1", None, None) for s, p in (
        ("0.6", 1), ("0.9", 1), ("0.9", 1), ("0.95", 0), (None, None))])
    assert [r[0] for r in values(reports.customers_at_risk(view), "customer_id")] == [
        "c1", "c2", "c0"]
    assert reports.customers_at_risk(view, 2).count() == 2
    with pytest.raises(ValueError):
        reports.customers_at_risk(view, -1)


STATE = ("customer_id string, contract string, tenure int, churn string, signup_date date, "
         "churn_date date, monthly_charges decimal(8,2)")


def _state(spark, rows):
    text = "customer_id string, contract string, tenure int, churn string, s string, c string, m string"
    df = spark.createDataFrame([(f"c{i}", *row) for i, row in enumerate(rows)], text)
    return df.select(
        "customer_id", "contract", "tenure", "churn", F.col("s").cast("date").alias("signup_date"),
        F.col("c").cast("date").alias("churn_date"),
        F.col("m").cast("decimal(8,2)").alias("monthly_charges"))


def test_tenure_bands(spark):
    tenures = [-1, 0, 5, 6, 71, 72, 100, None]
    state = _state(spark, [("x", t, "Yes" if t == 5 else "No", None, None, None) for t in tenures])
    got = values(reports.rate_by_tenure(state), "*")
    assert got == [
        (0, -1, -1, 1, D("0.0000")), (1, 0, 5, 2, D("0.5000")), (2, 6, 6, 1, D("0.0000")),
        (12, 71, 71, 1, D("0.0000")), (13, 72, 100, 2, D("0.0000")),
        (None, None, None, 1, D("0.0000"))]


def test_unknown_rates_come_first(spark):
    state = _state(spark, [
        ("a", 1, "No", None, None, None), ("b", 1, "Yes", None, None, None),
        ("b", 1, None, None, None, None), ("c", 1, None, None, None, None),
        (None, 1, "No", None, None, None)])
    assert values(reports.rate_by_contract(state), "*") == [
        ("c", 1, 0, None), ("b", 2, 1, D("1.0000")), (None, 1, 0, D("0.0000")),
        ("a", 1, 0, D("0.0000"))]


def test_cohorts_and_velocity_accept_negative_days(spark):
    state = _state(spark, [
        ("a", 1, "Yes", "2024-01-31", "2024-01-27", None),
        ("a", 1, "Yes", "2024-01-01", "2024-01-08", None),
        ("a", 1, "No", "2024-02-01", None, None), ("a", 1, "Yes", None, "2024-01-01", None)])
    assert values(reports.cohort_retention(state), "*") == [
        (at("2024-01-01").date(), 2, 2, D("1.0000"), D("1.5")),
        (at("2024-02-01").date(), 1, 0, D("0.0000"), None)]
    assert values(reports.recent_cohorts(state, 1), "mois_cohorte") == [(at("2024-02-01").date(),)]
    assert values(reports.churn_velocity(state), "*") == [("a", 2, D("1.5"), D("1.5"))]


def test_weeks_start_on_monday(spark):
    state = _state(spark, [
        ("a", 1, "Yes", None, "2024-03-03", "1.00"), ("a", 1, "Yes", None, "2024-03-04", "2.00"),
        ("a", 1, "Yes", None, "2024-03-10", "2.01"), ("a", 1, "No", None, "2024-03-10", "9.00")])
    assert values(reports.weekly_trend(state), "*") == [
        (at("2024-02-26").date(), 1, D("1.00")), (at("2024-03-04").date(), 2, D("2.01"))]


def test_summary(spark):
    state = _state(spark, [
        ("a", 1, "Yes", None, None, "500000.00"), ("a", 2, "No", None, None, "25000.00"),
        ("a", None, None, None, None, None)])
    assert values(reports.base_summary(state), "*") == [
        (3, D("0.5000"), 1, D("0.53"), D("262500.00"), D("1.5"), D("1.5"))]
    empty = values(reports.base_summary(state.limit(0)), "*")
    assert empty == [(0, None, 0, None, None, None, None)]


def test_views_and_bound_parameters(spark, sf_dir, tmp_path):
    from subscriber_analytics import fixtures as fx

    events, scores = fx.order_events(spark, sf_dir), fx.order_scores(spark, sf_dir)
    views.register_views(events, scores, fx.AS_OF)
    names = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    assert {"churn_data", "churn_model", "v_churn_data_dernier_etat", "v_dernier_score",
            "v_analyse_complete", "v_actuals_vs_predictions", "v_clients_risque", "v_kpis_live",
            "v_churn_par_contrat", "v_churn_par_tenure", "v_churn_par_services",
            "v_cohortes_retention", "v_velocite_churn", "v_tendance_churn_hebdo"} <= names
    sql = "SELECT count(*) FROM v_dernier_score WHERE customer_id = :id"
    assert values(views.query(spark, sql, id="7"), "*") == [(1,)]
    assert values(views.query(spark, sql, id="7' OR '1'='1"), "*") == [(0,)]
    assert reports.first_row(views.query(spark, "SELECT * FROM v_kpis_live")).count() == 1

    kept = views.materialize(spark.table("v_churn_data_dernier_etat"), str(tmp_path / "state"))
    views.register_views(events, scores, fx.AS_OF, state=kept)
    top = views.query(spark, "SELECT * FROM v_clients_risque LIMIT :n", n=3)
    assert [r[0] for r in values(top, "churn_score")] == sorted(
        (r[0] for r in values(top, "churn_score")), reverse=True)


def test_grouped_reports_are_the_single_ones(spark, sf_dir):
    from subscriber_analytics import fixtures as fx
    from subscriber_analytics.operators.state import latest_state

    state = latest_state(fx.order_events(spark, sf_dir)).persist()
    rates = reports.all_rates(state).persist()
    single = {"contract": reports.rate_by(state), "tranche": reports.rate_by_tenure(state), "nb_services": reports.rate_by_services(state),
              "mois_cohorte": reports.cohort_retention(state), "semaine": reports.weekly_trend(state)}
    assert set(single) == set(reports.GROUPED_REPORTS)
    for name, report in single.items():
        found = reports.grouped_report(rates, name)
        assert found.columns == report.columns
        assert sorted(map(repr, found.collect())) == sorted(map(repr, report.collect())), name
    state.unpersist()
    rates.unpersist()
