"""A profile file on its way through the whole pipeline."""

import pytest
from pyspark.sql import functions as F

from subscriber_analytics.operators import lifecycle as lc
from subscriber_analytics.operators.state import customer_360, latest_state, live_feed, score_lookup
from subscriber_analytics.plans import reports, views
from subscriber_analytics.sources.events import write_event_files
from subscriber_analytics.sources.profiles import read_profiles
from subscriber_analytics.streaming import logs
from subscriber_analytics.streaming.main import main, named_object, parse_arguments
from tests.helpers import values

AS_OF = "2024-03-01 00:00:00"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Both logs after 40 profiles, every fourth of them a churner, went through the job."""
    place = tmp_path_factory.mktemp("pipeline")
    lines = ["customerID,tenure,SeniorCitizen,Contract,MonthlyCharges,TotalCharges,Churn"]
    lines += [f"c{i},{i},0,{'One year' if i % 2 else 'Two year'},{i}.50,,{'No' if i % 4 else 'Yes'}"
              for i in range(40)]
    (place / "profiles.csv").write_text("\n".join(lines), encoding="utf-8")
    events = lc.replay_profiles(read_profiles(spark, str(place / "profiles.csv")), AS_OF)
    envelope = lc.to_envelope(
        lc.to_messages(events), F.lit(AS_OF).cast("timestamp"), F.monotonically_increasing_id())
    write_event_files(envelope, str(place / "topics"), partitions=3)
    spark.createDataFrame(
        [("intercept", None, 1.0), ("tenure", None, -0.1), ("NewClient", None, 1.0)],
        "feature string, level string, weight double").write.parquet(str(place / "model"))
    main(["--files", str(place / "topics"), "--root", str(place / "logs"), "--checkpoint",
          str(place / "checkpoint"), "--coefficients", str(place / "model"), "--model-copy",
          str(place / "copy"), "--threshold", "0.6", "--available-now"])
    root = str(place / "logs")
    return logs.read_log(spark, root, logs.EVENTS), logs.read_log(spark, root, logs.SCORES)


def test_every_event_and_one_score_per_customer(stored):
    events, scores = stored
    assert events.count() == 50 and scores.count() == 40


def test_latest_state_is_the_termination(stored):
    state = latest_state(stored[0])
    assert values(reports.base_summary(state), "clients_en_base", "nb_resiliations") == [(40, 10)]
    assert values(state.filter("churn = 'Yes' AND churn_date IS NULL"), "customer_id") == []


def test_requests_of_the_dashboard(spark, stored):
    events, scores = stored
    assert values(score_lookup(scores, "c39"), "churn_predicted") == [(0,)]
    full = customer_360(events, scores, AS_OF)
    assert full.count() == 40 and full.filter("churn_score IS NULL").count() == 0
    top = values(reports.customers_at_risk(full, 3), "customer_id", "niveau_risque")
    assert top == [("c0", "ELEVE"), ("c1", "ELEVE"), ("c2", "ELEVE")]
    feed = values(live_feed(events, scores, 5), "customer_id", "churn_score")
    assert len(feed) == 5 and all(score is not None for _, score in feed)
    views.register_views(events, scores)
    counted = views.query(spark, "SELECT nb_clients_24h FROM v_kpis_live")
    assert values(counted, "*") == [(40,)]


def test_arguments():
    given = parse_arguments(["--servers", "b:9092", "--root", "r", "--checkpoint", "c", "--model",
                             "m", "--model-copy", "k"])
    assert given.trigger_seconds == 10 and given.threshold == 0.5
    assert given.topics == "abonnements,usages,paiements"


def test_tables_by_name():
    assert named_object("subscriber_analytics.streaming.logs:SCORES") == logs.SCORES
    with pytest.raises(ModuleNotFoundError):
        named_object("no_such_module:tables")
