"""The publishing command: profiles to events, refused ones to a folder of their own."""

import pytest
from pyspark.sql import functions as F

from subscriber_analytics.sources.events import read_event_files
from subscriber_analytics.streaming import publish
from tests.helpers import values

AS_OF = "2024-03-01 00:00:00"


@pytest.fixture(scope="module")
def profiles(tmp_path_factory):
    """40 profiles: every fourth a churner, every tenth without a usable senior flag."""
    place = tmp_path_factory.mktemp("profiles")
    lines = ["customerID,tenure,SeniorCitizen,Contract,MonthlyCharges,Churn"]
    lines += [f"c{i:02},{i},{'x' if i % 10 == 3 else 0},One year,{i}.50,{'No' if i % 4 else 'Yes'}" for i in range(40)]
    (place / "a.csv").write_text("\n".join(lines), encoding="utf-8")
    return str(place)


def test_events_and_refused_profiles(spark, profiles, tmp_path):
    target = ["--files", str(tmp_path / "topics"), "--rejects", str(tmp_path / "refused"), "--as-of", AS_OF, "--partitions", "3"]
    counts = publish.main(["--profiles", profiles, *target], spark)
    sent = spark.read.parquet(str(tmp_path / "topics"))
    assert counts == {"nb_evenements": 46, "nb_refus": 4} and sent.count() == 46
    refused = spark.read.parquet(str(tmp_path / "refused"))
    assert sorted(values(refused, "customer_id", "reject_reason")) == [
        (f"c{i:02}", "senior_citizen: invalid") for i in (3, 13, 23, 33)]
    # A termination arrives after the subscription of its customer.
    kinds = sent.withColumn("kind", F.get_json_object("value", "$.event_type")).orderBy("timestamp", "offset")
    assert [k for _, k in sorted(values(kinds.where("key = 'c04'"), "timestamp", "kind"))] == ["abonnement", "resiliation"]
    # A repeated run sends the same envelopes.
    publish.main(["--profiles", profiles, "--files", str(tmp_path / "again"), "--as-of", AS_OF], spark)
    again = spark.read.parquet(str(tmp_path / "again"))
    assert sent.exceptAll(again).isEmpty() and again.exceptAll(sent).isEmpty()
    assert read_event_files(spark, str(tmp_path / "again")).isStreaming


def test_first_profiles_alone(spark, profiles, tmp_path):
    counts = publish.main(["--profiles", profiles, "--files", str(tmp_path / "topics"), "--limit", "3"], spark)
    keys = {key for (key,) in values(spark.read.parquet(str(tmp_path / "topics")), "key")}
    assert keys == {"c00", "c01", "c02"} and counts["nb_refus"] == 0


def test_no_profiles(spark, profiles):
    sent = []
    empty = spark.read.option("header", True).csv(profiles).limit(0)
    assert publish.publish_profiles(empty, lambda events: sent.append(events.count())) == {"nb_evenements": 0, "nb_refus": 0}
    assert sent == [0]


def test_one_target_is_asked_for():
    with pytest.raises(SystemExit):
        publish.parse_arguments(["--profiles", "p"])
    assert publish.parse_arguments(["--profiles", "p", "--servers", "b:9092"]).limit == 0
