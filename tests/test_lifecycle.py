import json

from pyspark.sql import functions as F

from subscriber_analytics.operators import lifecycle as lc
from subscriber_analytics.operators.parsing import coerce_profiles, parse_events, rename_profiles
from subscriber_analytics.operators.parsing import to_event_log
from subscriber_analytics.sources.events import read_event_files, write_event_files
from tests.helpers import at, values

AS_OF = "2024-03-01 00:00:00"


def _dated(spark, rows, jitter=0, draw=0):
    df = spark.createDataFrame(rows, "customer_id string, tenure int, churn string")
    df = lc.derive_signup_date(df, AS_OF, F.lit(jitter))
    return lc.derive_churn_date(df, AS_OF, F.lit(draw))


def test_dates(spark):
    rows = [("a", 1, "No"), ("b", 1, "Yes"), ("c", 0, "Yes"), ("d", -1, "Yes"), ("e", 1, None)]
    day = at(AS_OF).date()
    got = {name: ((day - s).days, c and (c - s).days)
           for name, s, c in values(_dated(spark, rows), "customer_id", "signup_date", "churn_date")}
    # 60 % of 30 days is 18; the shortest life is 5 days, from its day 3, but not after yesterday.
    assert got == {"a": (30, None), "b": (30, 18), "c": (0, -1), "d": (-30, -31), "e": (30, None)}


def test_dates_of_the_profile_come_first(spark):
    df = spark.createDataFrame(
        [("a", 1, "Yes", "2020-05-06", "2021-07-08"), ("b", 1, "Yes", "", None), ("c", 1, "No", "soon", "2021-07-08")],
        "customer_id string, tenure int, churn string, signup_date string, churn_date string")
    df = lc.derive_churn_date(lc.derive_signup_date(df, AS_OF, F.lit(0)), AS_OF, F.lit(0))
    got = {name: (str(s), c and str(c)) for name, s, c in values(df, "customer_id", "signup_date", "churn_date")}
    assert got == {"a": ("2020-05-06", "2021-07-08"), "b": ("2024-01-31", "2024-02-18"), "c": ("2024-01-31", None)}


def test_draw_covers_the_window_and_both_ends(spark):
    df = spark.range(1000).selectExpr("cast(id as string) customer_id", "10 tenure", "'Yes' churn")
    df = lc.derive_churn_date(
        lc.derive_signup_date(df, AS_OF, F.lit(10)), AS_OF, F.col("customer_id").cast("bigint"))
    life = [r[0] for r in values(df, F.datediff("churn_date", "signup_date"))]
    assert min(life) == 180 and max(life) == 300 and len(set(life)) == 121


def test_default_jitter_is_fixed_per_key(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("customer_id"))
    first, again = (dict(values(df, "customer_id", lc.default_jitter())) for _ in range(2))
    assert first == again and set(first.values()) == set(range(-10, 11))


def _profiles(spark):
    raw = spark.createDataFrame(
        [("a", "3", "Yes"), ("b", "3", "No"), ("é", "3", "")],
        "customerID string, tenure string, Churn string")
    typed = coerce_profiles(rename_profiles(raw)).drop("reject_reason")
    return lc.derive_churn_date(lc.derive_signup_date(typed, AS_OF), AS_OF)


def test_expand(spark):
    events = lc.expand_lifecycle(_profiles(spark), AS_OF)
    got = values(events, "customer_id", "event_type", "churn", F.col("churn_date").isNull(),
                 "event_ts")
    begun, ended = at(AS_OF), at("2024-03-01 00:00:00.000001")
    assert got == [
        ("a", "abonnement", "No", True, begun), ("a", "resiliation", "Yes", False, ended),
        ("b", "abonnement", "No", True, begun), ("é", "abonnement", "No", True, begun),
    ]
    assert "Exchange" not in events._jdf.queryExecution().executedPlan().toString()


def test_messages_keep_nulls_letters_and_microseconds(spark):
    sent = lc.to_messages(lc.expand_lifecycle(_profiles(spark), AS_OF))
    rows = values(sent, "topic", "key", "value")
    assert {topic for topic, _, _ in rows} == {"abonnements"}
    opening, ending = json.loads(rows[0][2]), json.loads(rows[1][2])
    assert len(opening) == 26 and opening["churn_date"] is None and ending["churn_date"]
    assert ending["event_ts"] == "2024-03-01T00:00:00.000001+00:00"
    assert rows[3][1] == "é" and '"customer_id":"é"' in rows[3][2]


def test_topics(spark):
    kinds = ["abonnement", "usage", "paiement", "resiliation", "other", None]
    df = spark.createDataFrame([(k,) for k in kinds], "event_type string")
    assert [r[0] for r in values(df, lc.topic_of())] == [
        "abonnements", "usages", "paiements", "abonnements", None, None]


def test_messages_survive_the_way_through_files(spark, tmp_path):
    sent = lc.to_messages(lc.expand_lifecycle(_profiles(spark), AS_OF))
    envelope = lc.to_envelope(
        sent, F.lit(AS_OF).cast("timestamp"), F.monotonically_increasing_id())
    assert all(0 <= p < 3 for p, in values(envelope, "partition"))
    per_key = envelope.groupBy("key").agg(F.count_distinct("partition").alias("n"))
    assert {n for n, in values(per_key, "n")} == {1}
    path = str(tmp_path / "topic")
    write_event_files(envelope, path, partitions=2)
    back = spark.read.schema(read_event_files(spark, path).schema).parquet(path)
    log = to_event_log(parse_events(back))
    assert values(log.filter("reject_reason is not null"), "customer_id") == []
    assert sorted(values(log, "customer_id", "event_type")) == [
        ("a", "abonnement"), ("a", "resiliation"), ("b", "abonnement"), ("é", "abonnement")]


def test_retention_includes_the_bound(spark):
    df = spark.sql(
        "SELECT id, TIMESTAMP '2024-03-08 00:00:00' - make_dt_interval(id, 0, 0, 0) AS timestamp "
        "FROM range(10)")
    kept = lc.retain(df, "2024-03-08 00:00:00")
    assert sorted(i for i, in values(kept, "id")) == list(range(8))


def test_rejected_profiles_stay_with_their_reason(spark):
    raw = spark.createDataFrame(
        [("a", "3", "0", "Yes"), ("b", "3", "x", "Yes")], "customerID string, tenure string, SeniorCitizen string, Churn string")
    rows = values(lc.replay_profiles(raw, AS_OF).orderBy("customer_id", "event_ts"),
                  "customer_id", "event_type", "churn", "reject_reason")
    assert rows == [("a", "abonnement", "No", None), ("a", "resiliation", "Yes", None), ("b", None, "Yes", "senior_citizen: invalid")]
    assert values(lc.replay_profiles(raw, AS_OF).filter("customer_id = 'b'"), "event_ts", "signup_date", "churn_date") == [(None, None, None)]
