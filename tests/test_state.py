import random

import pytest
from pyspark.sql import functions as F

from subscriber_analytics.operators import state as st
from tests.helpers import at, values

LOG = "id bigint, customer_id string, ingested_ts timestamp, event_type string, event_ts timestamp"
SCORES = ("id bigint, customer_id string, predicted_ts timestamp, churn_score decimal(5,4), "
          "churn_predicted smallint, seuil_applique decimal(4,3), model_version string")


def _log(spark, rows):
    return spark.createDataFrame([(i, c, at(t), "usage", at(t)) for i, c, t in rows], LOG)


def _scores(spark, rows):
    df = spark.createDataFrame(
        [(i, c, at(t), s, p) for i, c, t, s, p in rows],
        "id bigint, customer_id string, predicted_ts timestamp, s double, p int")
    return df.select(
        "id", "customer_id", "predicted_ts", F.col("s").cast("decimal(5,4)").alias("churn_score"),
        F.col("p").cast("smallint").alias("churn_predicted"),
        F.lit(0.5).cast("decimal(4,3)").alias("seuil_applique"), F.lit("1").alias("model_version"))


def test_ties_go_to_the_later_arrival(spark):
    log = _log(spark, [(1, "a", "2024-01-01"), (3, "a", "2024-01-02"), (2, "a", "2024-01-02"),
                       (9, "b", "2023-01-01")])
    assert sorted(values(st.latest_state(log), "customer_id", "id")) == [("a", 3), ("b", 9)]
    by_arrival = log.withColumn("arrival", F.struct((-F.col("id")).alias("offset")))
    # A source position decides alone: it orders a customer's events also across batches.
    assert sorted(values(st.latest_state(by_arrival), "customer_id", "id")) == [("a", 1), ("b", 9)]


def test_order_can_be_event_time(spark):
    log = _log(spark, [(1, "a", "2024-01-01"), (2, "a", "2024-01-02")]).withColumn(
        "event_ts", F.when(F.col("id") == 1, F.lit("2025-01-01")).otherwise("2024-01-01")
        .cast("timestamp"))
    assert values(st.latest_state(log), "id") == [(2,)]
    assert values(st.latest_state(log, ["event_ts", "id"]), "id") == [(1,)]


def _skewed(n, seed):
    """A third of the rows belongs to one customer; times are few, so ties are many."""
    draw = random.Random(seed)
    return [(i, "hot" if draw.random() < 1 / 3 else f"c{draw.randrange(50)}",
             f"2024-01-{draw.randrange(1, 10):02d}") for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_latest_and_first_against_brute_force_on_skewed_keys(spark, seed):
    rows = _skewed(3000, seed)
    log = _log(spark, rows).repartition(6)
    by_key = {}
    for i, key, day in rows:
        by_key.setdefault(key, []).append((day, i))
    last = {(k, max(v)[1]) for k, v in by_key.items()}
    first = {(k, min(v)[1]) for k, v in by_key.items()}
    assert set(values(st.latest_state(log), "customer_id", "id")) == last
    got = st.keep_first(log, ["customer_id"], ["ingested_ts", "id"])
    assert set(values(got, "customer_id", "id")) == first


@pytest.mark.parametrize("cut", ["2024-01-01", "2024-01-05", "2024-02-01"])
def test_merged_state_equals_latest_state(spark, cut):
    log = _log(spark, _skewed(1000, 3))
    old = F.col("ingested_ts") < F.lit(cut).cast("timestamp")
    merged = st.merge_state(st.latest_state(log.filter(old)), log.filter(~old))
    columns = ["customer_id", "id", "ingested_ts"]
    assert sorted(values(merged, *columns)) == sorted(values(st.latest_state(log), *columns))


def test_score_lookup(spark):
    scores = _scores(spark, [(1, "a", "2024-01-01", 0.2, 0), (2, "a", "2024-01-02", 0.8, 1)])
    found = values(st.score_lookup(scores, "a"), "*")
    assert [(r[0], float(r[1]), r[2], r[3]) for r in found] == [("a", 0.8, 1, "1")]
    assert st.score_lookup(scores, "nobody").count() == 0


def test_live_feed(spark):
    log = _log(spark, [(i, c, f"2024-01-{i:02d}") for i, c in enumerate("abcabcabca", 1)]
               + [(11, "x", "2024-01-10")])
    scores = _scores(spark, [(1, "a", "2024-01-01", 0.1, 0), (2, "a", "2024-01-01", 0.9, 1),
                             (3, "c", "2024-01-01", 0.5, 1)])
    feed = values(st.live_feed(log, scores, 4), "customer_id", "churn_score")
    assert [(c, s and float(s)) for c, s in feed] == [
        ("x", None), ("a", 0.9), ("c", 0.5), ("b", None)]
    assert st.live_feed(log, scores, 500, cap=500).count() == 11


def test_limits():
    assert st.checked_limit(50, 50) == 50 and st.checked_limit(0, 50) == 0
    for n in (-1, 51):
        with pytest.raises(ValueError):
            st.checked_limit(n, 50)


def test_feed_of_recent_days_is_the_feed_of_the_log_where_they_hold_enough(spark):
    log = _log(spark, _skewed(60, 4)).withColumn("ingest_date", F.to_date("ingested_ts"))
    scores = _scores(spark, [(1, "hot", "2024-01-01", 0.5, 1)])
    part = st.within_days(log, 1, "2024-01-09 10:00:00")
    assert 0 < part.count() < 60
    assert values(st.live_feed(part, scores, 3), "*") == values(st.live_feed(log, scores, 3), "*")


def test_recent_days_read_only_their_partitions(spark, tmp_path):
    path = str(tmp_path / "log")
    log = _log(spark, _skewed(60, 4)).withColumn("ingest_date", F.to_date("ingested_ts"))
    log.write.partitionBy("ingest_date").parquet(path)
    part = st.within_days(spark.read.parquet(path), 1, "2024-01-09 10:00:00")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "ingest_date" in plan.split("PartitionFilters: ")[1].split("]")[0]


def test_state_follows_the_source_position_whatever_batch_a_file_came_in(spark):
    rows = spark.createDataFrame(
        [("a", "2024-01-01 00:00:09", 1, "old"), ("a", "2024-01-01 00:00:01", 2, "new")],
        "customer_id string, ingested_ts string, arrival int, churn string")
    assert values(st.latest_state(rows), "churn") == [("new",)]
