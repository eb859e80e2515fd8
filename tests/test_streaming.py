import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import StreamingQueryException

from subscriber_analytics import fixtures as fx
from subscriber_analytics.operators.scoring import LogitScorer
from subscriber_analytics.operators.state import keep_first, latest_by
from subscriber_analytics.schemas import EVENT_LOG_RULES, SCORE_LOG_RULES
from subscriber_analytics.session import work_dir
from subscriber_analytics.sources.events import read_event_files
from subscriber_analytics.streaming import logs
from subscriber_analytics.streaming import state as states
from subscriber_analytics.streaming.job import JobConfig, start_job
from tests.helpers import envelopes, event, values

SCORER = LogitScorer(-1.0, {"tenure": 0.1})


@pytest.fixture
def place(tmp_path):
    return JobConfig(root=str(tmp_path / "logs"), checkpoint=str(tmp_path / "checkpoint"))


@pytest.fixture
def source(tmp_path):
    return str(tmp_path / "source")


def _send(spark, source, messages):
    envelopes(spark, messages).coalesce(1).write.mode("append").parquet(source)


def _run(spark, source, config, scorer=SCORER, **options):
    stream = read_event_files(spark, source, max_files_per_trigger=1)
    query = start_job(stream, scorer, config, available_now=True, **options)
    query.awaitTermination()
    return query


def test_scores_stay_with_their_customer(spark, source, place):
    _send(spark, source, [
        (event(customer_id="a", tenure=1), "usages", 0), (event(customer_id="a", tenure=40), "usages", 1),
        (event(customer_id="b", tenure=50), "usages", 2), ("broken", "usages", 3),
        (event(customer_id="c", tenure=60, event_ts=None), "usages", 4)])
    metrics = {}
    _run(spark, source, place, on_metrics=metrics.__setitem__)
    scores = values(logs.read_log(spark, place.root, logs.SCORES).orderBy("customer_id"),
                    "customer_id", F.col("churn_score").cast("double"), "churn_predicted",
                    "arrival.offset")
    assert scores == [("a", 0.2891, 0, 0), ("b", 0.982, 1, 2)]  # 1 / (1 + e^0.9), 1 / (1 + e^-4)
    assert logs.read_log(spark, place.root, logs.EVENTS).count() == 3
    rejects = values(logs.read_rejects(spark, place.root).orderBy("arrival"), "reject_reason",
                     "raw_value")
    assert [r[0] for r in rejects] == ["message: malformed", "event_ts: missing"]
    assert rejects[0][1] == "broken"
    assert {k: str(v) for k, v in metrics[0].items()} == {
        "nb_evenements": "3", "nb_rejets": "2", "nb_scores": "2", "nb_a_risque": "1",
        "score_moyen": "0.636"}


def test_batch_of_rejects_only(spark, source, place):
    _send(spark, source, [("broken", "usages", 0)])
    _run(spark, source, place)
    assert logs.read_log(spark, place.root, logs.EVENTS).count() == 0
    assert logs.read_log(spark, place.root, logs.SCORES).count() == 0
    assert logs.read_rejects(spark, place.root).count() == 1


def test_restart_loses_and_repeats_nothing(spark, source, place):
    _send(spark, source, [(event(customer_id="a"), "usages", 0)])
    first = _run(spark, source, place)
    _send(spark, source, [(event(customer_id="b"), "usages", 1)])
    _send(spark, source, [(event(customer_id="a", tenure=9), "usages", 2)])
    second = _run(spark, source, place)
    assert first.id == second.id
    for log in (logs.EVENTS, logs.SCORES):
        rows = logs.read_log(spark, place.root, log)
        assert sorted(values(rows, "arrival.offset")) == [(0,), (1,), (2,)]
        assert sorted(b for b, in values(rows, "batch_id")) == [0, 1, 2]


def test_replay_after_a_failure_between_the_two_logs(spark, source, place):
    _send(spark, source, [(event(customer_id="a"), "usages", 0)])

    def broken(_):
        raise ValueError("no model")

    with pytest.raises(StreamingQueryException):
        _run(spark, source, place, scorer=broken)
    before = values(logs.read_log(spark, place.root, logs.EVENTS), "ingested_ts", "query_id")
    assert len(before) == 1 and logs.read_log(spark, place.root, logs.SCORES).count() == 0
    _run(spark, source, place)
    after = values(logs.read_log(spark, place.root, logs.EVENTS), "ingested_ts", "query_id")
    assert after == before  # the same batch, with the same ingestion time
    assert logs.read_log(spark, place.root, logs.SCORES).count() == 1


def test_new_checkpoint_keeps_old_batches(spark, source, place, tmp_path):
    _send(spark, source, [(event(), "usages", 0)])
    _run(spark, source, place)
    _run(spark, source, JobConfig(place.root, str(tmp_path / "other")))
    assert logs.read_log(spark, place.root, logs.EVENTS).count() == 2


def test_processing_time_trigger(spark, source, tmp_path):
    config = JobConfig(str(tmp_path / "l"), str(tmp_path / "c"), trigger_seconds=1, spread=2)
    _send(spark, source, [(event(), "usages", 0)])
    query = start_job(read_event_files(spark, source), SCORER, config)
    try:
        query.processAllAvailable()
        _send(spark, source, [(event(customer_id="z"), "usages", 1)])
        query.processAllAvailable()
    finally:
        query.stop()
    assert logs.read_log(spark, config.root, logs.EVENTS).count() == 2


def test_filters_on_days_and_batches_reach_the_scan(spark, source, place):
    for i in range(2):
        _send(spark, source, [(event(customer_id=f"c{i}"), "usages", i)])
    _run(spark, source, place)
    rows = logs.read_log(spark, place.root, logs.EVENTS).filter(
        "ingest_date >= DATE '2020-01-01' AND batch_id = 1")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*batch_id[^\]]* = 1", plan)
    assert re.search(r"PartitionFilters: \[.*ingest_date[^\]]* >= 2020-01-01", plan)
    assert values(rows, "customer_id") == [("c1",)]


def test_a_log_without_batches_is_empty(spark, tmp_path):
    assert logs.read_log(spark, str(tmp_path), logs.SCORES).count() == 0
    assert logs.read_rejects(spark, str(tmp_path)).count() == 0


def test_many_batches_equal_one_pass(spark, sf_dir, place, tmp_path):
    """One day of the events table per file and per micro-batch against the batch operators."""
    messages = fx.messages(fx.table(spark, "/root/testdata/sf0.001", "events"))
    days = messages.withColumn("day", F.to_date("timestamp")).persist()
    source = str(tmp_path / "days")
    days.repartition("day").write.option("maxRecordsPerFile", 0).partitionBy("day").parquet(source)
    query = start_job(
        read_event_files(spark, f"{source}/day=*", max_files_per_trigger=1), fx.SCORER, place,
        available_now=True)
    query.awaitTermination()
    events = logs.read_log(spark, place.root, logs.EVENTS)
    scores = logs.read_log(spark, place.root, logs.SCORES)
    assert len({b for b, in values(events, "batch_id")}) == 30
    day = F.to_date("arrival.timestamp").alias("day")
    expected = keep_first(events.select("*", day), ["day", "customer_id"], ["arrival"])
    assert sorted(values(scores, "customer_id", "arrival.offset")) == sorted(
        values(expected, "customer_id", "arrival.offset"))
    assert events.count() + logs.read_rejects(spark, place.root).count() == days.count()
    days.unpersist()


def test_metrics_log_is_what_the_job_counted(spark, source, place):
    seen = {}
    for k in range(2):
        _send(spark, source, [(event(customer_id=c), "usages", 10 * k + n) for n, c in enumerate("aab"[k:])])
    _run(spark, source, place, on_metrics=seen.__setitem__)
    rows = {r["batch_id"]: r for r in logs.read_metrics(spark, place.root).collect()}
    assert set(rows) == set(seen) == {0, 1}
    for batch, counts in seen.items():
        assert {name: rows[batch][name] for name in counts} == counts
    assert sorted(r["nb_evenements"] for r in rows.values()) == [2, 3]


def test_a_replay_keeps_the_time_of_the_scores(spark, source, place):
    _send(spark, source, [(event(customer_id="a"), "usages", 0)])

    def stop(batch_id, counts):
        raise ValueError("after both writes")

    with pytest.raises(StreamingQueryException):
        _run(spark, source, place, on_metrics=stop)
    first = values(logs.read_log(spark, place.root, logs.SCORES), "predicted_ts", "ingest_date")
    _run(spark, source, place)
    assert values(logs.read_log(spark, place.root, logs.SCORES), "predicted_ts", "ingest_date") == first and len(first) == 1


def test_streaming_states_ignore_late_and_bad_messages(spark, source, tmp_path):
    root, checkpoint = str(tmp_path / "s"), str(tmp_path / "c")

    def run():
        stream = read_event_files(spark, source, max_files_per_trigger=1)
        states.start_latest_states(stream, root, checkpoint, available_now=True, partitions=2).awaitTermination()

    _send(spark, source, [(event(customer_id="a", tenure=1), "usages", 5), (event(customer_id="b", tenure=2), "usages", 6)])
    run()
    _send(spark, source, [(event(customer_id="a", tenure=9), "usages", 3), (event(customer_id="b", event_ts=None), "usages", 8),
                          ("broken", "usages", 9), (event(customer_id="b", tenure=7), "usages", 7),
                          (event(customer_id=None), "usages", 10)])
    run()
    want = [("a", 1, 5), ("b", 7, 7)]
    for found in (states.states_from_store(spark, checkpoint), states.states_from_changes(spark, root)):
        assert sorted(values(found, "customer_id", "tenure", "arrival.offset")) == want
    assert read_counts(states.read_changes(spark, root)) == {0: 2, 1: 2}


def read_counts(changes):
    return {r["batch_id"]: r["count"] for r in changes.groupBy("batch_id").count().collect()}


def test_work_dir(spark):
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert shared is None or first.startswith(shared)
