"""Rows of a file and of a task in the queries that run jobs: tasks are added, not rows, when the tables grow."""

import pytest
from pyspark.sql import functions as F

from subscriber_analytics import fixtures as fx
from subscriber_analytics.plans import registry

ROWS = 250


@pytest.fixture
def place(monkeypatch, tmp_path):
    """Where the queries work, with limits so low that the small tables are large ones."""
    monkeypatch.setattr(registry, "ROWS_A_TASK", ROWS, raising=False)
    monkeypatch.setattr(registry, "SPREAD", 2)
    monkeypatch.setattr(registry, "STORE_PARTS", 2)
    monkeypatch.setattr(registry, "work_dir", lambda spark, name: str(tmp_path / name))
    return tmp_path


def _most_rows(spark, path):
    """Rows of the largest file, which one task wrote."""
    return spark.read.parquet(str(path)).groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]


def _customers(spark, sf_dir):
    return fx.table(spark, sf_dir, "orders").select("o_custkey").distinct().count()


def test_latest_states_get_more_files_and_parts(spark, sf_dir, place):
    states = registry.queries()["stream_latest_state"](spark, sf_dir)
    assert states.count() == _customers(spark, sf_dir)
    assert _most_rows(spark, place / "states/files/*") < 2 * ROWS
    assert len(list((place / "states/checkpoint/state/0").glob("[0-9]*"))) == 4
    # Three batches a delivery, as ever.
    assert len(list((place / "states/checkpoint/commits").glob("[0-9]*"))) == 6


def test_days_get_more_files_and_stay_batches(spark, sf_dir, place):
    scores = registry.queries()["job_by_day"](spark, sf_dir)
    events = fx.table(spark, sf_dir, "events")
    # A day has 333 messages, and a file a quarter of the limit.
    assert _most_rows(spark, place / "days/days") < ROWS / 2
    batches = scores.select("jour", "nb_evenements", "nb_rejets", "nb_scores").distinct().collect()
    assert len(batches) == events.select(F.to_date("ts")).distinct().count() == len({row["jour"] for row in batches})
    assert sum(row["nb_evenements"] + row["nb_rejets"] for row in batches) == events.count()
    assert sum(row["nb_scores"] for row in batches) == scores.count()


@pytest.mark.parametrize("query, folder", [("publish_roundtrip", "published"), ("restart_roundtrip", "restart")])
def test_published_events_get_more_files_and_as_many_batches(spark, sf_dir, place, query, folder):
    state = registry.queries()[query](spark, sf_dir)
    assert state.count() == _customers(spark, sf_dir)
    assert _most_rows(spark, place / folder / "files") < 2 * ROWS
    assert _most_rows(spark, place / folder / "logs/events/landing") < 2 * ROWS
    assert len(list((place / folder / "checkpoint/commits").glob("[0-9]*"))) == registry.PUBLISHED_FILES


def test_one_batch_over_a_table_gets_more_tasks(spark, sf_dir, place):
    assert registry.queries()["stream_rejects"](spark, sf_dir).count() > 0
    assert _most_rows(spark, place / "job/logs/events/landing") < 2 * ROWS
