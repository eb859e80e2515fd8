"""The physical plans that the design relies on."""

import re

import pytest
from pyspark.sql import functions as F

from subscriber_analytics import fixtures as fx
from subscriber_analytics.operators import lifecycle
from subscriber_analytics.operators import state as st
from subscriber_analytics.operators.features import preprocess
from subscriber_analytics.plans import registry, reports, tables
from subscriber_analytics.streaming.logs import LOOKUP_OPTIONS

# Queries that run jobs of their own before their result is planned are checked by their results.
RUN = ("stream_", "publish_", "job_", "restart_", "replay_", "pipeline_", "log_", "profile_", "bucketed_", "fallback_")
BATCH = [name for name in registry.QUERIES if not name.startswith(RUN)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _count(plan, operator):
    return len(re.findall(rf"[-:] (?:\*\(\d+\) )?{operator}\b", plan))


@pytest.fixture(scope="module")
def no_broadcast(spark):
    """What Spark plans once both logs are large."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def _logs(spark, sf_dir):
    return fx.order_events(spark, sf_dir), fx.order_scores(spark, sf_dir)


def test_no_python_and_no_product_in_any_plan(spark, sf_dir):
    for name in BATCH:
        plan = _plan(registry.QUERIES[name](spark, sf_dir))
        for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in plan, (name, word)


def test_latest_state_limits_before_its_only_shuffle(spark, sf_dir):
    plan = _plan(st.latest_state(_logs(spark, sf_dir)[0]))
    assert _count(plan, "Exchange") == 1
    assert re.search(r"row_number\(\), 1, Partial", plan) and re.search(r"row_number\(\), 1, Final", plan)


def test_report_reads_only_its_columns(spark, sf_dir):
    plan = _plan(reports.rate_by(st.latest_state(_logs(spark, sf_dir)[0]), "contract"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "o_totalprice" not in schema and "o_orderpriority" in schema


def test_360_join_adds_no_exchange(spark, sf_dir, no_broadcast):
    plan = _plan(st.customer_360(*_logs(spark, sf_dir), fx.AS_OF))
    assert _count(plan, "SortMergeJoin") == 1 and _count(plan, "Exchange") == 2


def test_score_filter_turns_the_join_into_an_inner_one(spark, sf_dir, no_broadcast):
    full = st.customer_360(*_logs(spark, sf_dir), fx.AS_OF)
    assert re.search(r"SortMergeJoin .*Inner", _plan(reports.actual_vs_predicted(full)))


def test_distinct_customers_need_no_exchange_of_their_own(spark, sf_dir, no_broadcast):
    plan = _plan(reports.live_kpis_from_logs(*_logs(spark, sf_dir), fx.AS_OF))
    hashed = re.findall(r"Exchange hashpartitioning\(customer_id", plan)
    # The window's customers once for their scores and once to cut the events; the same exchange runs once.
    assert len(hashed) == 3 and plan.count("Exchange SinglePartition") == 1
    assert re.search(r"Join .*LeftSemi", plan)


def test_top_k_is_no_sort(spark, sf_dir):
    full = st.customer_360(*_logs(spark, sf_dir), fx.AS_OF)
    plan = _plan(reports.customers_at_risk(full))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def _jobs(spark, group):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_feed_runs_nothing_early_and_scans_the_events_once(spark, sf_dir):
    events, scores = _logs(spark, sf_dir)
    spark.sparkContext.setJobGroup("feed", "feed")
    try:
        feed = st.live_feed(events, scores, 50)
        assert _jobs(spark, "feed") == 0
        feed.collect()
        assert _jobs(spark, "feed") > 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = _plan(feed)
    # The subquery with the newest events runs once and filters the score log; the other use is the same.
    assert "ReusedSubquery" in plan and "TakeOrderedAndProject" in plan and "array_contains" in plan


def test_day_filters_of_a_stored_log_skip_its_folders(spark, sf_dir):
    events, scores = registry._recent_logs(spark, sf_dir)
    day = r"PartitionFilters: \[[^\]]*ingest_date[^\]]* >= 2001-0"
    for df in (st.within_days(events, 30, fx.AS_OF), reports.live_kpis_from_logs(
            events, scores, fx.AS_OF, 24, day_column="ingest_date"), lifecycle.retain(
            events, fx.AS_OF, 7, "ingested_ts", "ingest_date")):
        assert re.search(day, _plan(df))
    recent = st.within_days(events, 9, fx.AS_OF)
    assert recent.select(F.col("_metadata.file_path")).distinct().count() == 9 == recent.select("ingest_date").distinct().count()
    assert events.select(F.col("_metadata.file_path")).distinct().count() == fx.RECENT_DAYS


def test_lookup_skips_the_row_groups_of_other_customers(spark, tmp_path):
    path = str(tmp_path / "scores")
    keys = spark.range(100_000).select(F.concat(F.lit("c"), F.xxhash64("id")).alias("customer_id"), "id")
    # Without a dictionary it is the Bloom filter alone that tells; the ranges of the files overlap.
    keys.repartition(1000).write.options(**LOOKUP_OPTIONS).option("parquet.enable.dictionary", "false").parquet(path)
    wanted = keys.filter("id = 77777").first()["customer_id"]
    found = spark.read.parquet(path).filter(F.col("customer_id") == wanted)
    assert [r["id"] for r in found.collect()] == [77777]
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numFiles").value() == 1000
    assert scan.metrics().apply("numOutputRows").value() < 5_000  # a twentieth, with the filter's false hits


def test_bucketed_tables_join_without_exchange_after_a_restart(spark, sf_dir, tmp_path, no_broadcast):
    events, scores = _logs(spark, sf_dir)
    found = []
    for name, df in (("plan_states", st.latest_state(events)), ("plan_scores", st.latest_score(scores))):
        tables.save_bucketed(df, name, str(tmp_path / name), buckets=4)
        spark.sql(f"DROP TABLE {name}")  # an external table: a session that ends leaves the files as this does
        found.append(tables.attach_bucketed(spark, f"{name}_read", str(tmp_path / name), df.schema, buckets=4))
    joined = st.join_360(*found, fx.AS_OF)
    plan = _plan(joined)
    assert "SortMergeJoin" in plan and _count(plan, "Exchange") == 0
    want = st.customer_360(events, scores, fx.AS_OF)
    assert joined.exceptAll(want).count() == 0 == want.exceptAll(joined).count()


def test_all_grouped_reports_need_one_shuffle_of_the_state(spark, sf_dir):
    plan = _plan(reports.all_rates(st.latest_state(_logs(spark, sf_dir)[0])))
    assert _count(plan, "FileScan parquet") == 1 and _count(plan, "Exchange") == 2 and _count(plan, "Expand") == 1


def test_lookup_filter_reaches_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "scores")
    fx.order_scores(spark, sf_dir).write.parquet(path)
    plan = _plan(st.score_lookup(spark.read.parquet(path), "7"))
    assert "EqualTo(customer_id,7)" in plan


def test_kpi_window_reaches_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "scores")
    events, scores = _logs(spark, sf_dir)
    scores.selectExpr(
        "* EXCEPT (predicted_ts)", "CAST(predicted_ts AS TIMESTAMP) AS predicted_ts",
        "CAST(predicted_ts AS DATE) AS ingest_date",
    ).filter("predicted_ts >= '2001-07-01'").write.partitionBy("ingest_date").parquet(path)
    plan = _plan(reports.live_kpis_from_logs(
        events, spark.read.parquet(path), fx.AS_OF, 24, day_column="ingest_date"))
    assert "GreaterThanOrEqual(predicted_ts,2001-08-01" in plan
    assert re.search(r"PartitionFilters: \[[^\]]*ingest_date[^\]]* >= 2001-08-01", plan)


def test_features_shuffle_once_and_stay_in_the_jvm(spark, sf_dir):
    plan = _plan(fx.SCORER.__class__(0.0, {"tenure": 0.1, "NewClient": 1.0})(
        preprocess(fx.order_profiles(spark, sf_dir), ["o_orderkey"])))
    assert _count(plan, "Exchange") == 1 and "Python" not in plan
