"""The registered queries: every operator over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import StreamingQueryException

from subscriber_analytics import fixtures as fx
from subscriber_analytics.functions.columns import decision
from subscriber_analytics.operators import constraints, features, lifecycle, metrics, parsing, scoring
from subscriber_analytics.operators import state as st
from subscriber_analytics.plans import export, reports, tables, views
from subscriber_analytics.schemas import EVENT_LOG_RULES, PROFILE_COLUMNS, PROFILE_DEFAULTS, SCORE_LOG_RULES
from subscriber_analytics.session import apply_settings, work_dir
from subscriber_analytics.sources import profiles
from subscriber_analytics.sources.events import read_event_files, write_event_files
from subscriber_analytics.streaming import logs, publish
from subscriber_analytics.streaming import state as states
from subscriber_analytics.streaming.job import JobConfig, score_events, start_job

Query = Callable[[SparkSession, str], DataFrame]

KPI_HOURS = 30 * 24
# Bounds a micro-batch of the queries whose result does not depend on batches; it drops nothing.
FILES_PER_BATCH = 10_000
PUBLISHED_FILES = 7
# Least number of tasks that raw messages are dealt to before they are parsed.
SPREAD = 16
# Least number of parts of the state store, and that of the bucketed tables of the queries here.
STORE_PARTS = 8
# Messages of a file, and of a task that makes, parses or stores them: parts grow with the input, not tasks.
ROWS_A_TASK = 100_000
# Jobs over a day each that run side by side: most of a small batch's time is planning and commits.
DAYS_AT_ONCE = 4
STATE_COLUMNS = ("id",) + tuple(rule.name for rule in EVENT_LOG_RULES)
RULED_RAW_COLUMNS = (
    "customer_id", "gender", "senior_citizen", "partner", "tenure", "monthly_charges", "signup_date",
    "event_type", "event_ts", "source",
)


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and timestamps without zone, to compare with another engine."""
    def plain(name: str, kind: str):
        if kind.startswith("decimal"):
            return F.col(name).cast("double").alias(name)
        return F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)

    return df.select(*[plain(name, kind) for name, kind in df.dtypes])


def _share(rows: int, among: int = 1) -> int:
    """Number of tasks of about ``ROWS_A_TASK`` rows that each of ``among`` equal parts of the rows needs."""
    return max(1, ceil(rows / (among * ROWS_A_TASK)))


def _spread(rows: DataFrame) -> int:
    """Tasks that the messages of a batch made of all these rows are dealt to."""
    return max(SPREAD, _share(rows.count()))


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.latest_state(fx.order_events(spark, sf_dir))


def _view_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.customer_360(
        fx.order_events(spark, sf_dir), fx.order_scores(spark, sf_dir), fx.AS_OF
    )


def _typed_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.coerce_profiles(parsing.rename_profiles(fx.customer_profiles(spark, sf_dir)))


def _jitter():
    return (F.col("c_custkey") % 21 - 10).cast("int")


def _draw():
    return F.col("c_custkey") * 48271


def _dated_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.date_profiles(_typed_profiles(spark, sf_dir), fx.AS_OF, _jitter(), _draw())


def _lifecycle_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.customer_profiles(spark, sf_dir)
    return lifecycle.replay_profiles(raw, fx.AS_OF, "replay", _jitter(), _draw())


def _merged_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.order_events(spark, sf_dir)
    old = F.col("ingested_ts") < F.lit("2000-01-01").cast("timestamp_ntz")
    return st.merge_state(st.latest_state(events.filter(old)), events.filter(~old))


def _live_feed_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.order_events(spark, sf_dir)
    events = events.withColumn("ingest_date", F.col("ingested_ts").cast("date"))
    return st.live_feed(
        st.within_days(events, 30, fx.AS_OF), fx.order_scores(spark, sf_dir), 50
    )


def _view_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    views.register_views(
        fx.order_events(spark, sf_dir), fx.order_scores(spark, sf_dir), fx.AS_OF
    )
    return views.query(
        spark,
        "SELECT niveau_risque, contract, count(*) AS n, max(duree_reelle_jours) AS plus_longue "
        "FROM v_analyse_complete WHERE tenure >= :months GROUP BY niveau_risque, contract",
        months=12,
    )


def _constraint_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [rule for rule in EVENT_LOG_RULES if rule.name in RULED_RAW_COLUMNS]
    raw = constraints.apply_defaults(fx.order_raw_events(spark, sf_dir), rules)
    checked = constraints.enforce_constraints(constraints.nan_columns_to_null(raw), rules)
    return checked.select("id", *RULED_RAW_COLUMNS, "reject_reason")


def _event_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.order_events(spark, sf_dir)
    events = events.withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    sent = lifecycle.to_messages(events)

    read = F.from_json(
        "value", "event_type string, event_ts string, signup_date string, churn string, tenure int, "
        "monthly_charges double")
    return sent.select("topic", "key", "value", read.alias("read")).select(
        "topic", "key", "read.*",
        F.col("value").contains('"churn_date":null').alias("null_churn_date"),
        F.col("value").contains('"contract":null').alias("null_contract"),
    )


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.preprocess(fx.order_profiles(spark, sf_dir), order=["o_orderkey"])


def _batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "events").withColumn("batch_day", F.to_date("ts"))


def _batch_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = st.keep_first(_batches(spark, sf_dir), ["batch_day", "user_id"], ["event_id"])
    return first.select("batch_day", "user_id", "event_id", "value")


def _batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    scorer = scoring.LogitScorer(-1.0, {"value": 0.01})
    scored = scorer(_batches(spark, sf_dir)).withColumns({
        "churn_predicted": decision("churn_score", 0.5),
        "churn_score": F.round("churn_score", 4).cast("decimal(5,4)"),
    })
    return metrics.batch_metrics(scored, ["batch_day"])


def _run_job(spark: SparkSession, sf_dir: str, max_files: int | None = None, scorer=fx.SCORER) -> str:
    """Run the job over the events table and return the folder of its logs.

    Scores depend on where a micro-batch ends: without ``max_files`` the table is one batch.
    """
    folder = work_dir(spark, "job")
    config = JobConfig(
        root=f"{folder}/logs", checkpoint=f"{folder}/checkpoint", spread=_spread(fx.table(spark, sf_dir, "events"))
    )
    messages = fx.message_stream(spark, sf_dir, max_files)
    query = start_job(messages, scorer, config, available_now=True)
    query.awaitTermination()
    return config.root


def _envelope(events: DataFrame) -> DataFrame:
    # The identity and the time of an event travel beside its message.
    events = events.withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    return lifecycle.to_envelope(lifecycle.to_messages(events, keep=("id", "event_ts")), F.col("event_ts"), F.col("id"))


def _kept_state(state: DataFrame, *extra: str) -> DataFrame:
    kept = [rule.name for rule in EVENT_LOG_RULES if rule.name != "ingested_ts"]
    return state.select(F.col("arrival.offset").alias("id"), *kept, *extra)


def _publish(spark: SparkSession, sf_dir: str, folder: str, batches: int, part: Column | None = None) -> int:
    """Write the events of the orders, or those of a part, as files of messages; returns how many make a batch of ``batches``."""
    orders = fx.table(spark, sf_dir, "orders")
    chosen = orders if part is None else orders.filter(part)
    a_batch = _share(chosen.count(), batches)
    # Dealt out as orders: the scan has few and large tasks, and messages are many times as wide.
    dealt = chosen.repartition(batches * a_batch, "o_orderkey")
    write_event_files(_envelope(fx.events_of(dealt)), folder, partitions=batches * a_batch)
    return a_batch


def _publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events published to several files, read back in seven batches, and the state they leave."""
    folder = work_dir(spark, "published")
    a_batch = _publish(spark, sf_dir, f"{folder}/files", PUBLISHED_FILES)
    config = JobConfig(root=f"{folder}/logs", checkpoint=f"{folder}/checkpoint", spread=max(SPREAD, a_batch))
    stream = read_event_files(spark, f"{folder}/files", max_files_per_trigger=a_batch)
    start_job(stream, None, config, available_now=True).awaitTermination()
    return _kept_state(st.latest_state(logs.read_log(spark, config.root, logs.EVENTS)))


def _stream_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The states that a streaming aggregation keeps: every other event first, then, after a restart on the
    same checkpoint and with a timed trigger, the rest, of which many are older than the state."""
    folder = work_dir(spark, "states")

    def deliver(number: int) -> int:
        return _publish(spark, sf_dir, f"{folder}/files/delivery={number}", 3, F.col("o_orderkey") % 2 == number)

    def start(available_now: bool):
        stream = read_event_files(spark, f"{folder}/files/*", max_files_per_trigger=a_batch)
        # A part of the store takes what three files of a batch hold: it has a database of its own.
        return states.start_latest_states(
            stream, f"{folder}/logs", f"{folder}/checkpoint", available_now, trigger_seconds=1,
            partitions=max(STORE_PARTS, ceil(a_batch / 3)))

    a_batch = deliver(1)
    start(available_now=True).awaitTermination()
    deliver(0)
    query = start(available_now=False)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return _kept_state(states.states_from_store(spark, f"{folder}/checkpoint"))


class _Stop(Exception):
    """What a query of a restart stops its job with."""


def _stopped(query: StreamingQuery) -> None:
    """Wait for the end of a job that is stopped by ``_Stop``; any other failure is one."""
    try:
        query.awaitTermination()
    except StreamingQueryException as failure:
        if "_Stop" not in str(failure):
            raise
    else:
        raise RuntimeError("the job was to stop in the middle")


def _restart_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job over several files that stops in its fourth batch, after both writes and before the
    checkpoint has the batch, and is started again: the state, and how often each customer is in both logs."""
    folder = work_dir(spark, "restart")
    a_batch = _publish(spark, sf_dir, f"{folder}/files", PUBLISHED_FILES)
    config = JobConfig(root=f"{folder}/logs", checkpoint=f"{folder}/checkpoint", spread=max(SPREAD, a_batch))

    def stop(batch_id: int, counts: dict) -> None:
        if batch_id == 3:
            raise _Stop

    def start(on_metrics=None):
        stream = read_event_files(spark, f"{folder}/files", max_files_per_trigger=a_batch)
        return start_job(stream, fx.SCORER, config, available_now=True, on_metrics=on_metrics)

    _stopped(start(stop))
    start().awaitTermination()
    events, scores = logs.read_log(spark, config.root, logs.EVENTS), logs.read_log(spark, config.root, logs.SCORES)
    counted = events.groupBy("customer_id").agg(F.count("*").alias("nb_evenements"))
    # A customer has one score a batch.
    expected = events.select("customer_id", "batch_id").distinct().groupBy("customer_id").agg(F.count("*").alias("nb_lots"))
    scored = scores.groupBy("customer_id").agg(F.count("*").alias("nb_scores"))
    joined = st.latest_state(events).join(counted, "customer_id").join(expected, "customer_id").join(scored, "customer_id", "left")
    one_each = (F.col("nb_lots") == F.col("nb_scores")).alias("un_score_par_lot")
    return _kept_state(joined.withColumn("un_score_par_lot", one_each), "nb_evenements", "un_score_par_lot")


def _replay_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores after the job failed between the two writes of its batch and was started again."""
    folder = work_dir(spark, "replay")
    spread = _spread(fx.table(spark, sf_dir, "events"))
    config = JobConfig(root=f"{folder}/logs", checkpoint=f"{folder}/checkpoint", spread=spread)

    def broken(inputs: DataFrame) -> DataFrame:
        raise _Stop

    _stopped(start_job(fx.message_stream(spark, sf_dir), broken, config, available_now=True))
    start_job(fx.message_stream(spark, sf_dir), fx.SCORER, config, available_now=True).awaitTermination()
    return _score_rows(logs.read_log(spark, config.root, logs.SCORES))


def _job_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day of messages a micro-batch: each score with the counts that the job took of its batch."""
    folder = work_dir(spark, "days")
    root, events = f"{folder}/logs", fx.table(spark, sf_dir, "events")
    # Dealt out by time, as events and not as their wider messages: a day has as many files as it needs. They are
    # smaller than others, as a day is read alone.
    dealt = events.repartitionByRange(_share(4 * events.count()), "ts", "event_id")
    sent = fx.messages(dealt).withColumn("day", F.to_date("timestamp"))
    sent.write.partitionBy("day").parquet(f"{folder}/days")

    def start(day) -> StreamingQuery:
        # Each day is a job over all files of its folder, so it is one batch.
        name = f"day={day or '__HIVE_DEFAULT_PARTITION__'}"
        stream = read_event_files(spark, f"{folder}/days/{name}")
        return start_job(stream, fx.SCORER, JobConfig(root, f"{folder}/checkpoint/{name}"), available_now=True)

    days = [day for (day,) in events.select(F.to_date("ts")).distinct().collect()]
    for first in range(0, len(days), DAYS_AT_ONCE):
        running = [start(day) for day in days[first:first + DAYS_AT_ONCE]]
        try:
            for query in running:
                query.awaitTermination()
        finally:
            for query in running:
                query.stop()
    scores = logs.read_log(spark, root, logs.SCORES)
    counts = logs.read_metrics(spark, root)
    return scores.join(counts, ["query_id", "batch_id"]).select(
        F.to_date("arrival.timestamp").alias("jour"), F.col("arrival.offset").alias("event_id"), "customer_id",
        "churn_score", "churn_predicted", "nb_evenements", "nb_rejets", "nb_scores", "nb_a_risque", "score_moyen")


def _recent_log(spark: SparkSession, sf_dir: str, root: str, log: str) -> DataFrame:
    """Events or scores of the last days, stored as three batches of the job would be, and read back."""
    rows, rules = ((fx.recent_events, EVENT_LOG_RULES) if log == logs.EVENTS else (fx.recent_scores, SCORE_LOG_RULES))
    day = logs.DAY_OF[log]
    rows = rows(spark, sf_dir).withColumns({
        "event_ts": F.col("event_ts").cast("timestamp"),
        "arrival": F.struct(F.col(day).cast("timestamp").alias("timestamp"), F.lit("t").alias("topic"),
                            F.lit(0).alias("partition"), F.col("id").alias("offset")),
        "reject_reason": F.lit(None).cast("string"), "raw_value": F.lit(None).cast("string")})
    rows = rows.select(*[rule.name for rule in rules], "arrival", "reject_reason", *(["raw_value"] if log == logs.EVENTS else []))
    parts = 3
    for batch in range(parts):
        some = rows.filter(F.pmod(F.datediff(day, F.lit(fx.AS_OF)), F.lit(parts)) == batch)
        logs.write_batch(some.repartition(F.to_date(day)), root, log, "export", batch)
    return logs.read_log(spark, root, log)


def _recent_logs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    root = work_dir(spark, "recent")
    return _recent_log(spark, sf_dir, root, logs.EVENTS), _recent_log(spark, sf_dir, root, logs.SCORES)


def _log_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, scores = _recent_logs(spark, sf_dir)
    return st.live_feed(st.within_days(events, 30, fx.AS_OF), scores, 50)


def _log_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, scores = _recent_logs(spark, sf_dir)
    return reports.live_kpis_from_logs(events, scores, fx.AS_OF, KPI_HOURS, day_column="ingest_date")


def _log_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _recent_log(spark, sf_dir, work_dir(spark, "retention"), logs.EVENTS)
    kept = lifecycle.retain(events, fx.AS_OF, days=7, ts="ingested_ts", day_column="ingest_date")
    return kept.select(F.col("arrival.offset").alias("id"), "customer_id", "ingested_ts")


def _log_score_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.score_lookup(_recent_log(spark, sf_dir, work_dir(spark, "lookup"), logs.SCORES), "7")


def _profile_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles written to files of two column orders and read back by their headers."""
    folder = work_dir(spark, "profiles")
    raw = fx.customer_profiles(spark, sf_dir)
    names = [name for name in raw.columns if name != "c_custkey"]
    for turn, order in enumerate((names, names[::-1])):
        part = raw.filter(F.col("c_custkey") % 2 == turn).select(*order)
        part.repartition(PUBLISHED_FILES).write.option("header", True).option("escape", '"').csv(f"{folder}/order={turn}")
    read = profiles.read_profiles(spark, f"{folder}/order=*")
    return parsing.coerce_profiles(parsing.rename_profiles(read))


def _published_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile file through the publishing command and the job: the state it leaves, and the refused profiles."""
    folder = work_dir(spark, "replay-files")
    raw = fx.dated_profiles(spark, sf_dir).drop("c_custkey")
    raw.repartition(PUBLISHED_FILES).write.option("header", True).option("escape", '"').csv(f"{folder}/profiles")
    files = PUBLISHED_FILES * _share(raw.count(), PUBLISHED_FILES)
    publish.main(["--profiles", f"{folder}/profiles", "--files", f"{folder}/topics", "--partitions", str(files),
                  "--rejects", f"{folder}/refused", "--as-of", fx.AS_OF, "--source", "replay"], spark)
    config = JobConfig(root=f"{folder}/logs", checkpoint=f"{folder}/checkpoint", spread=_spread(raw))
    start_job(read_event_files(spark, f"{folder}/topics"), None, config, available_now=True).awaitTermination()
    state = st.latest_state(logs.read_log(spark, config.root, logs.EVENTS)).drop("arrival", "ingested_ts")
    refused = spark.read.parquet(f"{folder}/refused")
    shown = ("customer_id", "senior_citizen", "tenure", "contract", "monthly_charges", "total_charges", "churn",
             "signup_date", "churn_date", "event_type", "event_ts", "source", "reject_reason")
    return state.unionByName(refused, allowMissingColumns=True).select(*shown)


def _exported_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of stored logs through the exporting command, in each of its formats: all rows as (report, group, figures)."""
    folder = work_dir(spark, "exported")
    root = f"{folder}/logs"
    _recent_log(spark, sf_dir, root, logs.EVENTS), _recent_log(spark, sf_dir, root, logs.SCORES)
    # The columns of each report: its group, a count of rows, and a figure.
    asked = {
        "rate_by_contract": ("csv", "contract", "nb_clients", "taux_churn"),
        "rate_by_services": ("csv", "nb_services", "nb_clients", "taux_churn"),
        "cohort_retention": ("json", "mois_cohorte", "taille_cohorte", "duree_moy_avant_churn_jours"),
        "weekly_trend": ("parquet", "semaine", "nb_churns", "mrr_moyen_perdu"),
        "churn_velocity": ("json", "contract", "nb_churners", "delai_moyen_jours"),
        "actual_vs_predicted": ("parquet", "model_version", "clients_evalues", "score_moyen"),
        "customers_at_risk": ("csv", "customer_id", "tenure", "churn_score"),
    }
    rows = []
    for form in export.FORMATS:
        names = [name for name, columns in asked.items() if columns[0] == form]
        export.main(["--root", root, "--as-of", fx.AS_OF, "--reports", ",".join(names), "--to", f"{folder}/reports",
                     "--format", form], spark)
        for name in names:
            _, group, count, figure = asked[name]
            # Files of text give texts back.
            read = spark.read.format(form).option("header", True).load(f"{folder}/reports/{name}")
            rows.append(read.select(
                F.lit(name).alias("rapport"), F.col(group).cast("string").alias("groupe"),
                F.col(count).cast("bigint").alias("nombre"), F.col(figure).cast("double").alias("valeur")))
    return reduce(DataFrame.unionByName, rows)


def _bucketed_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer view over two stored tables that a later session attaches and joins without a shuffle."""
    folder = work_dir(spark, "bucketed")
    token = folder.rsplit("-", 1)[-1]
    found = []
    for name, df in (("etats", _state(spark, sf_dir)), ("scores", st.latest_score(fx.order_scores(spark, sf_dir)))):
        tables.save_bucketed(df, f"{name}_{token}", f"{folder}/{name}", buckets=STORE_PARTS)
        found.append(tables.attach_bucketed(
            spark, f"{name}_lus_{token}", f"{folder}/{name}", df.schema, buckets=STORE_PARTS))
    return st.join_360(*found, fx.AS_OF)


NUMERIC = ("MonthlyCharges", "tenure", "NewClient", "NbServices", "SeniorCitizen")
CATEGORICAL = {"Contract": ("Month-to-month", "Two year")}


def _pipeline_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job with a fitted ``spark.ml`` pipeline, loaded once, against the fit's own weights as a logit."""
    folder = work_dir(spark, "pipeline")
    training = features.add_features(features.to_training_names(_state(spark, sf_dir))).withColumn(
        "label", F.when(F.col("Churn") == "Yes", 1.0).when(F.col("Churn") == "No", 0.0))
    model = scoring.fit_pipeline(training, "label", NUMERIC, CATEGORICAL)
    model.write().overwrite().save(f"{folder}/model")
    scorer = scoring.load_scorer(f"{folder}/model", f"{folder}/copy")
    root = _run_job(spark, sf_dir, scorer=scorer)
    own = scoring.logit_of(scoring.load_scorer(f"{folder}/absent", f"{folder}/copy").model, NUMERIC, CATEGORICAL)
    again = score_events(logs.read_log(spark, root, logs.EVENTS), own, JobConfig(root, ""))
    again = again.select("arrival", F.col("churn_score").alias("own_score"), F.col("churn_predicted").alias("own_decision"))
    scores = logs.read_log(spark, root, logs.SCORES).join(again, "arrival", "full")
    # The stored scores have four decimals; sums in another order may round to the next one.
    same = (F.abs(F.col("churn_score") - F.col("own_score")) <= 0.0001) & (F.col("churn_predicted") == F.col("own_decision"))
    return scores.select(F.col("arrival.offset").alias("event_id"), "customer_id", same.alias("same_score"))


def _fallback_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores by the copy of a model that cannot be read at its own place."""
    folder = work_dir(spark, "fallback")
    fx.SCORER.to_table(spark).write.parquet(f"{folder}/copy")
    scorer = scoring.load_coefficients(spark, f"{folder}/absent", f"{folder}/copy")
    return scoring.score_profiles(fx.customer_requests(spark, sf_dir), scorer, keep=("c_custkey",))


def _padded_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of profiles whose column names have blanks around them."""
    raw = fx.order_profiles(spark, sf_dir)
    return features.preprocess(raw.toDF(*[f"  {name} " for name in raw.columns]), order=["o_orderkey"])


def _stream_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "parsed")
    stream = fx.message_stream(spark, sf_dir, FILES_PER_BATCH)
    spread = _spread(fx.table(spark, sf_dir, "events"))
    parsed = parsing.parse_events(stream.repartition(spread, "topic", "partition", "offset"))
    parsed = parsed.withColumn("event_id", F.col("arrival.offset")).drop("arrival", "raw_value")
    query = (
        parsed.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True).start(f"{folder}/rows")
    )
    query.awaitTermination()
    return spark.read.schema(parsed.schema).parquet(f"{folder}/rows")


def _stream_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = logs.read_log(spark, _run_job(spark, sf_dir, FILES_PER_BATCH, None), logs.EVENTS)
    kept = [rule.name for rule in EVENT_LOG_RULES if rule.name != "ingested_ts"]
    return rows.select(F.col("arrival.offset").alias("event_id"), *kept)


def _stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = logs.read_rejects(spark, _run_job(spark, sf_dir, FILES_PER_BATCH, None))
    return rows.select(F.col("arrival.offset").alias("event_id"), "customer_id", "reject_reason")


def _score_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("arrival.offset").alias("event_id"), "customer_id", "churn_score", "churn_predicted",
        "seuil_applique", "model_name", "model_version", "event_ts",
    )


def _stream_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _score_rows(logs.read_log(spark, _run_job(spark, sf_dir), logs.SCORES))


def _stream_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _run_job(spark, sf_dir)
    full = st.customer_360(
        logs.read_log(spark, root, logs.EVENTS), logs.read_log(spark, root, logs.SCORES),
        "2024-02-01 00:00:00",
    )
    return full.drop("predicted_ts")


def _scored_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_profiles(
        fx.customer_requests(spark, sf_dir), fx.SCORER, keep=("c_custkey",)
    )


QUERIES: dict[str, Query] = {
    "rate_by_contract": lambda s, d: reports.rate_by_contract(_state(s, d)),
    "latest_state": lambda s, d: _state(s, d).select(*STATE_COLUMNS),
    "merged_state": lambda s, d: _merged_state(s, d).select(*STATE_COLUMNS),
    "latest_score": lambda s, d: st.latest_score(fx.order_scores(s, d)),
    "customer_360": _view_360,
    "score_lookup": lambda s, d: st.score_lookup(fx.order_scores(s, d), "7"),
    "live_feed": lambda s, d: st.live_feed(fx.order_events(s, d), fx.order_scores(s, d), 50),
    "live_feed_recent": _live_feed_recent,
    "view_query": _view_query,
    "actual_vs_predicted": lambda s, d: reports.actual_vs_predicted(_view_360(s, d)),
    "customers_at_risk": lambda s, d: reports.customers_at_risk(_view_360(s, d), 50),
    "live_kpis": lambda s, d: reports.live_kpis(_view_360(s, d), fx.AS_OF, KPI_HOURS),
    "live_kpis_from_logs": lambda s, d: reports.live_kpis_from_logs(
        fx.order_events(s, d), fx.order_scores(s, d), fx.AS_OF, KPI_HOURS
    ),
    "rate_by_tenure": lambda s, d: reports.rate_by_tenure(_state(s, d)),
    "rate_by_services": lambda s, d: reports.rate_by_services(_state(s, d)),
    "cohort_retention": lambda s, d: reports.cohort_retention(_state(s, d)),
    "recent_cohorts": lambda s, d: reports.recent_cohorts(_state(s, d)),
    "churn_velocity": lambda s, d: reports.churn_velocity(_state(s, d)),
    "weekly_trend": lambda s, d: reports.weekly_trend(_state(s, d)),
    "base_summary": lambda s, d: reports.base_summary(_state(s, d)),
    "typed_profiles": lambda s, d: _typed_profiles(s, d).drop("c_custkey"),
    "validated_profiles": lambda s, d: constraints.validate_profiles(
        fx.customer_requests(s, d)).select("c_custkey", *PROFILE_DEFAULTS, "reject_reason"),
    "constraint_rejects": _constraint_rejects,
    "features": _features,
    "scored_profiles": _scored_profiles,
    "lifecycle_dates": lambda s, d: _dated_profiles(s, d).select(
        "customer_id", "tenure", "total_charges", "churn", "signup_date", "churn_date", "reject_reason"),
    "lifecycle_events": lambda s, d: _lifecycle_events(s, d).select(
        *PROFILE_COLUMNS, "signup_date", "churn_date", "event_type", "event_ts", "source", "reject_reason"),
    "event_routing": _event_routing,
    "publish_roundtrip": _publish_roundtrip,
    "retention_window": lambda s, d: lifecycle.retain(
        fx.order_events(s, d), fx.AS_OF, days=7, ts="ingested_ts"
    ).select("id", "customer_id", "ingested_ts"),
    "stream_parsed": _stream_parsed,
    "stream_event_log": _stream_event_log,
    "stream_rejects": _stream_rejects,
    "stream_scored": _stream_scored,
    "stream_360": _stream_360,
    "batch_dedupe": _batch_dedupe,
    "batch_metrics": _batch_metrics,
    "all_rates": lambda s, d: reports.all_rates(_state(s, d)),
    "rates_in_order": lambda s, d: reports.placed(reports.rate_by_contract(_state(s, d))),
    "bands_in_order": lambda s, d: reports.placed(reports.rate_by_tenure(_state(s, d))),
    "first_report_row": lambda s, d: reports.first_row(reports.rate_by_contract(_state(s, d))),
    "first_profiles": lambda s, d: profiles.first_profiles(
        _typed_profiles(s, d), 100, ["customer_id"]).select("customer_id", "tenure", "contract"),
    "padded_features": _padded_features,
    "fallback_scored": _fallback_scored,
    "bucketed_360": _bucketed_360,
    "published_profiles": _published_profiles,
    "exported_reports": _exported_reports,
    "profile_files": _profile_files,
    "log_feed": _log_feed,
    "log_kpis": _log_kpis,
    "log_retention": _log_retention,
    "log_score_lookup": _log_score_lookup,
    "job_by_day": _job_by_day,
    "stream_latest_state": _stream_latest_state,
    "restart_roundtrip": _restart_roundtrip,
    "replay_roundtrip": _replay_roundtrip,
    "pipeline_scored": _pipeline_scored,
}


def queries() -> dict[str, Query]:
    def prepared(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(query(apply_settings(spark), sf_dir))

        return run

    return {name: prepared(query) for name, query in QUERIES.items()}
