"""Parse, store and score events in micro-batches.

    stream -> parse and check -> event log (one pass) -> read the batch back
           -> first event per customer -> features -> score -> score log

The stored batch takes the place of a cache: it is columnar, the scoring step reads only what it
needs of it, it survives the loss of executors, and the source is read once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from subscriber_analytics.operators.constraints import REASON
from subscriber_analytics.operators.features import model_inputs, preprocess, to_training_names
from subscriber_analytics.operators.metrics import metric_columns
from subscriber_analytics.operators.parsing import parse_events, to_event_log
from subscriber_analytics.operators.scoring import Scorer, to_score_log
from subscriber_analytics.sources.database import BatchTables
from subscriber_analytics.streaming.logs import EVENTS, SCORES, read_batch, write_batch, write_metrics

_QUERY_ID = "sql.streaming.queryId"


@dataclass(frozen=True)
class JobConfig:
    """Settings of a job.

    ``root`` holds the logs and ``checkpoint`` the progress; both lie on shared storage. ``spread``
    distributes the raw messages over that many tasks before they are parsed: set it where the source
    has fewer partitions than the cluster has cores, leave it None otherwise, as it costs a shuffle.
    """

    root: str
    checkpoint: str
    threshold: float = 0.5
    model_name: str = "churn_model"
    model_version: str = "1"
    trigger_seconds: int = 10
    spread: int | None = None


def score_events(events: DataFrame, scorer: Scorer, config: JobConfig) -> DataFrame:
    """One score log row per customer in the frame, from its first event in arrival order.

    The customer and its event time travel with the features, so a score cannot end up with another
    customer. The time of the score is that of the micro-batch, which a replay does not change.
    """
    keys = ["customerID", "event_ts", "arrival", "predicted_ts"]
    named = to_training_names(events).withColumnRenamed("ingested_ts", "predicted_ts")
    inputs = model_inputs(preprocess(named, order=["arrival"]), keep=keys)
    scored = scorer(inputs).withColumnRenamed("customerID", "customer_id")
    return to_score_log(scored, config.threshold, config.model_name, config.model_version)


def batch_processor(scorer: Scorer | None, config: JobConfig,
                    on_metrics: Callable[[int, dict], None] | None = None,
                    tables: BatchTables | None = None) -> Callable[[DataFrame, int], None]:
    """The function for ``foreachBatch`` on a stream of event log rows.

    An error leaves it, so that the batch is delivered again; what the first attempt wrote is then
    replaced. The counts of each scored batch come from its own writes, go to the metrics log and to
    ``on_metrics``. ``tables`` gets the good rows of both logs as well. Without a scorer events are stored only.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query_id = spark.sparkContext.getLocalProperty(_QUERY_ID)
        if query_id is None:
            raise RuntimeError("the batch does not belong to a streaming query")
        received = Observation(f"events_{batch_id}")
        write_batch(
            batch.observe(received, F.count_if(F.col(REASON).isNull()).alias("nb_evenements"),
                          F.count_if(F.col(REASON).isNotNull()).alias("nb_rejets")),
            config.root, EVENTS, query_id, batch_id,
        )
        events = read_batch(spark, config.root, EVENTS, query_id, batch_id)
        if tables is not None:
            tables.write(events, EVENTS, query_id, batch_id)
        if scorer is None or received.get["nb_evenements"] == 0:
            return
        scored = Observation(f"scores_{batch_id}")
        write_batch(
            score_events(events, scorer, config).observe(scored, *metric_columns(F.col(REASON).isNull())),
            config.root, SCORES, query_id, batch_id,
        )
        if tables is not None:
            tables.write(read_batch(spark, config.root, SCORES, query_id, batch_id), SCORES, query_id, batch_id)
        counts = {**received.get, **scored.get}
        write_metrics(spark, counts, config.root, query_id, batch_id)
        if on_metrics is not None:
            on_metrics(batch_id, counts)

    return process


def start_job(messages: DataFrame, scorer: Scorer | None, config: JobConfig, available_now: bool = False,
              on_metrics: Callable[[int, dict], None] | None = None,
              tables: BatchTables | None = None) -> StreamingQuery:
    """Start the job on a stream of envelopes. With ``available_now`` it processes what is there
    and stops."""
    if config.spread is not None:
        # By source position: even, the same when a task is repeated, and without the sort of an unkeyed repartition.
        messages = messages.repartition(config.spread, "topic", "partition", "offset")
    rows = to_event_log(parse_events(messages))
    writer = rows.writeStream.option("checkpointLocation", config.checkpoint)
    writer = (
        writer.trigger(availableNow=True) if available_now
        else writer.trigger(processingTime=f"{config.trigger_seconds} seconds")
    )
    return writer.foreachBatch(batch_processor(scorer, config, on_metrics, tables)).start()
