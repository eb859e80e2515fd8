"""The latest event of every customer, kept up to date by a streaming aggregation.

    stream -> parse and check -> max_by per customer in the state store -> changed customers of each batch

A report on the latest state then reads one row a customer, from the state store or from the changes,
instead of the whole event log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from subscriber_analytics.operators.constraints import REASON
from subscriber_analytics.operators.parsing import parse_events, to_event_log
from subscriber_analytics.operators.state import latest_state
from subscriber_analytics.schemas import ARRIVAL_TYPE, EVENT_LOG_RULES
from subscriber_analytics.streaming.logs import LOOKUP_OPTIONS, batch_path

STATES = "states"
_SCHEMA = ", ".join([*[f"{r.name} {r.spark_type}" for r in EVENT_LOG_RULES], f"arrival {ARRIVAL_TYPE}"])
_QUERY_ID = "sql.streaming.queryId"


def latest_states(messages: DataFrame) -> DataFrame:
    """The last good event of each customer by source position, over a stream of envelopes.

    The store keeps one event a customer. Each task first finds the last event of its own rows, so a customer
    with a large share of a batch sends one row a task. A message that arrives late, with a lower position than
    the stored one, changes nothing.
    """
    rows = to_event_log(parse_events(messages))
    # No filter on the reason: pushed down, its long text would be built for each of the columns again. Rows
    # without an order do not count in max_by.
    order = F.when(F.col(REASON).isNull(), F.struct("arrival", "ingested_ts"))
    last = F.max_by(F.struct(*[name for name in rows.columns if name not in (REASON, "raw_value")]), order)
    return rows.groupBy("customer_id").agg(last.alias("last")).filter(F.col("last").isNotNull()).select("last.*")


def start_latest_states(messages: DataFrame, root: str, checkpoint: str, available_now: bool = False,
                        trigger_seconds: int = 10, partitions: int | None = None) -> StreamingQuery:
    """Keep the states of a stream of envelopes up to date; the changed ones of a batch go to a folder of their own.

    ``root`` and ``checkpoint``, which holds the store, lie on shared storage. ``partitions`` is the number of
    parts of the store, by default that of the session's shuffles; the first start fixes it for good.
    """
    spark = messages.sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    def write(changed: DataFrame, batch_id: int) -> None:
        query_id = changed.sparkSession.sparkContext.getLocalProperty(_QUERY_ID)
        if query_id is None:
            raise RuntimeError("the batch does not belong to a streaming query")
        changed.write.mode("overwrite").options(**LOOKUP_OPTIONS).parquet(batch_path(root, STATES, query_id, batch_id))

    writer = latest_states(messages).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    writer = (
        writer.trigger(availableNow=True) if available_now
        else writer.trigger(processingTime=f"{trigger_seconds} seconds")
    )
    # A query keeps the settings that the session had when it started.
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions or before))
    try:
        return writer.foreachBatch(write).start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def read_changes(spark: SparkSession, root: str) -> DataFrame:
    """Each change of a state, with the query and the batch that made it."""
    schema = f"{_SCHEMA}, query_id string, batch_id bigint"
    return spark.read.schema(schema).parquet(f"{root}/{STATES}/landing")


def states_from_changes(spark: SparkSession, root: str) -> DataFrame:
    """The latest states from the changes of all batches, at most one row a customer and batch."""
    return latest_state(read_changes(spark, root), ["arrival", "ingested_ts"]).drop("query_id", "batch_id")


def states_from_store(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The latest states as the last finished batch left them in the state store: one row a customer."""
    stored = spark.read.format("statestore").load(checkpoint)
    buffer = stored.schema["value"].dataType.names[0]
    return stored.select(F.col(f"value.`{buffer}`").alias("last")).filter(F.col("last").isNotNull()).select("last.*")
