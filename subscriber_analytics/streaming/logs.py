"""The logs as Parquet folders.

    <root>/events/landing/query_id=<id>/batch_id=<n>/accepted=<true|false>/ingest_date=<day>/part-*.parquet
    <root>/scores/landing/query_id=<id>/batch_id=<n>/accepted=<true|false>/ingest_date=<day>/part-*.parquet
    <root>/metrics/landing/query_id=<id>/batch_id=<n>/part-*.parquet

A batch is one folder, written by overwrite: a batch that is delivered twice replaces itself. The
query id, kept in the checkpoint, is part of the path because a job with a new checkpoint counts its
batches from 0 again. The days lie inside the batch: both times that they are taken from are the
start of the micro-batch, so a replay writes the same day, and it would replace another one.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscriber_analytics.operators.constraints import REASON
from subscriber_analytics.schemas import EVENT_LOG_SCHEMA, SCORE_LOG_SCHEMA

EVENTS, SCORES, METRICS = "events", "scores", "metrics"
METRICS_SCHEMA = (
    "nb_evenements bigint, nb_rejets bigint, nb_scores bigint, nb_a_risque bigint, score_moyen decimal(20,3)"
)
_SCHEMAS = {EVENTS: EVENT_LOG_SCHEMA, SCORES: SCORE_LOG_SCHEMA, METRICS: METRICS_SCHEMA}
_FOLDERS = "query_id string, batch_id bigint"
_SPLIT = "accepted boolean, ingest_date date"
DAY_OF = {EVENTS: "ingested_ts", SCORES: "predicted_ts"}

# A lookup by customer skips the row groups whose Bloom filter (or dictionary, where it holds the
# whole column) does not have the key. Adaptive filters are as small as the column allows.
LOOKUP_OPTIONS = {
    "parquet.bloom.filter.enabled#customer_id": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.bloom.filter.candidates.number#customer_id": "14",
}


def batch_path(root: str, log: str, query_id: str, batch_id: int) -> str:
    return f"{root}/{log}/landing/query_id={query_id}/batch_id={batch_id}"


def write_batch(rows: DataFrame, root: str, log: str, query_id: str, batch_id: int) -> None:
    """Write all rows of a batch in one pass, good and rejected ones and each day to folders of their own.

    Each file is in the order of its customers: the write has to sort by folder anyway.
    """
    folders = ["accepted", "ingest_date"]
    (
        rows.withColumns({"accepted": F.col(REASON).isNull(), "ingest_date": F.col(DAY_OF[log]).cast("date")})
        .sortWithinPartitions(*folders, "customer_id")
        .write.mode("overwrite").option("partitionOverwriteMode", "static").options(**LOOKUP_OPTIONS)
        .partitionBy(*folders).parquet(batch_path(root, log, query_id, batch_id))
    )


def write_metrics(spark: SparkSession, counts: dict, root: str, query_id: str, batch_id: int) -> None:
    """One row with the counts of a batch; what was not counted is NULL."""
    fields = [field.split(" ") for field in METRICS_SCHEMA.split(", ")]
    row = spark.range(1, numPartitions=1).select(*[F.lit(counts.get(name)).cast(kind).alias(name) for name, kind in fields])
    row.write.mode("overwrite").parquet(batch_path(root, METRICS, query_id, batch_id))


def read_batch(spark: SparkSession, root: str, log: str, query_id: str, batch_id: int
               ) -> DataFrame:
    """The good rows of one batch."""
    schema = f"{_SCHEMAS[log]}, {_SPLIT}"
    rows = spark.read.schema(schema).parquet(batch_path(root, log, query_id, batch_id))
    return rows.filter("accepted").drop("accepted", "ingest_date", REASON, "raw_value")


def _read_all(spark: SparkSession, root: str, log: str, schema: str) -> DataFrame:
    """All batches of a log; the folder names give query, batch, acceptance and day."""
    try:
        return spark.read.schema(schema).parquet(f"{root}/{log}/landing")
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_log(spark: SparkSession, root: str, log: str) -> DataFrame:
    """All good rows of a log.

    Besides the log columns a row has ``query_id``, ``batch_id`` and ``ingest_date``. All three are
    folders: the files of other days are listed, as all files of a log are, but never opened.
    """
    rows = _read_all(spark, root, log, f"{_SCHEMAS[log]}, {_FOLDERS}, {_SPLIT}")
    return rows.filter("accepted").drop("accepted", REASON, "raw_value")


def read_rejects(spark: SparkSession, root: str, log: str = EVENTS) -> DataFrame:
    """All rejected rows of a log with their reason and, for events, the raw message."""
    rows = _read_all(spark, root, log, f"{_SCHEMAS[log]}, {_FOLDERS}, {_SPLIT}")
    return rows.filter("NOT accepted").drop("accepted")


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """The counts of every batch that the job has scored, one row each."""
    return _read_all(spark, root, METRICS, f"{_SCHEMAS[METRICS]}, {_FOLDERS}")
