"""Event streams, as envelopes ``(key, value, topic, partition, offset, timestamp)``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscriber_analytics.schemas import DEFAULT_TOPICS, ENVELOPE_SCHEMA

ENVELOPE_COLUMNS = tuple(field.split(" ")[0] for field in ENVELOPE_SCHEMA.split(", "))


def kafka_options(servers: str, topics: Iterable[str] = DEFAULT_TOPICS, **options: str
                  ) -> dict[str, str]:
    """Options of the Kafka source: all topics in one subscription, a first start at the newest
    messages, and no failure when the broker has already dropped some. A checkpoint wins over the
    start position.

    ``maxOffsetsPerTrigger`` bounds a batch and ``minPartitions`` splits large topic partitions over
    more tasks; pass both at scale.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        **options,
    }


def read_event_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Kafka topics as one stream. Needs the Kafka connector of Spark on the class path."""
    return spark.readStream.format("kafka").options(**options).load().select(*ENVELOPE_COLUMNS)


def read_event_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None
                     ) -> DataFrame:
    """Parquet files of envelopes as a stream, with the same columns as a Kafka source."""
    reader = spark.readStream.schema(ENVELOPE_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def write_to_kafka(messages: DataFrame, servers: str, **options: str) -> None:
    """Publish ``(topic, key, value)`` messages; the broker places each key in one partition.

    The events of a profile leave one task one after the other, so their order holds without a
    shuffle. Needs the Kafka connector of Spark on the class path.
    """
    messages.select("topic", "key", "value").write.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "kafka.acks": "all", **options}
    ).save()


def write_event_files(envelope: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write envelopes as Parquet, ordered by topic, partition and arrival.

    The rows are split by range, not by hash of the key: a key that holds a large share of the rows
    is cut by arrival time over several files, and each file still has its part in order.
    """
    order = ["topic", "partition", "timestamp", "offset"]
    ranges = (
        envelope.repartitionByRange(*order) if partitions is None
        else envelope.repartitionByRange(partitions, *order)
    )
    ranges.sortWithinPartitions(*order).select(*[F.col(c) for c in ENVELOPE_COLUMNS]).write.mode(
        "overwrite"
    ).parquet(path)
