"""Publish profile files as lifecycle events: ``python -m subscriber_analytics.streaming.publish --help``."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from subscriber_analytics.functions.columns import as_of_timestamp
from subscriber_analytics.operators import lifecycle
from subscriber_analytics.operators.constraints import REASON, accepted, rejected
from subscriber_analytics.session import build_session
from subscriber_analytics.sources.events import write_event_files, write_to_kafka
from subscriber_analytics.sources.profiles import first_profiles, read_profiles

log = logging.getLogger("subscriber_analytics")

Sink = Callable[[DataFrame], None]


def kafka_sink(servers: str, **options: str) -> Sink:
    """Events to the topics of their types."""
    return lambda events: write_to_kafka(lifecycle.to_messages(events), servers, **options)


def file_sink(path: str, partitions: int | None = None) -> Sink:
    """Events as envelope files, which ``--files`` of the job reads.

    The offset comes from the customer and the type, so a repeated run writes the same envelopes. The two events
    of a customer are in the order of their creation times, which are the arrival times here.
    """
    def write(events: DataFrame) -> None:
        offset = F.shiftrightunsigned(F.xxhash64("customer_id", "event_type"), 1)
        messages = lifecycle.to_messages(events.withColumn("_offset", offset), keep=("event_ts", "_offset"))
        write_event_files(lifecycle.to_envelope(messages, F.col("event_ts"), F.col("_offset")), path, partitions)

    return write


def publish_profiles(profiles: DataFrame, send: Sink, rejects: str | None = None, as_of=None,
                     source: str = "kafka_simulator") -> dict[str, int]:
    """Send the lifecycle events of raw text profiles, and store the refused profiles with their reasons.

    Returns ``nb_evenements`` and ``nb_refus``. Without ``rejects`` the refused profiles are only counted. ``as_of`` is read once, so the events and the refused profiles of a run agree.
    """
    spark = profiles.sparkSession
    if as_of is None:
        as_of = spark.range(1).select(as_of_timestamp(None).alias("now")).first()["now"]
    rows = lifecycle.replay_profiles(profiles, as_of, source)
    # Both counts come from the pass that stores the refused profiles: a sink may read its input more than once.
    counts = Observation("published")
    good = F.col(REASON).isNull()
    refused = rejected(rows.observe(counts, F.count_if(good).alias("nb_evenements"), F.count_if(~good).alias("nb_refus")))
    if rejects is None:
        refused.write.format("noop").mode("overwrite").save()
    else:
        refused.drop("signup_date", "churn_date", "event_type", "event_ts").write.mode("overwrite").parquet(rejects)
    send(accepted(rows))
    return counts.get


def parse_arguments(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--profiles", required=True, help="CSV file, folder or pattern")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--servers", help="Kafka bootstrap servers")
    target.add_argument("--files", help="folder for envelope files instead of Kafka")
    parser.add_argument("--partitions", type=int, help="number of envelope files")
    parser.add_argument("--rejects", help="folder for refused profiles and their reasons")
    parser.add_argument("--limit", type=int, default=0, help="first profiles by customer; 0 is all of them")
    parser.add_argument("--as-of", help="time of the events and of estimated dates; now if absent")
    parser.add_argument("--source", default="kafka_simulator", help="source named in the events")
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, int]:
    given = parse_arguments(arguments)
    spark = build_session() if spark is None else spark
    profiles = first_profiles(read_profiles(spark, given.profiles), given.limit, ["customerID"])
    send = kafka_sink(given.servers) if given.servers else file_sink(given.files, given.partitions)
    counts = publish_profiles(profiles, send, given.rejects, given.as_of, given.source)
    log.info("published: %s", counts)
    return counts


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    main()
