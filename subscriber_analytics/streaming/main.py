"""Run the streaming job: ``python -m subscriber_analytics.streaming.main --help``."""

from __future__ import annotations

import argparse
import importlib
import logging

from subscriber_analytics.operators.scoring import load_coefficients, load_scorer
from subscriber_analytics.schemas import DEFAULT_TOPICS
from subscriber_analytics.session import build_session
from subscriber_analytics.sources.events import (
    kafka_options, read_event_files, read_event_stream,
)
from subscriber_analytics.streaming.job import JobConfig, start_job

log = logging.getLogger("subscriber_analytics")


def parse_arguments(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--files", help="folder of envelope files instead of Kafka")
    parser.add_argument("--topics", default=",".join(DEFAULT_TOPICS))
    parser.add_argument("--max-offsets", help="messages per micro-batch, at most")
    parser.add_argument("--root", required=True, help="folder of both logs")
    parser.add_argument("--checkpoint", required=True)
    model = parser.add_mutually_exclusive_group(required=True)
    model.add_argument("--model", help="fitted spark.ml pipeline")
    model.add_argument("--coefficients", help="Parquet table of a logistic regression")
    parser.add_argument("--model-copy", required=True, help="copy used if the model is unreachable")
    parser.add_argument("--model-name", default="churn_model")
    parser.add_argument("--model-version", default="1")
    parser.add_argument("--threshold", type=float, default=0.5)
    parser.add_argument("--trigger-seconds", type=int, default=10)
    parser.add_argument("--spread", type=int, help="tasks to parse with, if the source has fewer")
    parser.add_argument("--tables", help="module:name of a database.BatchTables that gets the good rows too")
    parser.add_argument("--available-now", action="store_true", help="process what is there, stop")
    return parser.parse_args(arguments)


def named_object(name: str) -> object:
    """What ``module:name`` names."""
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def main(arguments: list[str] | None = None) -> None:
    given = parse_arguments(arguments)
    spark = build_session()
    if given.model:
        scorer = load_scorer(given.model, given.model_copy)
    else:
        scorer = load_coefficients(spark, given.coefficients, given.model_copy)
    if given.files:
        messages = read_event_files(spark, given.files)
    else:
        extra = {"maxOffsetsPerTrigger": given.max_offsets} if given.max_offsets else {}
        topics = given.topics.split(",")
        messages = read_event_stream(spark, kafka_options(given.servers, topics, **extra))
    config = JobConfig(
        root=given.root, checkpoint=given.checkpoint, threshold=given.threshold,
        model_name=given.model_name, model_version=given.model_version,
        trigger_seconds=given.trigger_seconds, spread=given.spread,
    )
    query = start_job(
        messages, scorer, config, given.available_now,
        on_metrics=lambda batch, counts: log.info("batch %s: %s", batch, counts),
        tables=named_object(given.tables) if given.tables else None,
    )
    query.awaitTermination()


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    main()
