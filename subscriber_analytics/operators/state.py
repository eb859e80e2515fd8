"""Latest row per key, and what is built directly on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subscriber_analytics.functions.columns import as_of_timestamp, lifetime_days, risk_tier

MAX_FEED_ROWS = 50


def _one_per_key(df: DataFrame, keys: Sequence[str], order) -> DataFrame:
    # Spark turns row_number() = 1 into a group limit that runs before the shuffle as well, so each
    # map task sends one row per key however often the key occurs.
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def arrival_order(df: DataFrame, ts: str) -> list[str]:
    """The source position where the frame has it, as files of a source may be read in any batches;
    else ``ts``, then the row id if there is one."""
    if "arrival" in df.columns:
        return ["arrival", ts]
    return [ts] + [name for name in ("id",) if name in df.columns]


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` values of each key."""
    return _one_per_key(df, keys, [F.desc_nulls_last(name) for name in order])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` values of each key."""
    return _one_per_key(df, keys, [F.asc_nulls_last(name) for name in order])


def latest_state(events: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """The last event of each customer, by source position or ingestion time unless ``order`` says otherwise."""
    return latest_by(events, ["customer_id"], order or arrival_order(events, "ingested_ts"))


def latest_score(scores: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """The last score of each customer, by source position or prediction time, with its risk tier."""
    last = latest_by(scores, ["customer_id"], order or arrival_order(scores, "predicted_ts"))
    return last.select(
        "customer_id", "churn_score", "churn_predicted", "seuil_applique", "model_version",
        "predicted_ts", risk_tier("churn_score").alias("niveau_risque"),
    )


def merge_state(snapshot: DataFrame, newer: DataFrame, order: Sequence[str] | None = None
                ) -> DataFrame:
    """Latest state from an older latest state and the events since then.

    Equal to ``latest_state`` over the whole log, but reads one row per customer and the new events.
    """
    return latest_state(snapshot.unionByName(newer, allowMissingColumns=True), order)


def score_lookup(scores: DataFrame, customer_id: str) -> DataFrame:
    """Last score of one customer; no row if there is none. The key filter reaches the scan."""
    one = scores.filter(F.col("customer_id") == F.lit(customer_id))
    return latest_score(one).select(
        "customer_id", "churn_score", "churn_predicted", "model_version", "predicted_ts"
    )


def join_360(state: DataFrame, last_score: DataFrame, as_of=None) -> DataFrame:
    """Latest state of every customer with the latest score, NULL where there is none.

    Both inputs are partitioned by customer already, so the join adds no exchange.
    """
    profile = state.select(
        "customer_id", "gender", "senior_citizen", "partner", "dependents", "tenure", "contract",
        "payment_method", "internet_service", "online_security", "tech_support",
        "monthly_charges", "total_charges", F.col("churn").alias("churn_observe"),
        "signup_date", "churn_date",
        lifetime_days("churn_date", "signup_date", as_of_timestamp(as_of)).alias(
            "duree_reelle_jours"
        ),
    )
    score = last_score.select(
        "customer_id", "churn_score", "churn_predicted", "niveau_risque", "model_version",
        "predicted_ts",
    )
    return profile.join(score, "customer_id", "left")


def customer_360(events: DataFrame, scores: DataFrame, as_of=None) -> DataFrame:
    return join_360(latest_state(events), latest_score(scores), as_of)


def checked_limit(n: int, cap: int) -> int:
    """Row limit of a request; one that is negative or above the cap is an error, not a shorter answer."""
    if not 0 <= n <= cap:
        raise ValueError(f"limit must be between 0 and {cap}: {n}")
    return n


def within_days(events: DataFrame, days: int, as_of=None, day_column: str = "ingest_date") -> DataFrame:
    """The events of the last ``days`` days before ``as_of`` and later ones.

    ``day_column`` holds the date of ``ingested_ts``. Where it is a partition column, as in our log, the
    files of older days are not opened.
    """
    return events.filter(F.col(day_column) >= F.date_sub(as_of_timestamp(as_of).cast("date"), days))


def live_feed(events: DataFrame, scores: DataFrame, n: int = 20, cap: int = MAX_FEED_ROWS) -> DataFrame:
    """The newest ``n`` events, newest first, each with its customer's last score.

    A scalar subquery cuts the events to at most ``cap`` rows in one scan and holds them as an array. Spark runs it
    once for both of its uses: as the rows of the feed, and to filter the score log, so neither log is shuffled and
    only the customers of the feed are ranked. Nothing runs before the result is asked for. For a feed
    of recent days pass ``within_days(events, days)``.
    """
    order = arrival_order(events, "ingested_ts")
    rows = events.select(
        F.struct("customer_id", "event_type", "event_ts").alias("event"), F.struct(*order).alias("place"))
    newest = rows.orderBy(F.desc("place")).limit(checked_limit(n, cap))
    feed = newest.agg(F.sort_array(F.collect_list(F.struct("place", "event")), asc=False).alias("feed")).scalar()
    customers = feed.getField("event").getField("customer_id")
    shown = latest_score(scores.filter(F.array_contains(customers, F.col("customer_id"))))
    listed = events.sparkSession.range(1).select(F.posexplode(feed).alias("_place", "row")).select("_place", "row.event.*")
    return (
        listed.join(shown.select("customer_id", "churn_score"), "customer_id", "left")
        .orderBy("_place")
        .select("customer_id", "event_type", "event_ts", "churn_score")
    )
