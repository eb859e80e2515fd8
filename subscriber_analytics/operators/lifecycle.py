"""Lifecycle dates and events of profiles, and their routing to topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscriber_analytics.functions.columns import ColumnLike, as_of_timestamp, column
from subscriber_analytics.operators.constraints import REASON
from subscriber_analytics.operators.parsing import coerce_profiles, rename_profiles
from subscriber_analytics.schemas import EVENT_COLUMNS, TOPIC_OF_EVENT_TYPE

DAYS_PER_MONTH = 30
JITTER_DAYS = 10
SHORTEST_LIFE_DAYS = 5


def default_jitter(key: ColumnLike = "customer_id") -> Column:
    """Whole days from -10 to 10, always the same for a customer."""
    return (F.pmod(F.xxhash64(column(key)), F.lit(2 * JITTER_DAYS + 1)) - JITTER_DAYS).cast("int")


def default_draw(key: ColumnLike = "customer_id") -> Column:
    """A whole number that places the termination in its window, always the same for a customer."""
    return F.xxhash64(column(key), F.lit("churn_date"))


def _or_given(df: DataFrame, name: str, derived: Column) -> Column:
    """The date that the profile carries, where it carries one that can be read."""
    return F.coalesce(F.col(name).try_cast("date"), derived) if name in df.columns else derived


def derive_signup_date(df: DataFrame, as_of=None, jitter: Column | None = None) -> DataFrame:
    """Add ``signup_date``: the profile's own, else ``tenure`` months of 30 days and the jitter before ``as_of``."""
    jitter = default_jitter() if jitter is None else jitter
    days = (F.col("tenure").cast("bigint") * DAYS_PER_MONTH + jitter).try_cast("int")
    derived = F.date_sub(as_of_timestamp(as_of).cast("date"), days)
    return df.withColumn("signup_date", _or_given(df, "signup_date", derived))


def derive_churn_date(df: DataFrame, as_of=None, draw: Column | None = None) -> DataFrame:
    """Add ``churn_date`` for churners: the profile's own, else a day in the last 40 % of the tenure, both
    ends included, but at the latest the day before ``as_of``. NULL for all others."""
    draw = default_draw() if draw is None else draw
    life = F.greatest(F.col("tenure").cast("bigint") * DAYS_PER_MONTH, F.lit(SHORTEST_LIFE_DAYS))
    first = F.floor(life * 6 / F.lit(10))
    day = (first + F.pmod(draw, life - first + 1)).try_cast("int")
    latest = F.date_sub(as_of_timestamp(as_of).cast("date"), 1)
    date = F.least(F.date_add("signup_date", day), latest)
    return df.withColumn("churn_date", F.when(F.col("churn") == "Yes", _or_given(df, "churn_date", date)))


def make_events(
    df: DataFrame, event_type: ColumnLike, event_ts: Column, source: str = "kafka_simulator"
) -> DataFrame:
    """Records as events: add type, creation time and source. ``event_type`` is a Column; wrap a
    fixed type in ``lit``."""
    return df.withColumns({
        "event_type": column(event_type), "event_ts": event_ts, "source": F.lit(source),
    })


def expand_lifecycle(profiles: DataFrame, as_of=None, source: str = "kafka_simulator") -> DataFrame:
    """One subscription event per profile, in the active state, and for churners a termination
    event with the final state right after it. One pass, no shuffle.

    A profile with a ``reject_reason`` has no event: it stays as it is, in one row without type and time."""
    rejected = F.col(REASON).isNotNull() if REASON in profiles.columns else F.lit(False)
    churned = F.col("churn") == "Yes"
    types = (
        F.when(rejected, F.array(F.lit(None).cast("string")))
        .when(churned, F.array(F.lit("abonnement"), F.lit("resiliation"))).otherwise(F.array(F.lit("abonnement")))
    )
    rows = profiles.select("*", F.posexplode(types).alias("_step", "_type"))
    opening = F.col("_type") == "abonnement"
    # The termination is created one microsecond later.
    created = F.timestamp_micros(
        F.unix_micros(as_of_timestamp(as_of)) + F.col("_step").cast("bigint")
    )
    rows = rows.withColumns({
        "churn": F.when(opening, "No").otherwise(F.col("churn")),
        "churn_date": F.when(~opening, F.col("churn_date")),
    })
    created = F.when(F.col("_type").isNotNull(), created)
    return make_events(rows, "_type", created, source).drop("_step", "_type")


def replay_profiles(raw: DataFrame, as_of=None, source: str = "kafka_simulator",
                    jitter: Column | None = None, draw: Column | None = None) -> DataFrame:
    """Raw text profiles as lifecycle events: rename, type, derive both dates, expand.

    A profile without a usable number comes back in one row with its ``reject_reason``, without dates, type
    and time of an event; ``constraints.accepted`` leaves the events to send.
    """
    return expand_lifecycle(date_profiles(coerce_profiles(rename_profiles(raw)), as_of, jitter, draw), as_of, source)


def date_profiles(profiles: DataFrame, as_of=None, jitter: Column | None = None, draw: Column | None = None) -> DataFrame:
    """Typed profiles with both dates; those with a ``reject_reason`` have none."""
    dated = derive_churn_date(derive_signup_date(profiles, as_of, jitter), as_of, draw)
    good = F.col(REASON).isNull()
    return dated.withColumns({name: F.when(good, F.col(name)) for name in ("signup_date", "churn_date")})


def topic_of(event_type: ColumnLike = "event_type") -> Column:
    """Topic of an event type; NULL for an unknown type."""
    routes = [F.lit(text) for pair in TOPIC_OF_EVENT_TYPE.items() for text in pair]
    return F.try_element_at(F.create_map(*routes), column(event_type))


def to_messages(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Events as ``(topic, key, value)``: the value is a JSON object with every event field, NULLs
    included, timestamps to the microsecond with their offset. ``keep`` names columns to carry along."""
    payload = F.to_json(
        F.struct(*EVENT_COLUMNS),
        {
            "ignoreNullFields": "false",
            "dateFormat": "yyyy-MM-dd",
            "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx",
        },
    )
    return events.select(
        topic_of().alias("topic"), F.col("customer_id").alias("key"), payload.alias("value"), *keep
    )


def with_partition(messages: DataFrame, partitions: int = 3) -> DataFrame:
    """Add the topic partition of each message: all messages of a key share one."""
    return messages.withColumn(
        "partition", F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int")
    )


def to_envelope(messages: DataFrame, timestamp: Column, offset: Column,
                partitions: int = 3) -> DataFrame:
    """Messages in the form a broker delivers them, with the given arrival time and offset."""
    return with_partition(messages, partitions).select(
        "key", "value", "topic", "partition",
        offset.cast("bigint").alias("offset"), timestamp.cast("timestamp").alias("timestamp"),
    )


def retain(df: DataFrame, as_of=None, days: int = 7, ts: str = "timestamp",
           day_column: str | None = None) -> DataFrame:
    """Keep the rows of the last ``days`` days.

    ``day_column`` names a partition column that holds the date of ``ts``; older partitions are then
    not read.
    """
    oldest = as_of_timestamp(as_of) - F.expr(f"INTERVAL '{int(days)}' DAY")
    kept = df.filter(F.col(ts) >= oldest)
    return kept if day_column is None else kept.filter(F.col(day_column) >= oldest.cast("date"))
