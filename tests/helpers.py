from datetime import datetime

from pyspark.sql import functions as F

from subscriber_analytics.schemas import EVENT_COLUMNS


def values(df, *columns):
    return [tuple(row) for row in df.select(*columns).collect()]


def at(text):
    return datetime.fromisoformat(text)


PROFILE = {
    "customer_id": "c1", "gender": "Male", "senior_citizen": 0, "partner": "No",
    "dependents": "No", "tenure": 5, "phone_service": "Yes", "multiple_lines": "No",
    "internet_service": "DSL", "online_security": "Yes", "online_backup": "No",
    "device_protection": "No", "tech_support": "No", "streaming_tv": "No",
    "streaming_movies": "No", "contract": "One year", "paperless_billing": "Yes",
    "payment_method": "Mailed check", "monthly_charges": 20.5, "total_charges": 100.0,
    "churn": "No", "signup_date": "2024-01-01", "churn_date": None, "event_type": "usage",
    "event_ts": "2024-03-01T10:00:00.123456+02:00", "source": "test",
}


def event(**changes):
    import json

    fields = {**PROFILE, **changes}
    extra = [name for name in changes if name not in EVENT_COLUMNS]
    return json.dumps({n: fields[n] for n in (*EVENT_COLUMNS, *extra)}, ensure_ascii=False)


def envelopes(spark, messages):
    """Messages ``(value, topic, offset)`` as a batch of envelopes, one second apart."""
    rows = [(None, value, topic, 0, offset) for value, topic, offset in messages]
    df = spark.createDataFrame(
        rows, "key string, value string, topic string, partition int, offset bigint"
    )
    start = F.lit("2024-03-01 12:00:00").cast("timestamp")
    return df.withColumn(
        "timestamp", F.timestamp_seconds(F.unix_timestamp(start) + F.col("offset"))
    )
