"""Projections of the driver tables into the inputs of the operators.

The SELECT texts are plain SQL that Spark and DuckDB both run, so that an operator and its check
start from the same rows. NULLs, ties, bad values and repeats come from arithmetic on the keys. No
projection shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subscriber_analytics.operators.scoring import LogitScorer
from subscriber_analytics.schemas import EVENT_COLUMNS

AS_OF = "2001-08-02 00:00:00"

# Event log: one event per order, several per customer, with equal times.
ORDER_EVENTS = """
SELECT o_orderkey AS id, CAST(o_custkey AS STRING) AS customer_id,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  CAST(CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS SMALLINT) AS senior_citizen,
  CASE WHEN o_orderkey % 4 = 0 THEN 'Yes' ELSE 'No' END AS partner,
  CASE WHEN o_orderkey % 6 = 0 THEN 'Yes' ELSE 'No' END AS dependents,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST((o_orderkey * 7) % 80 AS INT) END AS tenure,
  'Yes' AS phone_service, 'No' AS multiple_lines,
  CASE WHEN o_orderkey % 10 = 0 THEN 'DSL' ELSE 'Fiber optic' END AS internet_service,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS online_security,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS online_backup,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN 'Yes' ELSE 'No' END AS device_protection,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 'Yes' ELSE 'No internet service' END AS tech_support,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'Yes' ELSE 'No' END AS streaming_tv,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'Yes' ELSE 'No' END AS streaming_movies,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Month-to-month' WHEN '2-HIGH' THEN 'Month-to-month'
    WHEN '3-MEDIUM' THEN 'One year' WHEN '4-NOT SPECIFIED' THEN 'Two year' END AS contract,
  'Yes' AS paperless_billing,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Electronic check' ELSE 'Mailed check' END AS payment_method,
  CAST(o_totalprice AS DECIMAL(8,2)) AS monthly_charges,
  CAST(o_totalprice AS DECIMAL(10,2)) AS total_charges,
  CASE o_orderstatus WHEN 'F' THEN 'Yes' WHEN 'O' THEN 'No'
    ELSE CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'No' END END AS churn,
  CASE WHEN o_custkey % 11 = 0 THEN NULL
    ELSE CAST(o_orderdate AS DATE) - CAST((o_orderkey * 13) % 1000 - 4 AS INT) END AS signup_date,
  CASE WHEN o_orderstatus = 'F' AND o_orderkey % 13 <> 0 THEN CAST(o_orderdate AS DATE) END AS churn_date,
  CASE o_orderstatus WHEN 'F' THEN 'resiliation' WHEN 'O' THEN 'usage' ELSE 'paiement' END AS event_type,
  o_orderdate AS event_ts, o_orderdate AS ingested_ts, 'orders_table' AS source
FROM orders
"""

# Score log: a score for each order, two model versions.
ORDER_SCORES = """
SELECT o_orderkey AS id, CAST(o_custkey AS STRING) AS customer_id,
  CAST(((o_orderkey * 7919) % 10001) / 10000.0 AS DECIMAL(5,4)) AS churn_score,
  CAST(CASE WHEN (o_orderkey * 7919) % 10001 >= 5000 THEN 1 ELSE 0 END AS SMALLINT) AS churn_predicted,
  CAST(0.5 AS DECIMAL(4,3)) AS seuil_applique, 'churn_model' AS model_name,
  CAST(1 + o_orderkey % 2 AS STRING) AS model_version,
  o_orderdate AS event_ts, o_orderdate + INTERVAL '10' SECOND AS predicted_ts
FROM orders
"""

# Both logs as of the last 60 days, for readers that prune by day: times of whole hours.
RECENT_DAYS = 60
_RECENT_TS = (
    f"CAST(DATE '2001-08-01' - CAST(o_orderkey % {RECENT_DAYS} AS INT) AS TIMESTAMP) "
    "+ INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT)"
)
RECENT_EVENTS = ORDER_EVENTS.replace("o_orderdate AS ingested_ts", f"{_RECENT_TS} AS ingested_ts")
RECENT_SCORES = ORDER_SCORES.replace(
    "o_orderdate + INTERVAL '10' SECOND AS predicted_ts", f"{_RECENT_TS} + INTERVAL '10' SECOND AS predicted_ts")

# Event rows that break storage rules: untyped, from orders.
ORDER_RAW_EVENTS = """
SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 50 = 1 THEN NULL ELSE CAST(o_custkey AS STRING) END AS customer_id,
  CASE WHEN o_orderkey % 60 = 2 THEN 'undisclosed' ELSE 'Male' END AS gender,
  CASE WHEN o_orderkey % 65 = 3 THEN 40000 ELSE 1 END AS senior_citizen,
  CASE WHEN o_orderkey % 66 = 4 THEN 'Yes   ' ELSE 'No' END AS partner,
  CAST(o_orderkey % 80 AS INT) AS tenure,
  CASE WHEN o_orderkey % 70 = 3 THEN 10000000.5e0 WHEN o_orderkey % 80 = 4 THEN CAST('NaN' AS DOUBLE)
    ELSE o_totalprice END AS monthly_charges,
  CASE WHEN o_orderkey % 90 = 5 THEN 'soon' WHEN o_orderkey % 91 = 6 THEN '2001'
    ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS signup_date,
  CASE WHEN o_orderkey % 45 = 6 THEN NULL ELSE o_orderdate END AS event_ts
FROM orders
"""

# Raw text profiles under their source names.
CUSTOMER_PROFILES = """
SELECT CAST(c_custkey AS STRING) AS customerID, ' Male ' AS gender,
  CASE c_custkey % 8 WHEN 0 THEN '' WHEN 1 THEN '1.0' WHEN 2 THEN 'x' ELSE '0' END AS SeniorCitizen,
  'No' AS Partner, 'No' AS Dependents,
  CASE c_custkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'abc' WHEN 2 THEN ' 12 ' WHEN 3 THEN '7.9'
    WHEN 4 THEN '101' ELSE CAST(c_custkey % 73 AS STRING) END AS tenure,
  'Yes' AS PhoneService, 'No' AS MultipleLines, 'DSL' AS InternetService,
  CASE WHEN c_custkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS OnlineSecurity,
  CASE WHEN c_custkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS OnlineBackup,
  CASE WHEN c_custkey % 5 = 0 THEN 'Yes' ELSE 'No' END AS DeviceProtection,
  CASE WHEN c_custkey % 7 = 0 THEN 'Yes' ELSE 'No' END AS TechSupport,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'No' END AS StreamingTV,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Two year' WHEN 'MACHINERY' THEN 'One year'
    ELSE 'Month-to-month' END AS Contract,
  'Yes' AS PaperlessBilling, 'Mailed check' AS PaymentMethod,
  CASE WHEN c_custkey % 10 = 9 THEN 'n/a' ELSE CAST(abs(c_acctbal) AS STRING) END AS MonthlyCharges,
  CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 7 = 1 THEN 'bad'
    ELSE CAST(c_acctbal AS STRING) END AS TotalCharges,
  CASE WHEN c_custkey % 4 = 0 THEN 'Yes' ELSE 'No' END AS Churn,
  c_custkey
FROM customer
"""

# The same with dates of their own, as text.
DATED_PROFILES = CUSTOMER_PROFILES.replace("  c_custkey\n", """  CAST(DATE '1999-01-01' + CAST(c_custkey % 500 AS INT) AS STRING) AS signup_date,
  CASE WHEN c_custkey % 4 = 0 THEN CAST(DATE '2000-06-01' + CAST(c_custkey % 300 AS INT) AS STRING) END AS churn_date,
  c_custkey
""")

# Profiles sent for scoring: no services, optional fields partly NULL, numbers as numbers.
CUSTOMER_REQUESTS = """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'Female' END AS gender,
  CASE WHEN c_custkey % 4 = 0 THEN CAST(1 AS INT) END AS SeniorCitizen,
  CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE CAST(c_custkey % 110 AS INT) END AS tenure,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Two year' WHEN 'MACHINERY' THEN 'One year' END AS Contract,
  CASE WHEN c_custkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS OnlineSecurity,
  CASE WHEN c_custkey % 31 = 0 THEN CAST('NaN' AS DOUBLE) ELSE abs(c_acctbal) END AS MonthlyCharges,
  c_acctbal AS TotalCharges
FROM customer
"""

# Profiles with repeated customers, in training names; order key o_orderkey.
ORDER_PROFILES = """
SELECT o_orderkey, CAST(o_custkey AS STRING) AS customerID,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST((o_orderkey * 7) % 80 AS INT) END AS tenure,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS OnlineSecurity,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS TechSupport,
  CASE WHEN o_orderkey % 5 = 0 THEN 'Yes' ELSE 'No internet service' END AS StreamingTV,
  CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 7 = 1 THEN 'bad'
    ELSE CAST(o_orderkey AS STRING) END AS TotalCharges
FROM orders
"""

# Event messages before they become JSON, from events; ``ts`` stands for the event time.
EVENT_FIELDS = """
SELECT event_id, ts,
  CASE WHEN event_id % 101 = 7 THEN NULL
    ELSE CAST(user_id AS STRING) || '-' || CAST(event_id % 10 AS STRING) END AS customer_id,
  CASE WHEN event_id % 3 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  CAST(CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS INT) AS senior_citizen,
  'No' AS partner, 'No' AS dependents,
  CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST((event_id * 7) % 80 AS INT) END AS tenure,
  'Yes' AS phone_service, 'No' AS multiple_lines, 'DSL' AS internet_service,
  CASE WHEN event_id % 2 = 0 THEN 'Yes' ELSE 'No' END AS online_security,
  CASE WHEN event_id % 3 = 0 THEN 'Yes' ELSE 'No' END AS online_backup,
  CASE WHEN event_id % 5 = 0 THEN 'Yes' END AS device_protection,
  CASE WHEN event_id % 7 = 0 THEN 'Yes' ELSE 'No' END AS tech_support,
  CASE WHEN event_id % 11 = 0 THEN 'Yes' ELSE 'No' END AS streaming_tv,
  CASE WHEN event_id % 13 = 0 THEN 'Yes' ELSE 'No' END AS streaming_movies,
  CASE WHEN event_id % 211 = 5 THEN 'Contract of another kind' WHEN event_id % 4 = 0 THEN 'Two year'
    WHEN event_id % 4 = 1 THEN 'One year' ELSE 'Month-to-month' END AS contract,
  'Yes' AS paperless_billing, 'Télépaiement' AS payment_method,
  value AS monthly_charges, value * 4 AS total_charges,
  CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_type = 'error' THEN 'Yes' ELSE 'No' END AS churn,
  CASE WHEN event_id % 307 = 11 THEN 'soon'
    ELSE CAST(CAST(ts AS DATE) - CAST(event_id % 700 AS INT) AS STRING) END AS signup_date,
  CASE WHEN event_type = 'error' THEN CAST(CAST(ts AS DATE) AS STRING) END AS churn_date,
  CASE event_type WHEN 'signup' THEN 'abonnement' WHEN 'purchase' THEN 'paiement'
    WHEN 'error' THEN 'resiliation' ELSE 'usage' END AS event_type,
  event_id % 113 = 3 AS no_time, 'events_table' AS source,
  CASE WHEN event_id % 97 = 0 THEN 'not json' WHEN event_id % 131 = 4 THEN '' END AS broken,
  event_id % 31 = 0 AS text_tenure
FROM events
"""

# Coefficients of the checks: the published model is not part of the public material.
SCORER = LogitScorer(
    intercept=-1.0,
    numeric={
        "MonthlyCharges": 0.01, "tenure": -0.02, "NewClient": 0.3, "NbServices": -0.1,
        "SeniorCitizen": 0.2,
    },
    categorical={"Contract": {"Month-to-month": 0.6, "Two year": -0.8}},
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _project(df: DataFrame, name: str, sql: str) -> DataFrame:
    return df.sparkSession.sql(sql.replace(f"FROM {name}", "FROM {source}"), source=df)


def events_of(orders: DataFrame) -> DataFrame:
    return _project(orders, "orders", ORDER_EVENTS)


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_of(table(spark, sf_dir, "orders"))


def order_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "orders"), "orders", ORDER_SCORES)


def recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "orders"), "orders", RECENT_EVENTS)


def recent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "orders"), "orders", RECENT_SCORES)


def order_raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "orders"), "orders", ORDER_RAW_EVENTS)


def order_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "orders"), "orders", ORDER_PROFILES)


def customer_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "customer"), "customer", CUSTOMER_PROFILES)


def dated_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "customer"), "customer", DATED_PROFILES)


def customer_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "customer"), "customer", CUSTOMER_REQUESTS)


def messages(events: DataFrame) -> DataFrame:
    """The events table, batch or stream, as envelopes with JSON values."""
    fields = _project(events, "events", EVENT_FIELDS)
    event_ts = F.when(
        ~F.col("no_time"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")),
    )
    payload = F.to_json(
        F.struct(*[event_ts.alias(c) if c == "event_ts" else c for c in EVENT_COLUMNS]),
        {"ignoreNullFields": "false"},
    )
    wrong = F.regexp_replace(payload, '"tenure":[^,]*', '"tenure":"unknown"')
    payload = F.when(F.col("text_tenure"), wrong).otherwise(payload)
    return fields.select(
        F.col("customer_id").alias("key"), F.coalesce("broken", payload).alias("value"),
        F.col("event_type").alias("topic"), (F.col("event_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"),
    )


def message_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """The events table as a stream, without a copy of it. The pattern matches one name, be it a
    file or a folder of part files."""
    reader = spark.readStream.schema(table(spark, sf_dir, "events").schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return messages(reader.parquet(f"{sf_dir}/events.parque[t]"))
