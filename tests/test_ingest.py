from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from subscriber_analytics import schemas
from subscriber_analytics.operators import constraints as con
from subscriber_analytics.operators.parsing import (
    coerce_profiles, parse_events, rename_profiles, to_event_log,
)
from subscriber_analytics.sources.events import kafka_options
from subscriber_analytics.sources.profiles import first_profiles, read_profiles
from tests.helpers import at, envelopes, event, values


def test_schemas(spark):
    message = StructType.fromDDL(schemas.EVENT_JSON_SCHEMA)
    assert len(message) == 26
    assert message["tenure"].dataType.simpleString() == "int"
    assert message["monthly_charges"].dataType.simpleString() == "double"
    assert message["signup_date"].dataType.simpleString() == "string"
    log = StructType.fromDDL(schemas.EVENT_LOG_SCHEMA)
    assert log["monthly_charges"].dataType.simpleString() == "decimal(8,2)"
    assert log["senior_citizen"].dataType.simpleString() == "smallint"
    score = StructType.fromDDL(schemas.SCORE_LOG_SCHEMA)
    assert score["churn_score"].dataType.simpleString() == "decimal(5,4)"
    assert len(schemas.WIRE_TO_TRAINING) == len(schemas.SOURCE_TO_WIRE) == 21


def test_parse_edge_messages(spark):
    messages = [
        (event(), "usages", 0), ("not json", "usages", 1), ('[{"customer_id":"z"}]', "usages", 2),
        ("", "usages", 3), (None, "usages", 4), (event(monthly_charges=float("nan")), "usages", 5),
        (event(tenure="five"), "usages", 6), (event(extra=1), "usages", 7),
        (event(customer_id=None), "usages", 8), ('{"tenure": 3}', "usages", 9),
    ]
    rows = to_event_log(parse_events(envelopes(spark, messages))).orderBy("arrival")
    got = values(rows, "arrival.offset", "customer_id", "tenure", "monthly_charges",
                 "reject_reason", F.col("raw_value").isNull())
    price = Decimal("20.50")
    assert got == [
        (0, "c1", 5, price, None, True),
        (1, None, None, None, "message: malformed", False),
        (2, None, None, None, "message: malformed", False),
        (3, None, None, None, "message: empty", False),
        (4, None, None, None, "message: empty", True),  # the raw message is NULL itself
        (5, "c1", 5, None, None, True),
        (6, "c1", None, price, None, True),
        (7, "c1", 5, price, None, True),
        (8, None, 5, price, "customer_id: missing", False),
        (9, None, 3, None, "customer_id: missing; event_type: missing; event_ts: missing; "
         "source: missing", False),
    ]
    first = values(rows.limit(1), "event_ts", "signup_date", "churn_date")[0]
    assert first == (at("2024-03-01 08:00:00.123456"), at("2024-01-01").date(), None)


def test_parse_keeps_text_and_binary_values(spark):
    binary = envelopes(spark, [(event(payment_method="Télépaiement"), "usages", 0)]).withColumn(
        "value", F.col("value").cast("binary"))
    assert values(parse_events(binary), "payment_method") == [("Télépaiement",)]


@pytest.mark.parametrize("field, value, reason", [
    ("gender", "undisclosed", "gender: too long"),
    ("partner", "Yes   ", None),
    ("customer_id", "x" * 33, "customer_id: too long"),
    ("customer_id", "é" * 32, None),
    ("senior_citizen", 40000, "senior_citizen: invalid"),
    ("monthly_charges", 999999.99, None),
    ("monthly_charges", 999999.995, "monthly_charges: invalid"),
    ("monthly_charges", "Infinity", "monthly_charges: invalid"),
    ("signup_date", "2024", "signup_date: invalid"),
    ("signup_date", "2024-02-30", "signup_date: invalid"),
    ("event_ts", "10:30", "event_ts: invalid"),
    ("event_ts", None, "event_ts: missing"),
    ("source", None, "source: missing"),
])
def test_event_constraints(spark, field, value, reason):
    rows = to_event_log(parse_events(envelopes(spark, [(event(**{field: value}), "usages", 0)])))
    assert values(rows, "reject_reason") == [(reason,)]


def test_decimals_round_half_away_from_zero(spark):
    rules = [schemas.ColumnRule("x", "decimal(8,2)")]
    df = spark.createDataFrame([(1.005,), (-1.005,), (2.675,), (0.125,)], "x double")
    got = [str(r[0]) for r in values(con.enforce_constraints(df, rules), "x")]
    assert got == ["1.01", "-1.01", "2.68", "0.13"]


def test_defaults_fill_absent_columns_only(spark):
    df = spark.createDataFrame([("c", None)], "customer_id string, source string")
    rows = con.apply_defaults(df, schemas.EVENT_LOG_RULES)
    assert values(rows, "event_type", "source") == [("abonnement", None)]
    assert "ingested_ts" in rows.columns and "event_ts" not in rows.columns
    rules = [r for r in schemas.EVENT_LOG_RULES if r.name in ("source", "event_type")]
    assert values(con.enforce_constraints(rows, rules), "reject_reason") == [("source: missing",)]


def test_score_range(spark):
    rules = [r for r in schemas.SCORE_LOG_RULES if r.name == "churn_score"]
    df = spark.createDataFrame(
        [(0.0,), (1.00004,), (1.0001,), (-0.1,), (float("nan"),), (None,), (12.0,)],
        "churn_score double")
    got = [r[0] for r in values(con.enforce_constraints(df, rules), "reject_reason")]
    out, missing = "churn_score: out of range", "churn_score: missing"
    assert got == [None, None, out, out, missing, missing, "churn_score: invalid"]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"), "nan"), (1.0, "x")], "x double, t string")
    assert values(con.nan_columns_to_null(df), "x", "t") == [(None, "nan"), (1.0, "x")]


def test_profile_files_are_read_by_their_own_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("customerID,tenure\na,1\n")
    (tmp_path / "b.csv").write_text("tenure,customerID,Churn\n2,b,Yes\n")
    (tmp_path / "c.csv").write_text("customerID,tenure\nc,3\n")
    raw = read_profiles(spark, str(tmp_path))
    assert sorted(values(raw, "customerID", "tenure", "Churn")) == [("a", "1", None), ("b", "2", "Yes"), ("c", "3", None)]


def test_profiles_from_csv(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        'tenure,customerID,Extra,PaymentMethod,MonthlyCharges,TotalCharges,Churn,SeniorCitizen\n'
        ' 12 , a,9,"Say ""cash"", please",29.85,,Yes,0\n'
        "7.9,b,9,Télépaiement,x,bad,No,1.0\n"
        ",c,9,Card,,5,No,\n"
        "inf,d,9,Card,1,5,No,yes\n"
        "nan,e,9,Card,1,5,No,0\n", encoding="utf-8")
    raw = read_profiles(spark, str(tmp_path / "p.csv"))
    assert {kind for _, kind in raw.dtypes} == {"string"}
    typed = coerce_profiles(rename_profiles(raw)).orderBy("customer_id")
    got = values(typed, "customer_id", "tenure", "senior_citizen", "monthly_charges",
                 "total_charges", "payment_method", "gender", "reject_reason")
    assert got == [
        ("a", 12, 0, 29.85, 0.0, 'Say "cash", please', "", None),
        ("b", 7, 1, 0.0, None, "Télépaiement", "", None),
        ("c", 0, 0, 0.0, 5.0, "Card", "", None),
        ("d", None, None, 1.0, 5.0, "Card", "", "senior_citizen: invalid; tenure: invalid"),
        ("e", 0, 0, 1.0, 5.0, "Card", "", None),
    ]


def test_first_profiles(spark):
    df = spark.range(10)
    assert first_profiles(df, 0).count() == first_profiles(df, None).count() == 10
    assert values(first_profiles(df, 2, ["id"]), "id") == [(0,), (1,)]


def test_validate_profiles(spark):
    df = spark.createDataFrame(
        [(0, 0.0, "1", None), (100, 1.0, "0", "Female"), (101, -0.1, "x", None),
         (None, None, "-1", None), (5, float("nan"), "1.5", "")],
        "tenure int, MonthlyCharges double, TotalCharges string, gender string")
    rows = con.validate_profiles(df)
    assert values(rows, "gender", "InternetService", "SeniorCitizen", "reject_reason") == [
        ("Male", "Fiber optic", 0, None),
        ("Female", "Fiber optic", 0, None),
        ("Male", "Fiber optic", 0, "tenure: out of range; MonthlyCharges: out of range; "
         "TotalCharges: invalid"),
        ("Male", "Fiber optic", 0, "tenure: missing; MonthlyCharges: missing; "
         "TotalCharges: out of range"),
        ("", "Fiber optic", 0, "MonthlyCharges: out of range"),
    ]
    assert con.accepted(rows).count() == 2 and con.rejected(rows).count() == 3


def test_validate_whole_numbers_and_absent_fields(spark):
    df = spark.createDataFrame([(7.5, 1.0), (7.0, 1.0)], "tenure double, MonthlyCharges double")
    reasons = [r[0] for r in values(con.validate_profiles(df), "reject_reason")]
    assert reasons == ["tenure: invalid; TotalCharges: missing", "TotalCharges: missing"]


def test_kafka_options():
    options = kafka_options("broker:9092", maxOffsetsPerTrigger="1000", startingOffsets="earliest")
    assert options == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "abonnements,usages,paiements",
        "startingOffsets": "earliest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "1000",
    }
    assert kafka_options("b")["startingOffsets"] == "latest"


def test_headers_of_a_thousand_files_take_few_jobs(spark, tmp_path):
    for k in range(1000):
        names, row = ["customerID", "tenure", "Churn"], [f"c{k}", str(k), "Yes"]
        if k % 2:
            names, row = names[::-1], row[::-1]
        lead = "\n" if k % 7 == 0 else ""
        (tmp_path / f"p {k}%.csv").write_text(lead + ",".join(names) + "\n" + ",".join(row) + "\n", encoding="utf-8")
    (tmp_path / "empty.csv").write_text("")
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        raw = read_profiles(spark, str(tmp_path))
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 20
    rows = values(raw, "customerID", "tenure", "Churn")
    assert sorted(rows) == sorted((f"c{k}", str(k), "Yes") for k in range(1000))
