"""Data model: one table of fields from which every schema, rename map and rule is derived."""

from __future__ import annotations

from dataclasses import dataclass

# Wire name, training name and stored type of the 21 profile columns.
PROFILE_FIELDS = (
    ("customer_id", "customerID", "varchar(32)"),
    ("gender", "gender", "varchar(10)"),
    ("senior_citizen", "SeniorCitizen", "smallint"),
    ("partner", "Partner", "varchar(3)"),
    ("dependents", "Dependents", "varchar(3)"),
    ("tenure", "tenure", "int"),
    ("phone_service", "PhoneService", "varchar(3)"),
    ("multiple_lines", "MultipleLines", "varchar(20)"),
    ("internet_service", "InternetService", "varchar(20)"),
    ("online_security", "OnlineSecurity", "varchar(20)"),
    ("online_backup", "OnlineBackup", "varchar(20)"),
    ("device_protection", "DeviceProtection", "varchar(20)"),
    ("tech_support", "TechSupport", "varchar(20)"),
    ("streaming_tv", "StreamingTV", "varchar(20)"),
    ("streaming_movies", "StreamingMovies", "varchar(20)"),
    ("contract", "Contract", "varchar(20)"),
    ("paperless_billing", "PaperlessBilling", "varchar(3)"),
    ("payment_method", "PaymentMethod", "varchar(40)"),
    ("monthly_charges", "MonthlyCharges", "decimal(8,2)"),
    ("total_charges", "TotalCharges", "decimal(10,2)"),
    ("churn", "Churn", "varchar(3)"),
)

# The five columns an event adds to a profile.
EVENT_META_FIELDS = (
    ("signup_date", "date"),
    ("churn_date", "date"),
    ("event_type", "varchar(20)"),
    ("event_ts", "timestamp"),
    ("source", "varchar(20)"),
)

# Topic of each event type.
TOPIC_OF_EVENT_TYPE = {
    "abonnement": "abonnements",
    "usage": "usages",
    "paiement": "paiements",
    "resiliation": "abonnements",
}
DEFAULT_TOPICS = ("abonnements", "usages", "paiements")

# Defaults of a profile sent for scoring; None marks a required field.
PROFILE_DEFAULTS = {
    "gender": "Male",
    "SeniorCitizen": 0,
    "Partner": "No",
    "Dependents": "No",
    "tenure": None,
    "PhoneService": "Yes",
    "MultipleLines": "No",
    "InternetService": "Fiber optic",
    "OnlineSecurity": "No",
    "OnlineBackup": "No",
    "DeviceProtection": "No",
    "TechSupport": "No",
    "StreamingTV": "No",
    "StreamingMovies": "No",
    "Contract": "Month-to-month",
    "PaperlessBilling": "Yes",
    "PaymentMethod": "Electronic check",
    "MonthlyCharges": None,
    "TotalCharges": None,
}
PROFILE_NUMBERS = {
    "SeniorCitizen": "int", "tenure": "int", "MonthlyCharges": "double", "TotalCharges": "double",
}
# Inclusive ranges of the required fields; None is open.
PROFILE_RANGES = {"tenure": (0, 100), "MonthlyCharges": (0, None), "TotalCharges": (0, None)}

SERVICE_COLUMNS = (
    "online_security", "online_backup", "device_protection",
    "tech_support", "streaming_tv", "streaming_movies",
)

WIRE_TO_TRAINING = {wire: training for wire, training, _ in PROFILE_FIELDS}
SOURCE_TO_WIRE = {training: wire for wire, training, _ in PROFILE_FIELDS}
SERVICE_TRAINING_COLUMNS = tuple(WIRE_TO_TRAINING[c] for c in SERVICE_COLUMNS)

PROFILE_COLUMNS = tuple(wire for wire, _, _ in PROFILE_FIELDS)
EVENT_COLUMNS = PROFILE_COLUMNS + tuple(name for name, _ in EVENT_META_FIELDS)

# Columns of an event that are not model inputs (training names where one exists).
NON_FEATURE_COLUMNS = ("Churn", "customerID") + tuple(name for name, _ in EVENT_META_FIELDS)



@dataclass(frozen=True)
class ColumnRule:
    """Stored type of one log column, whether NULL is allowed, its default and its range."""

    name: str
    sql_type: str
    nullable: bool = True
    default: object = None  # a value, or NOW for the current timestamp
    bounds: tuple | None = None

    @property
    def max_length(self) -> int | None:
        return int(self.sql_type[8:-1]) if self.sql_type.startswith("varchar(") else None

    @property
    def spark_type(self) -> str:
        return self.sql_type if self.max_length is None else "string"


NOW = "now"

_EVENT_REQUIRED = {"customer_id", "event_type", "event_ts", "source", "ingested_ts"}
_EVENT_DEFAULTS = {"event_type": "abonnement", "source": "kafka_simulator", "ingested_ts": NOW}

EVENT_LOG_RULES = tuple(
    ColumnRule(name, sql_type, name not in _EVENT_REQUIRED, _EVENT_DEFAULTS.get(name))
    for name, sql_type in (
        *((wire, sql_type) for wire, _, sql_type in PROFILE_FIELDS),
        *EVENT_META_FIELDS,
        ("ingested_ts", "timestamp"),
    )
)

SCORE_LOG_RULES = (
    ColumnRule("customer_id", "varchar(32)", nullable=False),
    ColumnRule("churn_score", "decimal(5,4)", nullable=False, bounds=(0, 1)),
    ColumnRule("churn_predicted", "smallint", nullable=False),
    ColumnRule("seuil_applique", "decimal(4,3)", nullable=False, default=0.50),
    ColumnRule("model_name", "varchar(64)", nullable=False, default="churn_model"),
    ColumnRule("model_version", "varchar(16)", nullable=False, default="1"),
    ColumnRule("event_ts", "timestamp", nullable=False),
    ColumnRule("predicted_ts", "timestamp", nullable=False, default=NOW),
)


def _wire_type(sql_type: str) -> str:
    if sql_type in ("smallint", "int"):
        return "int"
    return "double" if sql_type.startswith("decimal") else "string"


def _ddl(fields) -> str:
    return ", ".join(f"{name} {spark_type}" for name, spark_type in fields)


# A raw profile: source names, every value a text.
PROFILE_SCHEMA = _ddl((training, "string") for _, training, _ in PROFILE_FIELDS)

# One JSON message: numbers are int or double, dates and timestamps are ISO text.
EVENT_JSON_SCHEMA = _ddl(
    [(wire, _wire_type(t)) for wire, _, t in PROFILE_FIELDS]
    + [(name, "string") for name, _ in EVENT_META_FIELDS]
)

# A message as the broker delivers it. A Kafka source has the same columns with binary key and value.
ENVELOPE_SCHEMA = (
    "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"
)

# Position of a message in its source: stable over replays, so it breaks ties between log rows.
ARRIVAL_TYPE = "struct<timestamp:timestamp,topic:string,partition:int,offset:bigint>"

EVENT_LOG_SCHEMA = _ddl(
    [(r.name, r.spark_type) for r in EVENT_LOG_RULES]
    + [("arrival", ARRIVAL_TYPE), ("reject_reason", "string"), ("raw_value", "string")]
)
SCORE_LOG_SCHEMA = _ddl(
    [(r.name, r.spark_type) for r in SCORE_LOG_RULES]
    + [("arrival", ARRIVAL_TYPE), ("reject_reason", "string")]
)
