"""From messages and raw profile texts to typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscriber_analytics.functions.columns import float_or_null, strip
from subscriber_analytics.operators.constraints import REASON, apply_defaults, enforce_constraints
from subscriber_analytics.schemas import (
    EVENT_COLUMNS, EVENT_JSON_SCHEMA, EVENT_LOG_RULES, PROFILE_COLUMNS, SOURCE_TO_WIRE,
)

_CORRUPT = "_corrupt"


def parse_events(messages: DataFrame, schema: str = EVENT_JSON_SCHEMA) -> DataFrame:
    """Decode the JSON value of each message into one column per schema field.

    The mode is permissive: text that is no JSON object gives NULLs, so does a field of the wrong
    type, and fields outside the schema are ignored. ``arrival`` keeps the position of the message
    in its source, and ``raw_value`` and ``reject_reason`` are set for messages without an object.
    Works on batch and streaming frames.
    """
    evt = F.from_json(
        "raw_value", f"{schema}, {_CORRUPT} string", {"columnNameOfCorruptRecord": _CORRUPT}
    )
    decoded = messages.select(
        F.struct("timestamp", "topic", "partition", "offset").alias("arrival"),
        F.col("value").cast("string").alias("raw_value"),
    ).select("arrival", "raw_value", evt.alias("evt"))
    names = [field.split(" ")[0] for field in schema.split(", ")]
    fields = ", ".join(f"CAST(evt.{name} AS STRING)" for name in names)
    reason = (
        "CASE WHEN raw_value IS NULL OR trim(raw_value) = '' THEN 'message: empty' "
        f"WHEN evt.{_CORRUPT} IS NOT NULL AND coalesce({fields}) IS NULL "
        "THEN 'message: malformed' END"
    )
    return decoded.selectExpr(
        *[f"evt.{name} AS {name}" for name in names], "arrival", "raw_value",
        f"{reason} AS {REASON}",
    )


def to_event_log(parsed: DataFrame) -> DataFrame:
    """Parsed messages as event log rows: stored types, defaults, and a reason on bad rows.

    NaN is stored as NULL. ``raw_value`` is kept on the bad rows only. On a stream ``ingested_ts`` is
    the start of the micro-batch, which the checkpoint keeps: a replayed batch gets the same.
    """
    rows = parsed.select(*EVENT_COLUMNS, "arrival", "raw_value", REASON)
    rows = enforce_constraints(apply_defaults(rows, EVENT_LOG_RULES), EVENT_LOG_RULES)
    raw = F.when(F.col(REASON).isNotNull(), F.col("raw_value"))
    return rows.select(
        *[rule.name for rule in EVENT_LOG_RULES], "arrival", REASON, raw.alias("raw_value")
    )


def rename_profiles(raw: DataFrame) -> DataFrame:
    """Source columns under their wire names, stripped; an absent or NULL value is ``''``."""
    given = set(raw.columns)
    return raw.select(*[
        strip(F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))).alias(wire)
        if name in given else F.lit("").alias(wire)
        for name, wire in SOURCE_TO_WIRE.items()
    ], *[name for name in raw.columns if name not in SOURCE_TO_WIRE])


def coerce_profiles(profiles: DataFrame) -> DataFrame:
    """Type the four number fields of wire-named text profiles.

    ``tenure`` is cut to a whole number, and 0 if blank or no number. ``senior_citizen`` is 0 if
    blank. ``monthly_charges`` is 0.0 if blank or no number. ``total_charges`` is 0.0 if blank and
    NULL if no number. What has no whole number (an infinite or huge tenure, a senior flag that is
    no number) is marked in ``reject_reason``.
    """
    def blank(name):
        return F.col(name) == ""

    texts = profiles.withColumns({
        f"_number_{name}": float_or_null(name)
        for name in ("tenure", "senior_citizen", "monthly_charges", "total_charges")
    })
    tenure = F.when(
        blank("tenure") | F.col("_number_tenure").isNull() | F.isnan("_number_tenure"), 0
    ).otherwise(F.col("_number_tenure").try_cast("int"))
    senior = F.when(blank("senior_citizen"), 0).otherwise(
        F.col("_number_senior_citizen").try_cast("int")
    )
    typed = {
        "tenure": tenure,
        "senior_citizen": senior,
        "monthly_charges": F.coalesce("_number_monthly_charges", F.lit(0.0)),
        "total_charges": F.when(blank("total_charges"), 0.0).otherwise(
            F.col("_number_total_charges")
        ),
    }
    reason = F.concat_ws(
        "; ",
        F.when(senior.isNull(), "senior_citizen: invalid"),
        F.when(tenure.isNull(), "tenure: invalid"),
    )
    others = [name for name in profiles.columns if name not in PROFILE_COLUMNS]
    return texts.select(
        *[typed[name].alias(name) if name in typed else name for name in PROFILE_COLUMNS],
        *others,
        F.nullif(reason, F.lit("")).alias(REASON),
    )
