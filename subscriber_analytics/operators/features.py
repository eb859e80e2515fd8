"""Model inputs: cleaning and the two derived features, the same for streams and single profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscriber_analytics.functions.columns import count_yes, float_or_null
from subscriber_analytics.operators.state import keep_first
from subscriber_analytics.schemas import (
    NON_FEATURE_COLUMNS, SERVICE_TRAINING_COLUMNS, WIRE_TO_TRAINING,
)

ID_COLUMN = "customerID"
NEW_CUSTOMER_MONTHS = 6


def to_training_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(WIRE_TO_TRAINING)


def read_leniently(df: DataFrame) -> DataFrame:
    """Strip column names, and read ``TotalCharges`` as a double with NULL for what is no number."""
    df = df.toDF(*[name.strip() for name in df.columns])
    kind = dict(df.dtypes).get("TotalCharges")
    if kind is None:
        return df
    number = float_or_null if kind == "string" else lambda name: F.col(name).cast("double")
    return df.withColumn("TotalCharges", number("TotalCharges"))


def clean_profiles(df: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """``read_leniently``, then the first row of each customer if the frame has customer ids.

    ``order`` names the columns that say which row came first; such a frame needs it.
    """
    df = read_leniently(df)
    if ID_COLUMN not in df.columns:
        return df
    if not order:
        raise ValueError("rows with a customer id need an order to keep the first of each")
    return keep_first(df, [ID_COLUMN], order)


def add_features(df: DataFrame) -> DataFrame:
    """Add ``NewClient`` and ``NbServices`` where their inputs are present."""
    added = {}
    if "tenure" in df.columns:
        is_new = (F.col("tenure") < NEW_CUSTOMER_MONTHS).cast("int")
        added["NewClient"] = F.coalesce(is_new, F.lit(0))
    services = [name for name in SERVICE_TRAINING_COLUMNS if name in df.columns]
    if services:
        added["NbServices"] = count_yes(services)
    return df.withColumns(added) if added else df


def preprocess(df: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    return add_features(clean_profiles(df, order))


def model_inputs(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop what the model was not trained on, except the columns in ``keep``, which identify the
    row and travel with its score."""
    return df.drop(*[name for name in NON_FEATURE_COLUMNS if name not in keep])
