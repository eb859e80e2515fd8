"""Scalar and aggregate Column expressions. All of them run inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Lower bounds of the two upper risk tiers and the three tier names.
HIGH_RISK, MEDIUM_RISK = 0.70, 0.50
TIERS = ("ELEVE", "MOYEN", "FAIBLE")

# What a Python float literal may look like, blanks aside; underscores may separate digits.
_FLOAT_TEXT = (
    r"^[+-]?((\d+(_\d+)*)(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"
)
# Every white space character of Unicode, with the four separators of ASCII.
_BLANKS = "".join(chr(code) for code in (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
))
_FLOAT_WORD = r"(?i)^[+-]?(inf|infinity|nan)$"


def column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_timestamp(as_of: Column | datetime | str | None) -> Column:
    """The reading time of a report: given, so that results can be repeated, or now."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def strip(c: ColumnLike) -> Column:
    """Remove white space of any kind at both ends."""
    return F.btrim(column(c), F.lit(_BLANKS))


def float_or_null(c: ColumnLike) -> Column:
    """Text as a double; NULL if it is not a number. 'nan' and 'inf' are numbers."""
    text = strip(c)
    word = F.lower(F.regexp_replace(text, r"^[+-]", ""))
    value = (
        F.when(text.rlike(_FLOAT_TEXT), F.regexp_replace(text, "_", "").try_cast("double"))
        .when(text.rlike(_FLOAT_WORD) & (word == "nan"), F.lit(float("nan")))
        .when(text.rlike(_FLOAT_WORD) & text.startswith("-"), F.lit(float("-inf")))
        .when(text.rlike(_FLOAT_WORD), F.lit(float("inf")))
    )
    return value


def nan_to_null(c: ColumnLike) -> Column:
    return F.when(~F.isnan(column(c)), column(c))


def is_yes(c: ColumnLike) -> Column:
    return column(c) == "Yes"


def count_yes(columns: Iterable[str]) -> Column:
    """How many of the columns say 'Yes'; NULL and any other text count as 0."""
    total = F.lit(0)
    for name in columns:
        total = total + F.when(is_yes(name), 1).otherwise(0)
    return total


def risk_tier(score: ColumnLike, high: float = HIGH_RISK, medium: float = MEDIUM_RISK) -> Column:
    return (
        F.when(column(score) >= high, TIERS[0])
        .when(column(score) >= medium, TIERS[1])
        .otherwise(TIERS[2])
    )


def decision(score: ColumnLike, threshold: float) -> Column:
    """1 where the score reaches the threshold, else 0. Use the unrounded score."""
    return (column(score) >= F.lit(threshold)).cast("smallint")


def lifetime_days(churn_date: ColumnLike, signup_date: ColumnLike, as_of: Column) -> Column:
    """Days from signup to the end of the subscription, or to ``as_of`` while it lasts."""
    end = F.coalesce(column(churn_date), as_of.cast("date"))
    return F.datediff(end, column(signup_date))


def exact_mean(c: ColumnLike, digits: int, where: Column | None = None) -> Column:
    """Mean of the non-NULL values, divided as decimals and rounded half away from zero once.

    ``avg`` on decimals already cuts to four more digits than the input, and rounding that
    again can differ in the last digit.
    """
    value = column(c) if where is None else F.when(where, column(c))
    mean = F.try_divide(F.sum(value).cast("decimal(30,6)"), F.count(value))
    return F.round(mean, digits).cast(f"decimal(20,{digits})")


def churn_rate(label: ColumnLike = "churn") -> Column:
    """Share of 'Yes' among the rows whose label is known."""
    return exact_mean(is_yes(label).cast("int"), 4)


def exact_median(c: ColumnLike, digits: int) -> Column:
    """Interpolated median. Its state is one counter per distinct value: use it on day or month
    counts, not on free amounts."""
    return F.round(F.percentile(column(c), 0.5), digits).cast(f"decimal(20,{digits})")
