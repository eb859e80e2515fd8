"""Defaults, stored types and checks of the two logs, and the profile check before scoring.

A row that breaks a rule is never dropped and never fails the job: it keeps its values and gets a
``reject_reason``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscriber_analytics.functions.columns import float_or_null, nan_to_null
from subscriber_analytics.schemas import (
    NOW, PROFILE_DEFAULTS, PROFILE_NUMBERS, PROFILE_RANGES, ColumnRule,
)

REASON = "reject_reason"

_FLOATS = ("double", "float")
# Shorter texts such as a year or a time of day would be completed by a cast, not refused.
_FULL_DAY = "^ *[0-9]{4,}-[0-9]{1,2}-[0-9]{1,2}"


def apply_defaults(df: DataFrame, rules: Iterable[ColumnRule]) -> DataFrame:
    """Add the columns that are absent and have a default. An explicit NULL stays NULL."""
    missing = [r for r in rules if r.default is not None and r.name not in df.columns]
    return df.withColumns({
        r.name: (F.current_timestamp() if r.default == NOW else F.lit(r.default)).cast(r.spark_type)
        for r in missing
    })


def nan_columns_to_null(df: DataFrame) -> DataFrame:
    """NULL instead of NaN in every float column."""
    return df.withColumns({
        name: nan_to_null(name) for name, kind in df.dtypes if kind in _FLOATS
    })


def _stored(rule: ColumnRule, kind: str) -> str:
    """SQL for the column in its stored type; NULL where the value does not fit."""
    value = _not_nan(rule, kind)
    length = rule.max_length
    if length is not None:
        text = f"CAST({value} AS STRING)"
        # Blanks beyond the length are cut, anything else beyond it is an error.
        return (
            f"CASE WHEN length({text}) <= {length} THEN {text} "
            f"WHEN length(rtrim({text})) <= {length} THEN substring({text}, 1, {length}) END"
        )
    if kind == "string" and rule.sql_type in ("date", "timestamp"):
        return f"CASE WHEN {value} RLIKE '{_FULL_DAY}' THEN try_cast({value} AS {rule.sql_type}) END"
    return f"try_cast({value} AS {rule.sql_type})"


def _not_nan(rule: ColumnRule, kind: str) -> str:
    name = f"`{rule.name}`"
    return f"CASE WHEN NOT isnan({name}) THEN {name} END" if kind in _FLOATS else name


def _problem(rule: ColumnRule, kind: str) -> str:
    """SQL for what is wrong with the column, NULL if nothing."""
    stored = f"`_stored_{rule.name}`"
    misfit = "too long" if rule.max_length is not None else "invalid"
    cases = [f"WHEN {stored} IS NULL AND {_not_nan(rule, kind)} IS NOT NULL "
             f"THEN '{rule.name}: {misfit}'"]
    if not rule.nullable:
        cases.append(f"WHEN {stored} IS NULL THEN '{rule.name}: missing'")
    if rule.bounds is not None:
        low, high = rule.bounds
        cases.append(
            f"WHEN NOT {stored} BETWEEN {low} AND {high} THEN '{rule.name}: out of range'"
        )
    return f"CASE {' '.join(cases)} END"


def enforce_constraints(df: DataFrame, rules: Iterable[ColumnRule]) -> DataFrame:
    """Cast to the stored types and list every broken rule of a row in ``reject_reason``.

    The reason reads ``<column>: missing``, ``<column>: too long``, ``<column>: invalid`` or
    ``<column>: out of range``; several are joined with ``; ``. It is NULL for a good row. A reason
    given by an earlier step stands alone. NaN counts as NULL.
    """
    rules = {rule.name: rule for rule in rules}
    kinds = dict(df.dtypes)
    # The stored values get columns of their own first, so that each is computed once.
    staged = df.selectExpr(
        "*", *[f"{_stored(rule, kinds[name])} AS `_stored_{name}`" for name, rule in rules.items()]
    )
    problems = ", ".join(_problem(rule, kinds[name]) for name, rule in rules.items())
    reason = f"nullif(concat_ws('; ', {problems}), '')"
    if REASON in kinds:
        reason = f"coalesce({REASON}, {reason})"
    return staged.selectExpr(
        *[f"`_stored_{c}` AS `{c}`" if c in rules else f"`{c}`" for c in df.columns if c != REASON],
        f"{reason} AS {REASON}",
    )


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNotNull())


def validate_profiles(
    df: DataFrame,
    defaults: Mapping[str, object] = PROFILE_DEFAULTS,
    numbers: Mapping[str, str] = PROFILE_NUMBERS,
    ranges: Mapping[str, tuple] = PROFILE_RANGES,
) -> DataFrame:
    """Fill the optional fields of profiles to score and check all of them.

    Absent columns and NULLs take the default. Number fields may come as text. A required field that
    is absent or NULL, a text that is no number, a broken whole number and a value out of its range
    each put the field's name into ``reject_reason``.
    """
    kinds = dict(df.dtypes)
    filled, problems = {}, []
    for name, default in defaults.items():
        given = F.col(name) if name in kinds else F.lit(None)
        number = numbers.get(name)
        if number is None:
            filled[name] = F.coalesce(given.cast("string"), F.lit(default))
            continue
        if name not in kinds:
            value = F.lit(None).cast("double")
        elif kinds[name] == "string":
            value = float_or_null(name)
        else:
            value = given.cast("double")
        problem = F.when(given.isNotNull() & value.isNull(), F.lit(f"{name}: invalid"))
        if number == "int":
            whole = value.try_cast("int")
            problem = problem.when(
                value.isNotNull() & ~F.equal_null(whole.cast("double"), value),
                F.lit(f"{name}: invalid"),
            )
        if default is None:
            problem = problem.when(given.isNull(), F.lit(f"{name}: missing"))
        if name in ranges:
            low, high = ranges[name]
            outside = (value < low) | F.isnan(value)
            if high is not None:
                outside = outside | (value > high)
            problem = problem.when(outside, F.lit(f"{name}: out of range"))
        problems.append(problem)
        typed = value.try_cast(number)
        filled[name] = typed if default is None else F.coalesce(typed, F.lit(default))
    reason = F.nullif(F.concat_ws("; ", *problems), F.lit(""))
    return df.select(
        *[c for c in df.columns if c not in filled],
        *[expression.alias(name) for name, expression in filled.items()],
        reason.alias(REASON),
    )
