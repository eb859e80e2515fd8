import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from subscriber_analytics.functions import columns as c
from tests.helpers import values


def test_float_texts(spark):
    texts = {
        "12": 12.0, " 12 ": 12.0, "\t7.9\n": 7.9, "-.5": -0.5, "1.": 1.0, "1e3": 1000.0,
        "1_000.5": 1000.5, "": None, "abc": None, "1.0d": None, "0x10": None, "1__0": None,
        "_1": None, "1,5": None, None: None, "inf": float("inf"), "-Infinity": float("-inf"),
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert dict(values(df, "t", c.float_or_null("t"))) == texts


def test_strip_against_python(spark):
    blanks = [chr(code) for code in range(0x3100) if chr(code).isspace()]
    texts = [f"{b}a{b}é{b}" for b in blanks] + ["".join(blanks), "a", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in values(df, c.strip("t"))] == [t.strip() for t in texts]


def _python_float(text):
    try:
        return repr(float(text.strip()))
    except ValueError:
        return None


def test_float_texts_against_python(spark):
    draw = random.Random(7)
    pieces = ["0", "1", "25", ".", "e", "E", "+", "-", "_", " ", "nan", "inf", "Infinity", "d", "x",
              "\t", "\u00a0", "\x1d", "1e400", "007"]
    texts = sorted({"".join(draw.choices(pieces, k=draw.randrange(1, 6))) for _ in range(6000)})
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {t: None if v is None else repr(v) for t, v in values(df, "t", c.float_or_null("t"))}
    assert got == {t: _python_float(t) for t in texts}
    assert sum(v is not None for v in got.values()) > 300


def test_nan_text(spark):
    df = spark.createDataFrame([("nan",), ("+NaN",)], "t string")
    assert values(df, F.isnan(c.float_or_null("t"))) == [(True,), (True,)]


def test_risk_tier_and_decision(spark):
    scores = [0.49995, 0.5, 0.69995, 0.69996, 0.7, 0.0, 1.0]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    assert [r[0] for r in values(df, c.risk_tier("s"))] == [
        "FAIBLE", "MOYEN", "MOYEN", "MOYEN", "ELEVE", "FAIBLE", "ELEVE"]
    stored = F.col("s").cast("decimal(5,4)")
    assert [r[0] for r in values(df, c.risk_tier(stored))] == [
        "MOYEN", "MOYEN", "ELEVE", "ELEVE", "ELEVE", "FAIBLE", "ELEVE"]
    assert [r[0] for r in values(df, c.decision("s", 0.5))] == [0, 1, 1, 1, 1, 0, 1]


def test_exact_mean_rounds_once(spark):
    # Two-decimal amounts whose mean is 1.00499999..., which avg() first rounds to 1.005000.
    df = spark.range(3_000_000).select(
        F.when(F.col("id") == 0, Decimal("1.00")).when(F.col("id") % 2 == 0, Decimal("1.01"))
        .otherwise(Decimal("1.00")).cast("decimal(8,2)").alias("x"))
    assert values(df.agg(c.exact_mean("x", 2)), "*") == [(Decimal("1.00"),)]
    assert values(df.agg(F.round(F.avg("x"), 2)), "*") == [(Decimal("1.01"),)]


@pytest.mark.parametrize("rows, expected", [
    ([("Yes",), ("No",), (None,)], Decimal("0.5000")),
    ([(None,)], None),
    ([("Yes",)] + [("No",)] * 31, Decimal("0.0313")),
])
def test_churn_rate(spark, rows, expected):
    df = spark.createDataFrame(rows, "churn string")
    assert values(df.agg(c.churn_rate()), "*") == [(expected,)]


def test_median_interpolates(spark):
    df = spark.createDataFrame([(1,), (2,), (9,), (None,), (-4,)], "d int")
    assert values(df.agg(c.exact_median("d", 1)), "*") == [(Decimal("1.5"),)]


def test_count_yes(spark):
    df = spark.createDataFrame([("Yes", "No"), (None, "yes"), ("Yes", "Yes")], "a string, b string")
    assert values(df, c.count_yes(["a", "b"])) == [(1,), (0,), (2,)]


def test_lifetime(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (DATE '2024-01-11', DATE '2024-01-01'), (NULL, DATE '2024-01-01'), "
        "(DATE '2024-01-01', DATE '2024-01-05'), (NULL, NULL) AS t(ended, began)")
    days = c.lifetime_days("ended", "began", c.as_of_timestamp("2024-02-01"))
    assert values(df, days) == [(10,), (31,), (-4,), (None,)]
