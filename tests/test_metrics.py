"""Batch summary."""

from decimal import Decimal

from subscriber_analytics.operators.metrics import batch_metrics
from tests.helpers import values


def test_decisions_count_as_they_were_made_and_rejected_rows_do_not(spark):
    # 0.49996 is stored as 0.5000, but was decided as 0.
    rows = spark.createDataFrame(
        [(1, 0.5, 0, None), (1, 0.2, 0, None), (1, 0.9, 1, "customer_id: missing"), (2, 0.7, 1, None)],
        "batch_id int, churn_score double, churn_predicted int, reject_reason string")
    rows = rows.withColumn("churn_score", rows["churn_score"].cast("decimal(5,4)"))
    assert sorted(values(batch_metrics(rows), "*")) == [(1, 2, 0, Decimal("0.350")), (2, 1, 1, Decimal("0.700"))]
