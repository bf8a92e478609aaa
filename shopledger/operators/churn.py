"""Customers who have been away for much longer than their usual pause."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.functions.dates import AsOf, as_of_date, dated


def churn_risk(
    orders: DataFrame, *, as_of: AsOf = None, gap_factor: float = 2, ordered: bool = True
) -> DataFrame:
    """Customers whose days since the last order exceed ``gap_factor`` mean gaps.

    The gaps between consecutive orders add up to the span from the first to
    the last order, so their mean is span / (dated orders - 1). That needs only
    min, max and count: one shuffle of pre-aggregated rows, and no per-customer
    sort that a single huge customer could turn into one endless task.
    One dated order leaves no gap (NULL), so such a customer is never reported.
    """
    day = dated(orders, "order_date")
    gaps = F.count("day") - 1
    span = F.datediff(F.max("day"), F.min("day"))
    activity = (
        orders.select("customer_id", "order_id", day.alias("day"))
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.max("day").alias("last_order_date"),
            F.datediff(as_of_date(as_of), F.max("day")).alias("days_since_last_purchase"),
            (span.cast("double") / F.nullif(gaps, F.lit(0)).cast("double")).alias("avg_order_gap"),
        )
        .filter(F.col("days_since_last_purchase") > F.col("avg_order_gap") * gap_factor)
    )
    if not ordered:
        return activity
    # The id breaks ties, so a day shared by many customers spans range partitions.
    return activity.orderBy(F.desc("days_since_last_purchase"), "customer_id")
