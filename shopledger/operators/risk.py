"""Customers with both unusual logins and unusual spending."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.functions.dates import AsOf, in_trailing_days


def high_risk_customers(
    orders: DataFrame,
    logins: DataFrame,
    *,
    as_of: AsOf = None,
    days: int = 30,
    max_ips: int = 3,
    max_logins: int = 10,
    max_spent: float = 5000,
    max_orders: int = 5,
) -> DataFrame:
    """Ids that passed a login limit and a purchase limit in the trailing window.

    Both sides are aggregated to one row per customer first, so the semi-join
    meets no heavy key, reuses the aggregates' partitioning and needs no
    DISTINCT. The distinct IP count is spread over (customer, ip) before it is
    gathered per customer.
    """
    ips, attempts = F.count_distinct("ip_address"), F.count(F.lit(1))
    restless = (
        logins.filter(in_trailing_days(logins, "login_date", as_of, days))
        .groupBy("customer_id")
        .agg(((ips > max_ips) | (attempts > max_logins)).alias("flagged"))
        .filter("flagged")
    )
    spent, bought = F.sum("total_amount"), F.count("order_id")
    lavish = (
        orders.filter(in_trailing_days(orders, "order_date", as_of, days))
        .groupBy("customer_id")
        .agg(((spent > max_spent) | (bought > max_orders)).alias("flagged"))
        .filter("flagged")
    )
    return restless.select("customer_id").join(lavish, "customer_id", "left_semi")
