"""The sales fact: order lines with their customer, date and amount."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.functions.casts import Types, fitted
from shopledger.functions.dates import dated

# The fact's columns in order.
SALES_COLUMNS = [
    "order_id",
    "customer_id",
    "order_date",
    "product_id",
    "quantity",
    "unit_price",
    "sales_amount",
    "order_year",
    "order_month",
]


def sales_fact(orders: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Lines of known orders and known products, with amount, year and month.

    Lines meet the products first, while they are still narrow, and the orders
    second. Computed columns are made before the joins: what a report does not
    read is pruned early, and a filter or semi-join on the fact can move down to
    the table it concerns. No join is hinted: Catalyst broadcasts a side only
    when its size is known to be small, and AQE splits a hot product or order.
    """
    lines = order_items.select(
        "order_id",
        "product_id",
        "quantity",
        "unit_price",
        (F.col("quantity") * F.col("unit_price")).alias("sales_amount"),
    ).join(products.select("product_id"), "product_id")
    day = dated(orders, "order_date")
    headers = orders.select(
        "order_id",
        "customer_id",
        day.alias("order_date"),
        F.year(day).alias("order_year"),
        F.month(day).alias("order_month"),
    )
    return lines.join(headers, "order_id").select(*SALES_COLUMNS)


def sales_by_order(orders: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """The fact's lines summed per order, customer and month, before they meet the orders.

    The columns are the fact's without product and price; ``lines`` counts the summed
    lines, ``amounts`` those with an amount, and ``order_date`` is the last of the month's.
    The reports on customers and months (peaks, trend, retention, segments) give the same
    rows on it as on the fact. Lines are summed where they are read and once more in the
    layout of the join, so one row an order is shuffled and no line of a hot order is. The
    orders arrive in that layout too; repeated ones are merged there with their number, so
    that each (order, customer, month) is one row and orders need not be counted apart.
    """
    amount = F.col("quantity") * F.col("unit_price")
    amount_type = order_items.select(amount).schema[0].dataType
    total = F.sum("order_amount")
    if isinstance(amount_type, T.DecimalType):  # reports then sum to the fact's types
        total = total.cast(amount_type)
    lines = (
        order_items.select("order_id", "product_id", "quantity", amount.alias("sales_amount"))
        .join(products.select("product_id"), "product_id")
        .groupBy("order_id")
        .agg(
            F.sum("quantity").alias("order_quantity"),
            F.sum("sales_amount").alias("order_amount"),
            F.count(F.lit(1)).alias("order_lines"),
            F.count("sales_amount").alias("order_amounts"),
        )
    )
    day = dated(orders, "order_date")
    headers = orders.select(
        "order_id",
        "customer_id",
        day.alias("order_date"),
        F.year(day).alias("order_year"),
        F.month(day).alias("order_month"),
    )
    return (
        lines.join(headers, "order_id")
        .groupBy("order_id", "customer_id", "order_year", "order_month")
        .agg(
            F.max("order_date").alias("order_date"),
            F.sum("order_quantity").alias("quantity"),
            total.alias("sales_amount"),
            F.sum("order_lines").alias("lines"),
            F.sum("order_amounts").alias("amounts"),
        )
    )


def sales_with_history(sales: DataFrame, history: DataFrame) -> DataFrame:
    """Current sales followed by historical ones (UNION ALL).

    History takes the current fact's types. A value that does not fit them becomes
    NULL; ``rejected_values(history, fact_types(sales))`` counts those, and the sales
    job fails on them unless it is told how many to accept.
    """
    current = sales.select(*SALES_COLUMNS)
    return current.unionByName(history.select(*fitted(fact_types(sales))))


def fact_types(sales: DataFrame) -> Types:
    """The fact's columns with their types."""
    return {field.name: field.dataType for field in sales.select(*SALES_COLUMNS).schema}
