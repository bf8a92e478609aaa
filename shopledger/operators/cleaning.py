"""Cleaning of raw customer and order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.functions.casts import fitted
from shopledger.functions.dates import AsOf, as_of_date, dated
from shopledger.functions.measures import numeric

# Fixed value: an address with one "@" and a dot after it. Blanks are allowed,
# because the check runs before trimming.
EMAIL_PATTERN = r"^[^@]+@[^@]+\.[^@]+$"


# Fixed value: the published type of amounts. What does not fit becomes NULL; the
# preprocessing job counts that and fails on it.
ORDER_TYPES = {"total_amount": T.DecimalType(10, 2)}


def valid_customers(customers: DataFrame, *, email_pattern: str = EMAIL_PATTERN) -> DataFrame:
    """Raw rows that have a customer_id and a well-formed email. No shuffle."""
    return customers.filter(
        F.col("customer_id").isNotNull() & F.col("email").rlike(email_pattern)
    )


def clean_customers(customers: DataFrame, *, email_pattern: str = EMAIL_PATTERN) -> DataFrame:
    """Valid customers with tidied text and digits-only phones, without duplicate rows.

    Duplicates are whole rows: an id with two different rows keeps both.
    """
    return (
        valid_customers(customers, email_pattern=email_pattern)
        .select(
            "customer_id",
            F.trim("first_name").alias("first_name"),
            F.trim("last_name").alias("last_name"),
            F.lower(F.trim("email")).alias("email"),
            F.regexp_replace("phone", "[^0-9]", "").alias("phone"),
            F.trim("address").alias("address"),
            "city",
            "state",
            F.col("zip_code").cast("string").alias("zip_code"),
            "country",
        )
        .distinct()
    )


def clean_orders(orders: DataFrame, customers: DataFrame, *, as_of: AsOf = None) -> DataFrame:
    """Paid, identified orders up to ``as_of`` whose customer is in ``customers``.

    ``customers`` is only asked which ids exist, so it may repeat ids; pass
    cleaned customers or ``valid_customers``.

    DISTINCT runs before the semi-join on purpose. After the join the rows
    would already be hashed on customer_id, the DISTINCT would reuse that
    layout, and AQE could no longer split the partition of one huge customer.
    This way copies are merged before the shuffle and the join stays splittable.
    """
    kept = (
        orders.filter(
            F.col("order_id").isNotNull()
            & F.col("customer_id").isNotNull()
            & (numeric(orders, "total_amount") > 0)
            & (dated(orders, "order_date") <= as_of_date(as_of))
        )
        .select(
            "order_id",
            "customer_id",
            "order_date",
            "status",
            *fitted(ORDER_TYPES),
        )
        .distinct()
    )
    semi = kept.join(customers.select("customer_id"), "customer_id", "left_semi")
    return semi.select("order_id", "customer_id", "order_date", "status", "total_amount")
