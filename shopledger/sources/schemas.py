"""Expected shape of each input table, as DDL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shopledger.functions.casts import Types, fitted

_INTERACTION = "struct<InteractionID:bigint,Timestamp:timestamp,Channel:string,Action:string>"

SCHEMAS = {
    "customers": (
        "customer_id bigint, first_name string, last_name string, email string, phone string, "
        "address string, city string, state string, zip_code string, country string"
    ),
    "orders": (
        "order_id bigint, customer_id bigint, order_date date, status string, "
        "total_amount decimal(10,2)"
    ),
    "order_items": (
        "order_id bigint, product_id bigint, quantity int, unit_price decimal(10,2)"
    ),
    "products": "product_id bigint, name string, category string",
    "historical_customer_sales": (
        "order_id bigint, customer_id bigint, order_date timestamp, product_id bigint, "
        "quantity int, unit_price decimal(10,2), sales_amount decimal(21,2), "
        "order_year int, order_month int"
    ),
    "loginhistory": "customer_id bigint, login_date date, ip_address string",
    "enterprisecampaigns": (
        "CustomerID bigint, CampaignID bigint, Engagement struct<Opens:bigint,Clicks:bigint>, "
        f"Interactions array<{_INTERACTION}>"
    ),
    "customersupport": (
        "CustomerID bigint, TicketID bigint, Timestamp timestamp, Issue struct<Status:string>"
    ),
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """``df`` with exactly the columns and types of ``table``.

    Meant for untyped sources such as CSV. A missing column raises when the
    plan is analysed; a value that does not fit its type becomes NULL, and
    ``rejected_values(df, column_types(table))`` counts those.
    """
    return df.select(*fitted(column_types(table)))


def column_types(table: str) -> Types:
    """The columns of ``table`` with their types."""
    return {f.name: f.dataType for f in T.StructType.fromDDL(SCHEMAS[table])}
