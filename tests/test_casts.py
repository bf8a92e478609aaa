from decimal import Decimal as D

import pytest
from conftest import bag, day, tuples
from pyspark.sql import types as T

from shopledger import operators as ops
from shopledger import plans
from shopledger.functions.casts import common_id_type
from shopledger.sources import column_types, read_audit_log

LINES = "order_id bigint, product_id bigint, quantity int, unit_price decimal(10,2)"


def tables(spark, history_amounts):
    orders = spark.createDataFrame(
        [(1, 7, day("2024-01-05"))], "order_id bigint, customer_id int, order_date date"
    )
    history = [
        (2, "7", "2023-01-05", 1, 1, D("1"), amount, 2023, 1) for amount in history_amounts
    ]
    return {
        "orders": orders,
        "order_items": spark.createDataFrame([(1, 1, 2, D("3.50"))], LINES),
        "products": spark.createDataFrame(
            [(1, "cup", "kitchen")], "product_id bigint, name string, category string"
        ),
        "historical_customer_sales": spark.createDataFrame(
            history,
            "order_id bigint, customer_id string, order_date string, product_id bigint, quantity int, "
            "unit_price decimal(10,2), sales_amount string, order_year int, order_month int",
        ),
    }


def test_common_id_types(spark):
    def ids(kind, *values):
        return spark.createDataFrame([(v,) for v in values], f"id {kind}"), "id"

    small, large = ids("int", 1), ids("bigint", 1 << 40)
    assert common_id_type([small, small]) == T.IntegerType()
    assert common_id_type([small, large]) == T.LongType()
    assert common_id_type([small, ids("string", "7", None)]) == T.LongType()
    assert common_id_type([small, ids("string", "7", "C1")]) == T.StringType()
    assert common_id_type([small, ids("decimal(20,1)", D("1.5"))]) == T.StringType()


@pytest.mark.parametrize(
    ("kind", "ids"), [("bigint", [3_000_000_000, 3_000_000_001]), ("string", ["C1", "C2"])]
)
def test_ids_of_another_type_stay_apart(spark, kind, ids):
    orders = spark.createDataFrame(
        [(5, 1, day("2024-01-02"), D("9.00"))],
        "customer_id int, order_id int, order_date date, total_amount decimal(10,2)",
    )
    own = type(ids[0])(5)
    interactions = spark.createDataFrame(
        [(ids[0], day("2024-01-02"), "Email", "Opened"), (own, day("2024-01-02"), "Web", "Opened")],
        f"CustomerID {kind}, Timestamp date, Channel string, Action string",
    )
    tickets = spark.createDataFrame(
        [(ids[1], day("2024-01-02"), 1, "Open")],
        f"CustomerID {kind}, Timestamp date, TicketID int, Status string",
    )
    found = ops.omni_channel_engagement(orders, interactions, tickets, as_of="2024-01-03")
    assert {
        (r["customer_id"], r["emails_opened"], r["ad_views"], r["purchases"], r["total_ticket"])
        for r in found.collect()
    } == {(ids[0], 1, 0, 0, 0), (own, 0, 1, 1, 0), (ids[1], 0, 0, 0, 1)}


def test_rejected_values_by_column(spark):
    history = tables(spark, ["1.5", "12,50", None, "x"])["historical_customer_sales"]
    types = column_types("historical_customer_sales")
    found = ops.rejected_values(history, {n: types[n] for n in ("customer_id", "sales_amount")})
    assert tuples(found) == [("customer_id", 0), ("sales_amount", 2)]
    assert bag(ops.rejected_values(history.limit(0), {"quantity": T.LongType()})) == [("quantity", 0)]


def test_unreadable_history_fails_the_sales_job(spark, tmp_path):
    source = tables(spark, ["4.00", "12,50"]).__getitem__
    log = f"{tmp_path}/log"
    with pytest.raises(ops.RejectedValuesError):
        plans.sales_trends_job(spark, source, f"{tmp_path}/gold", log)
    assert [r["status"] for r in read_audit_log(spark, log).collect()] == ["FAILURE"]
    counts = plans.sales_trends_job(spark, source, f"{tmp_path}/gold", log, max_rejected=1)
    assert counts.rejected == 1 and counts["peak_sales_months"] == 2
    assert [r["status"] for r in read_audit_log(spark, log).collect()] == ["FAILURE", "SUCCESS"]


def test_readable_history_rejects_nothing(spark, tmp_path):
    source = tables(spark, ["4.00", None]).__getitem__
    counts = plans.sales_trends_job(spark, source, f"{tmp_path}/gold", f"{tmp_path}/log")
    assert counts.rejected == 0
