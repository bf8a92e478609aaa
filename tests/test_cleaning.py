import re
from itertools import product

import pytest
from conftest import bag, day, plan

from shopledger import operators as ops
from shopledger.operators.cleaning import EMAIL_PATTERN

RAW_CUSTOMERS = (
    "customer_id bigint, first_name string, last_name string, email string, phone string, "
    "address string, city string, state string, zip_code int, country string"
)
RAW_ORDERS = (
    "order_id bigint, customer_id bigint, order_date date, status string, total_amount double"
)


def customer(customer_id, email, first_name=" Ann ", phone="+1 (555) 010-9"):
    return (customer_id, first_name, " Lee", email, phone, " 1 Main St ", "Ulm", "BW", 89073, "DE")


def test_text_is_tidied(spark):
    raw = spark.createDataFrame([customer(1, " Ann@Example.COM ")], RAW_CUSTOMERS)
    assert bag(ops.clean_customers(raw)) == [
        (1, "Ann", "Lee", "ann@example.com", "15550109", "1 Main St", "Ulm", "BW", "89073", "DE")
    ]


@pytest.mark.parametrize(
    ("email", "kept"),
    [
        ("a@b.c", True),
        ("a b@c.d", True),
        (" @ . ", True),
        ("a@bcd", False),
        ("a@b@c.d", False),
        ("a.b", False),
        ("@b.c", False),
        ("a@b.", False),
        (None, False),
    ],
)
def test_email_needs_one_at_and_a_dot(spark, email, kept):
    raw = spark.createDataFrame([customer(1, email)], RAW_CUSTOMERS)
    assert bool(bag(ops.clean_customers(raw))) is kept


def test_email_check_agrees_with_a_plain_regex_search(spark):
    texts = ["".join(parts) for parts in product("@. a", repeat=5)]
    df = spark.createDataFrame([(1, text) for text in texts], "customer_id int, email string")
    kept = {row.email for row in ops.valid_customers(df).collect()}
    assert kept == {text for text in texts if re.search(EMAIL_PATTERN, text)}
    assert 0 < len(kept) < len(texts)


def test_customers_without_id_go_and_whole_copies_merge(spark):
    rows = [
        customer(None, "a@b.c"),
        customer(1, "a@b.c"),
        customer(1, "A@B.C", first_name="Ann"),
        customer(1, "other@b.c"),
    ]
    cleaned = ops.clean_customers(spark.createDataFrame(rows, RAW_CUSTOMERS))
    assert [(r[0], r[3]) for r in bag(cleaned)] == [(1, "a@b.c"), (1, "other@b.c")]


def test_orders_are_filtered_merged_and_not_multiplied(spark):
    orders = spark.createDataFrame(
        [
            (1, 1, day("2024-01-01"), "F", 10.005),
            (1, 1, day("2024-01-01"), "F", 10.005),
            (2, 1, day("2024-01-31"), "F", 1.0),
            (3, 1, day("2024-02-01"), "F", 1.0),
            (4, 1, day("2024-01-01"), "F", 0.0),
            (5, 9, day("2024-01-01"), "F", 1.0),
            (None, 1, day("2024-01-01"), "F", 1.0),
            (7, None, day("2024-01-01"), "F", 1.0),
            (8, 1, None, "F", 1.0),
            (9, 1, day("2024-01-01"), "F", 1e12),
        ],
        RAW_ORDERS,
    )
    customers = spark.createDataFrame([(1,), (1,), (None,)], "customer_id bigint")
    kept = bag(ops.clean_orders(orders, customers, as_of="2024-01-31"))
    assert [(r[0], str(r[4])) for r in kept] == [(1, "10.01"), (2, "1.00"), (9, "None")]
    assert [r[2] for r in kept] == [day("2024-01-01"), day("2024-01-31"), day("2024-01-01")]


def test_text_orders_from_csv(spark):
    orders = spark.createDataFrame(
        [("1", "1", "2024-01-01", "F", "12.5"), ("2", "1", "soon", "F", "x")],
        "order_id string, customer_id string, order_date string, status string, "
        "total_amount string",
    )
    customers = spark.createDataFrame([("1",)], "customer_id string")
    kept = bag(ops.clean_orders(orders, customers, as_of="2024-01-31"))
    assert [(r[0], str(r[4])) for r in kept] == [("1", "12.50")]


def test_copies_merge_before_the_join(spark, conf):
    conf(autoBroadcastJoinThreshold="-1")
    orders = spark.createDataFrame([(1, 1, day("2024-01-01"), "F", 1.0)], RAW_ORDERS)
    customers = spark.createDataFrame([(1,)], "customer_id bigint")
    text = plan(ops.clean_orders(orders, customers, as_of="2024-01-31"))
    assert text.index("LeftSemi") < text.index("HashAggregate")
