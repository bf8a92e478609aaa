import random
from decimal import ROUND_HALF_UP
from decimal import Decimal as D

import pytest
from conftest import bag, day, plan, tuples
from pyspark.sql import functions as F

from shopledger import operators as ops
from shopledger.functions.measures import growth_pct

SALES = (
    "order_id bigint, customer_id bigint, order_date date, product_id bigint, quantity int, "
    "unit_price decimal(10,2), sales_amount decimal(21,2), order_year int, order_month int"
)
PRODUCTS = "product_id bigint, name string, category string"


def line(order_id, customer_id, on, product_id, amount, quantity=1):
    d = day(on)
    amount = None if amount is None else D(amount)
    return (order_id, customer_id, d, product_id, quantity, amount, amount, d.year, d.month)


@pytest.fixture
def products(spark):
    return spark.createDataFrame([(1, "cup", "kitchen"), (2, "pen", "desk")], PRODUCTS)


def sales(spark, *lines):
    return spark.createDataFrame(list(lines), SALES)


def test_peak_months_best_first(spark):
    df = sales(
        spark,
        line(1, 1, "2024-01-01", 1, "5"),
        line(2, 1, "2024-01-31", 1, "5"),
        line(3, 1, "2023-12-01", 1, "11"),
        line(4, 1, "2023-01-01", 1, "10"),
    )
    assert tuples(ops.peak_sales_months(df)) == [
        ("2023-12", D("11.00")), ("2023-01", D("10.00")), ("2024-01", D("10.00"))
    ]


def test_top_customers_break_ties_by_id(spark):
    df = sales(spark, *[line(i, 10 - i, "2024-01-01", 1, "5") for i in range(8)])
    assert tuples(ops.top_customers(df, n=3)) == [(3,), (4,), (5,)]


def test_top_customer_monthly_products(spark, products):
    df = sales(
        spark,
        line(1, 1, "2024-01-05", 1, "5"),
        line(1, 1, "2024-01-20", 1, "6"),
        line(2, 1, "2024-01-05", 2, "20"),
        line(3, 1, "2024-02-05", 1, "1"),
        line(4, 2, "2024-01-05", 1, "3"),
        line(5, 1, "2024-01-05", 9, "100"),
    )
    expected = [
        (1, "2024-01", 2, 1, "pen", "desk", D("20.00")),
        (1, "2024-01", 1, 2, "cup", "kitchen", D("11.00")),
        (1, "2024-02", 1, 1, "cup", "kitchen", D("1.00")),
    ]
    found = ops.top_customer_monthly_products(df, products, n=1)
    assert found.columns == [
        "customer_id", "year_month", "product_id", "product_count", "product_name", "category",
        "monthly_sales",
    ]
    assert tuples(found) == expected
    given = spark.createDataFrame([(2,)], "customer_id bigint")
    found = ops.top_customer_monthly_products(df, products, n=1, top=given)
    assert tuples(found) == [(2, "2024-01", 1, 1, "cup", "kitchen", D("3.00"))]


def test_repeated_product_rows_count_like_a_plain_join(spark):
    twice = spark.createDataFrame([(1, "cup", "a"), (1, "cup", "a"), (1, "mug", "a")], PRODUCTS)
    df = sales(spark, line(1, 1, "2024-01-05", 1, "5"), line(2, 1, "2024-01-06", 1, "6"))
    found = ops.top_customer_monthly_products(df, twice)
    assert bag(found.select("product_name", "product_count", "monthly_sales")) == [
        ("cup", 4, D("22.00")), ("mug", 2, D("11.00"))
    ]


def test_a_given_top_list_counts_whole(spark, products):
    df = sales(spark, *[line(i, i, "2024-01-05", 1, str(i + 1)) for i in range(15)])
    ids = [(i,) for i in range(12)] + [(3,)]  # a repeated id multiplies nothing
    top = spark.createDataFrame(ids, "customer_id bigint")
    for report in (ops.top_customer_monthly_products, ops.yoy_comparison):
        found = [row["customer_id"] for row in report(df, products, top=top).collect()]
        assert sorted(found) == list(range(12))
        analysed = report(df, products, top=top)._jdf.queryExecution().analyzed().toString()
        assert "broadcast" not in analysed


def test_growth_rounds_every_tie_away_from_zero(spark):
    """Pairs whose growth ends in half a hundredth, rising and falling."""
    rng = random.Random(0)
    pairs = []
    for base in (40, 100_000, 200_000, 12_800, 4_000_000):  # cents
        for _ in range(1500):
            halves = 2 * rng.randint(-9000, 9000) + 1  # growth in halves of a hundredth
            change, rest = divmod(halves * base, 20_000)
            if not rest and base + change > 0:
                pairs.append((base, base + change))
    for _ in range(2000):
        pairs.append((rng.randint(1, 10**9), rng.randint(1, 10**9)))
    cents = [(D(a) / 100, D(b) / 100) for a, b in pairs]
    assert len(pairs) > 4000
    table = spark.createDataFrame(cents, "previous decimal(31,2), current decimal(31,2)")
    found = table.select("previous", "current", growth_pct(F.col("current"), F.col("previous")))
    for previous, current, growth in tuples(found):
        exact = (100 * (current - previous) / previous).quantize(D("0.01"), ROUND_HALF_UP)
        assert D(repr(growth)).quantize(D("0.01")) == exact, (previous, current)


def test_growth_without_a_base(spark):
    table = spark.createDataFrame(
        [(D("0.00"), D("5.00")), (None, D("5.00")), (D("5.00"), None)],
        "previous decimal(31,2), current decimal(31,2)",
    )
    found = table.select(growth_pct(F.col("current"), F.col("previous")))
    assert tuples(found) == [(None,)] * 3


def test_reports_on_monthly_sums_equal_those_on_the_fact(spark, products):
    rng = random.Random(1)
    lines = [
        line(
            rng.randint(1, 60), rng.randint(1, 9), f"20{rng.randint(20, 23)}-{rng.randint(1, 12):02d}-11",
            rng.randint(1, 3), None if rng.random() < 0.1 else str(rng.randint(1, 99)), rng.randint(1, 4),
        )
        for _ in range(400)
    ]
    lines += [(7, 3, None, 1, 2, D("5"), D("5"), None, None), (8, None, None, None, 1, None, None, 2021, 3)]
    # The stored year may differ from the date's.
    lines += [(9, 4, day("2022-05-06"), 2, 1, D("9"), D("9"), 2021, 4)]
    df = sales(spark, *lines)
    repeated = products.unionAll(products.limit(1))
    monthly = ops.sales_by_month(df)
    for report in (
        ops.peak_sales_months,
        ops.top_customers,
        ops.retention_rate,
        lambda s: ops.product_mom_growth(s, repeated),
        lambda s: ops.top_customer_monthly_products(s, repeated),
        lambda s: ops.yoy_comparison(s, repeated),
    ):
        assert report(monthly).schema == report(df).schema
        assert bag(report(monthly)) == bag(report(df))


def test_wide_top_lists_are_not_broadcast(spark, products):
    df = sales(spark, line(1, 1, "2024-01-05", 1, "5"))
    limit = ops.trends.BROADCAST_TOP_N

    def hinted(n):
        plan = ops.yoy_comparison(df, products, n=n)._jdf.queryExecution().analyzed().toString()
        return "broadcast" in plan

    assert hinted(limit)
    assert not hinted(limit + 1)


def test_purchase_trend(spark):
    df = sales(
        spark,
        line(1, 1, "2024-01-05", 1, "10"),
        line(1, 1, "2024-01-05", 2, "20"),
        line(2, 1, "2024-01-06", 2, "30"),
        line(3, 1, "2024-04-01", 1, "45"),
        line(4, 1, "2024-05-01", 1, "0"),
        line(5, 1, "2024-06-01", 1, "7"),
        line(6, 2, "2024-06-01", 1, None),
    )
    found = ops.customer_purchase_trend(df)
    assert found.columns == [
        "customer_id", "order_year", "order_month", "orders_per_month", "monthly_spent",
        "previous_month_spent", "spending_growth_pct", "avg_order_value",
    ]
    assert tuples(found) == [
        (1, 2024, 1, 2, D("60.00"), None, None, 20.0),
        (1, 2024, 6, 1, D("7.00"), D("0.00"), None, 7.0),
        (1, 2024, 5, 1, D("0.00"), D("45.00"), -100.0, 0.0),
        (1, 2024, 4, 1, D("45.00"), D("60.00"), -25.0, 45.0),
        (2, 2024, 6, 1, None, None, None, None),
    ]
    assert bag(ops.customer_purchase_trend(df, ordered=False)) == bag(found)


def test_trend_is_sorted_across_partitions_without_a_second_range_shuffle(spark):
    many = spark.range(5000).selectExpr(
        "id AS order_id", "id % 700 AS customer_id", "1 AS product_id", "1 AS quantity",
        "date_add(date'2020-01-01', cast(id % 400 AS int)) AS order_date",
        "1.0 AS unit_price", "cast(id % 97 AS decimal(21,2)) AS sales_amount",
        "cast(2020 AS int) AS order_year", "cast(id % 12 + 1 AS int) AS order_month",
    )
    found = ops.customer_purchase_trend(many)
    assert plan(found).count("Exchange rangepartitioning") == 1
    nulls_first = [
        (r.customer_id, float("-inf") if r.spending_growth_pct is None else r.spending_growth_pct)
        for r in found.collect()
    ]
    assert nulls_first == sorted(nulls_first)
    assert bag(found) == bag(ops.customer_purchase_trend(many, ordered=False))


def test_retention(spark):
    df = sales(
        spark,
        line(1, 1, "2021-01-05", 1, "1"),
        line(2, 2, "2021-01-05", 1, "1"),
        line(3, 1, "2022-01-05", 1, "1"),
        line(4, 1, "2022-02-05", 1, "1"),
        line(5, 3, "2022-01-05", 1, "1"),
        line(6, 4, "2022-01-05", 1, "1"),
        line(7, 2, "2023-01-05", 1, "1"),
        line(8, 1, "2023-01-05", 1, "1"),
        line(9, None, "2023-01-05", 1, "1"),
        line(10, None, "2022-01-05", 1, "1"),
    )
    assert tuples(ops.retention_rate(df)) == [
        (2021, 2, 0, 0.0), (2022, 3, 1, 33.33), (2023, 2, 1, 50.0)
    ]


def test_product_growth_over_active_months(spark, products):
    df = sales(
        spark,
        line(1, 1, "2023-12-05", 1, "10", quantity=2),
        line(2, 2, "2023-12-06", 1, "10", quantity=3),
        line(3, 1, "2024-02-05", 1, "25"),
        line(4, 1, "2024-02-05", 2, "1"),
        line(5, 1, "2024-02-05", 9, "1"),
    )
    found = ops.product_mom_growth(df, products)
    assert found.columns == [
        "order_year", "order_month", "product_id", "product_name", "category",
        "total_quantity_sold", "total_sales_amount", "previous_month_sales",
        "month_over_month_growth_pct",
    ]
    assert tuples(found) == [
        (2023, 12, 1, "cup", "kitchen", 5, D("20.00"), None, None),
        (2024, 2, 1, "cup", "kitchen", 1, D("25.00"), D("20.00"), 25.0),
        (2024, 2, 2, "pen", "desk", 1, D("1.00"), None, None),
    ]
    assert bag(ops.product_mom_growth(df, products, ordered=False)) == bag(found)


def test_same_month_of_the_previous_year_on_record(spark, products):
    df = sales(
        spark,
        line(1, 1, "2020-03-05", 1, "10"),
        line(2, 1, "2023-03-05", 1, "5"),
        line(3, 1, "2023-03-09", 1, "10"),
        line(4, 1, "2023-04-05", 1, "1"),
        line(5, 1, "2023-03-05", 2, "1"),
        line(6, 2, "2023-03-05", 1, "1"),
    )
    found = ops.yoy_comparison(df, products, n=1)
    assert found.columns == [
        "customer_id", "product_id", "product_name", "category", "sales_year", "sales_month",
        "monthly_sales", "prev_year_sales", "yoy_growth_percent",
    ]
    assert tuples(found) == [
        (1, 1, "cup", "kitchen", 2023, 3, D("15.00"), D("10.00"), 50.0),
        (1, 1, "cup", "kitchen", 2020, 3, D("10.00"), None, None),
        (1, 1, "cup", "kitchen", 2023, 4, D("1.00"), None, None),
        (1, 2, "pen", "desk", 2023, 3, D("1.00"), None, None),
    ]


@pytest.mark.parametrize(
    ("lines", "amount", "segment"),
    [
        (10, "100", "High-Value Customer"),
        (10, "99.99", "Regular Customer"),
        (9, "500", "Regular Customer"),
        (5, "100", "Regular Customer"),
        (5, "99.99", "Occasional Buyer"),
        (4, "9999", "Occasional Buyer"),
        (20, None, "Occasional Buyer"),
    ],
)
def test_segments(spark, lines, amount, segment):
    df = sales(spark, *[line(i, 1, "2024-01-05", 1, amount) for i in range(lines)])
    found = ops.customer_segments(df)
    assert found.columns == [
        "customer_id", "purchase_count", "total_spent", "last_order_date", "customer_segment"
    ]
    row = found.first()
    assert (row.purchase_count, row.customer_segment) == (lines, segment)
    assert row.last_order_date == day("2024-01-05")


def test_every_customer_has_one_segment(spark):
    df = sales(spark, *[line(i, i % 37, "2024-01-05", 1, str(i % 50)) for i in range(400)])
    found = ops.customer_segments(df)
    assert found.count() == 37
    assert found.agg({"purchase_count": "sum"}).first()[0] == 400
