"""One key holds a third of all rows: results stay exact and no task gets the whole key."""

import pytest
from conftest import bag, plan
from pyspark.sql import functions as F

from shopledger import operators as ops

ROWS = 60_000
HOT = 7


def hot(column, others):
    """A third of the rows get the hot key, the rest spread over ``others`` keys."""
    return F.when(F.col("id") % 3 == 0, HOT).otherwise(F.col("id") % others).cast("bigint").alias(column)


@pytest.fixture
def split_early(conf):
    """Thresholds at which AQE treats the small fixtures as it would a large table."""
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="20KB",
        adaptive__coalescePartitions__minPartitionSize="20KB",
        shuffle__partitions="16",
    )


def stored(spark, tmp_path, name, df):
    df.repartition(8).write.parquet(f"{tmp_path}/{name}")
    return spark.read.parquet(f"{tmp_path}/{name}")


def test_hot_customer_in_order_cleaning(spark, tmp_path, split_early):
    raw = stored(
        spark,
        tmp_path,
        "orders",
        spark.range(ROWS).select(
            F.col("id").alias("order_id"),
            hot("customer_id", 500),
            F.lit("2024-01-01").cast("date").alias("order_date"),
            F.lit("F").alias("status"),
            F.lit(1.5).alias("total_amount"),
        ),
    )
    customers = spark.range(250).select(F.col("id").alias("customer_id"))
    found = ops.clean_orders(raw, customers, as_of="2024-02-01")
    assert found.groupBy().agg(F.count("*"), F.sum("order_id")).first() == raw.filter(
        "customer_id < 250"
    ).groupBy().agg(F.count("*"), F.sum("order_id")).first()
    found.collect()
    assert "skew=true" in plan(found)


@pytest.mark.parametrize("key", ["order_id", "product_id"])
def test_hot_order_or_product_in_the_fact(spark, tmp_path, split_early, key):
    keys = {"order_id": hot("order_id", 2000), "product_id": hot("product_id", 2000)}
    spread = {"order_id": F.col("id") % 2000, "product_id": F.col("id") % 1999}
    spread[key] = keys[key]
    items = stored(
        spark,
        tmp_path,
        "items",
        spark.range(ROWS).select(
            *[c.cast("bigint").alias(n) for n, c in spread.items()],
            (F.col("id") % 9).cast("int").alias("quantity"),
            (F.col("id") % 100).cast("decimal(10,2)").alias("unit_price"),
        ),
    )
    orders = spark.range(2000).select(
        F.col("id").alias("order_id"),
        (F.col("id") % 50).alias("customer_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 900).cast("int")).alias("order_date"),
    )
    products = spark.range(2000).select(
        F.col("id").alias("product_id"), F.lit("n").alias("name"), F.lit("c").alias("category")
    )
    sales = ops.sales_fact(orders, items, products)
    assert sales.count() == ROWS

    # The distinct order count could reuse the join's layout, which would pin the hot order.
    trend = ops.customer_purchase_trend(sales, ordered=False)
    months = bag(trend)
    assert "skew=true" in plan(trend)
    expected = (
        sales.groupBy("customer_id", "order_year", "order_month")
        .agg(F.count_distinct("order_id"), F.sum("sales_amount"))
    )
    assert sorted((m[:5] for m in months), key=repr) == bag(expected)

    growth = ops.product_mom_growth(sales, products, ordered=False)
    assert sum(r.total_quantity_sold for r in growth.collect()) == sum(i % 9 for i in range(ROWS))
    assert "skew=true" in plan(growth)


def test_windows_see_aggregated_rows_only(spark):
    orders = spark.range(10).select(
        F.col("id").alias("order_id"), F.col("id").alias("customer_id"),
        F.current_date().alias("order_date"), F.lit(1.0).alias("total_amount"),
    )
    items = spark.range(10).select(
        F.col("id").alias("order_id"), F.col("id").alias("product_id"),
        F.lit(1).alias("quantity"), F.lit(1.0).alias("unit_price"),
    )
    products = spark.range(10).select(
        F.col("id").alias("product_id"), F.lit("n").alias("name"), F.lit("c").alias("category")
    )
    sales = ops.sales_fact(orders, items, products)
    for report in [
        ops.customer_purchase_trend(sales),
        ops.retention_rate(sales),
        ops.product_mom_growth(sales, products),
        ops.yoy_comparison(sales, products),
    ]:
        text = plan(report)
        above, below = text.split("Window [", 1)
        assert "HashAggregate" in below
    assert "Window" not in plan(ops.churn_risk(orders))


def test_hot_customer_in_all_customer_reports(spark):
    events = spark.range(ROWS).select(
        F.col("id").alias("order_id"),
        hot("customer_id", 1000),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 80).cast("int")).alias("order_date"),
        F.lit(2).cast("decimal(10,2)").alias("total_amount"),
    )
    logins = events.select(
        "customer_id",
        F.col("order_date").alias("login_date"),
        (F.col("order_id") % 5000).cast("string").alias("ip_address"),
    )
    risky = ops.high_risk_customers(events, logins, as_of="2024-03-20")
    expected = (
        events.filter("order_date >= date '2024-02-19'")
        .groupBy("customer_id")
        .count()
        .filter("count > 10")
        .select("customer_id")
    )
    assert bag(risky) == bag(expected)
    assert (HOT,) in bag(risky)

    none = events.filter("false")
    interactions = none.selectExpr(
        "customer_id AS CustomerID", "order_date AS Timestamp", "'' AS Channel", "'' AS Action"
    )
    tickets = events.selectExpr(
        "customer_id AS CustomerID", "order_id AS TicketID", "order_date AS Timestamp",
        "'Open' AS Status",
    )
    profile = ops.omni_channel_engagement(events, interactions, tickets, as_of="2024-03-20")
    top = profile.first()
    per_hot = events.filter(F.col("customer_id") == HOT).count()
    assert (top.customer_id, top.purchases, top.open_ticket) == (HOT, per_hot, per_hot)
    assert profile.agg(F.sum("purchases")).first()[0] == ROWS


def test_one_total_shared_by_most_customers_is_sorted_in_parts(spark, conf):
    conf(adaptive__coalescePartitions__enabled="false")
    orders = spark.range(20_000).select(
        F.col("id").alias("order_id"), F.col("id").alias("customer_id"),
        F.lit("2024-03-01").cast("date").alias("order_date"),
        F.lit(1).cast("decimal(10,2)").alias("total_amount"),
    )
    nothing = orders.filter("false")
    interactions = nothing.selectExpr(
        "customer_id AS CustomerID", "order_date AS Timestamp", "'' AS Channel", "'' AS Action"
    )
    tickets = nothing.selectExpr(
        "customer_id AS CustomerID", "1 AS TicketID", "order_date AS Timestamp", "'' AS Status"
    )
    profile = ops.omni_channel_engagement(orders, interactions, tickets, as_of="2024-03-20")
    sizes = profile.groupBy(F.spark_partition_id()).count().select("count").collect()
    assert len(sizes) >= 4
    assert max(size[0] for size in sizes) < 10_000


def test_hot_country_is_cut_before_the_shuffle(spark):
    customers = spark.range(30_000).select(
        F.col("id").alias("customer_id"), F.lit("a").alias("first_name"),
        F.lit("b").alias("last_name"), F.lit("e").alias("email"),
        F.when(F.col("id") % 3 == 0, "United A").otherwise(F.concat(F.lit("United "), F.col("id") % 50)).alias("country"),
    )
    orders = customers.select(
        F.col("customer_id").alias("order_id"), "customer_id",
        F.lit("2024-03-01").cast("date").alias("order_date"),
        F.col("customer_id").cast("decimal(10,2)").alias("total_amount"),
    )
    found = ops.top_customers_by_country(orders, customers, as_of="2024-03-20")
    best = [r.customer_id for r in found.filter("country = 'United A'").orderBy("spending_rank").collect()]
    assert best == list(range(29_997, 29_967, -3))
    assert found.count() == 10 * 51


@pytest.mark.parametrize("same_total", [False, True])
def test_many_ranks_of_one_country(spark, tmp_path, same_total):
    """60,000 customers of one country and 5,000 ranks: exact, and in parts."""
    n, top_n = 60_000, 5_000
    customers = spark.range(n).select(
        F.col("id").alias("customer_id"), F.lit("a").alias("first_name"),
        F.lit("b").alias("last_name"), F.lit("e").alias("email"),
        F.lit("United A").alias("country"),
    )
    total = F.lit(5) if same_total else F.col("id") - F.col("id") % 2 - 20_000
    orders = spark.range(n).select(
        F.col("id").alias("order_id"), F.col("id").alias("customer_id"),
        F.lit("2024-03-01").cast("date").alias("order_date"),
        F.when(F.col("id") != 7, total).cast("decimal(10,2)").alias("total_amount"),
    )
    found = ops.top_customers_by_country(orders, customers, as_of="2024-03-20", top_n=top_n)
    ranks = {r["customer_id"]: r["spending_rank"] for r in found.collect()}
    if same_total:
        assert ranks == {i: 1 for i in range(n) if i != 7}
        return
    assert ranks == {i: n - i - i % 2 - 1 + 2 * (i % 2) for i in range(n - top_n, n)}
    # The windows by country see cells; those by cell see a small part of the totals.
    totals = spark.range(n // 2).select((F.col("id") * 2.0 - 20_000).alias("t"))
    cell = F.floor(F.signum("t") * F.log2(1 + F.abs("t")) * ops.ranking.CELLS_PER_DOUBLING)
    largest = totals.groupBy(cell.alias("cell")).count().agg(F.max("count")).first()[0]
    assert largest < n / 1000


def test_few_ranks_with_one_total_for_all(spark):
    customers = spark.range(20_000).select(
        F.col("id").alias("customer_id"), F.lit("a").alias("first_name"),
        F.lit("b").alias("last_name"), F.lit("e").alias("email"),
        F.when(F.col("id") % 2 == 0, "United A").alias("country"),
    )
    orders = spark.range(20_000).select(
        F.col("id").alias("order_id"), F.col("id").alias("customer_id"),
        F.lit("2024-03-01").cast("date").alias("order_date"),
        F.lit(None).cast("decimal(10,2)").alias("total_amount"),
    )
    found = ops.top_customers_by_country(
        orders, customers, as_of="2024-03-20", country_pattern=None
    )
    counts = found.groupBy("country", "spending_rank").count().collect()
    assert {tuple(r) for r in counts} == {("United A", 1, 10_000), (None, 1, 10_000)}
