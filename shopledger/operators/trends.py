"""Reports over the sales fact.

All of them aggregate before they join or rank. The windows run over
aggregated rows only, where a key holds at most one row per month or year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopledger.functions.measures import growth_pct, percent

# The customer segments, best first.
HIGH_VALUE = "High-Value Customer"
REGULAR = "Regular Customer"
OCCASIONAL = "Occasional Buyer"

# A top-n list is broadcast only up to this many ids; LIMIT n proves its size.
BROADCAST_TOP_N = 10_000


def sales_by_month(sales: DataFrame) -> DataFrame:
    """The fact summed per customer, product and month, in the fact's own columns.

    ``order_date`` is the month's first day, ``lines`` counts the summed lines. Every
    report but the purchase trend and the segments gives the same rows on it as on the
    fact, so several reports can share one scan: stage it and pass it as ``sales``.
    Months by date and by the year and month columns are kept apart where they differ,
    as are missing ones. Amounts keep the fact's type, so sums keep theirs.
    """
    amount_type = sales.select("sales_amount").schema[0].dataType
    return (
        sales.groupBy(
            "customer_id",
            "product_id",
            F.trunc("order_date", "MM").alias("order_date"),
            "order_year",
            "order_month",
        )
        .agg(
            F.sum("quantity").alias("quantity"),
            F.sum("sales_amount").cast(amount_type).alias("sales_amount"),
            F.count("product_id").alias("lines"),
        )
    )


def peak_sales_months(sales: DataFrame) -> DataFrame:
    """Sales per calendar month, best month first.

    Rows are grouped on the month's first day and labelled afterwards, so the
    label is formatted once per month and not once per row.
    """
    return (
        sales.groupBy(F.trunc("order_date", "MM").alias("month_start"))
        .agg(F.sum("sales_amount").alias("monthly_product_sales"))
        .select(
            F.date_format("month_start", "yyyy-MM").alias("year_month"), "monthly_product_sales"
        )
        .orderBy(F.desc("monthly_product_sales"), "year_month")
    )


def top_customers(sales: DataFrame, *, n: int = 5) -> DataFrame:
    """Ids of the ``n`` customers with the highest sales; the id breaks ties."""
    return (
        sales.groupBy("customer_id")
        .agg(F.sum("sales_amount").alias("total"))
        .orderBy(F.desc("total"), "customer_id")
        .limit(n)
        .select("customer_id")
    )


def _sales_of_top(sales: DataFrame, n: int, top: DataFrame | None) -> DataFrame:
    # As a semi-join the restriction moves below the fact's own joins, to the orders.
    if top is not None:
        # A given list counts whole; its size is not known, so Catalyst picks the join.
        return sales.join(top.select("customer_id"), "customer_id", "left_semi")
    own = top_customers(sales, n=n)
    small = F.broadcast(own) if n <= BROADCAST_TOP_N else own
    return sales.join(small, "customer_id", "left_semi")


def top_customer_monthly_products(
    sales: DataFrame, products: DataFrame, *, n: int = 5, top: DataFrame | None = None
) -> DataFrame:
    """What the top customers bought, per month and product.

    ``top`` may carry a list of ids of any length, which then counts instead of the best
    ``n``; without it the fact is read twice, so an expensive one is best staged, as the
    sales job does. ``sales`` may be ``sales_by_month``.
    Lines are summed per product before the product join, so the join and the
    final sum (which merges repeated product rows) see no raw lines.
    """
    lines = F.sum("lines") if "lines" in sales.columns else F.count("product_id")
    monthly = (
        _sales_of_top(sales, n, top)
        .groupBy("customer_id", F.trunc("order_date", "MM").alias("month_start"), "product_id")
        .agg(lines.alias("lines"), F.sum("sales_amount").alias("amount"))
    )
    return (
        monthly.join(_named(products), "product_id")
        .groupBy("customer_id", "month_start", "product_id", "product_name", "category")
        .agg(F.sum("lines").alias("product_count"), F.sum("amount").alias("monthly_sales"))
        .select(
            "customer_id",
            F.date_format("month_start", "yyyy-MM").alias("year_month"),
            "product_id",
            "product_count",
            "product_name",
            "category",
            "monthly_sales",
        )
        .orderBy("customer_id", F.desc("monthly_sales"), "year_month", "product_id")
    )


def _named(products: DataFrame) -> DataFrame:
    return products.select("product_id", F.col("name").alias("product_name"), "category")


def customer_purchase_trend(sales: DataFrame, *, ordered: bool = True) -> DataFrame:
    """Orders, spend and growth per customer and month.

    ``avg_order_value`` is the mean of line amounts. Growth compares with the
    customer's previous active month, which need not be the month before.

    On ``sales_by_order`` each row is an order, so orders are counted as rows: no distinct,
    and one exchange less than on the fact.

    For ordered output the monthly rows are ranged by customer ahead of the
    window. That layout serves the window and the final sort, which saves the
    sort a shuffle and Spark a second pass over the window to sample its output.
    """
    by_month = Window.partitionBy("customer_id").orderBy("order_year", "order_month")
    by_order = "amounts" in sales.columns
    monthly = sales.groupBy("customer_id", "order_year", "order_month").agg(
        (F.count("order_id") if by_order else F.count_distinct("order_id")).alias(
            "orders_per_month"
        ),
        F.sum("sales_amount").alias("monthly_spent"),
        (F.sum("amounts") if by_order else F.count("sales_amount")).alias("lines"),
    )
    if ordered:
        monthly = monthly.repartitionByRange("customer_id")
    spent, previous = F.col("monthly_spent"), F.col("previous_month_spent")
    mean_line = spent.cast("double") / F.nullif(F.col("lines"), F.lit(0)).cast("double")
    trend = monthly.withColumn("previous_month_spent", F.lag(spent).over(by_month)).select(
        "customer_id",
        "order_year",
        "order_month",
        "orders_per_month",
        "monthly_spent",
        "previous_month_spent",
        growth_pct(spent, previous).alias("spending_growth_pct"),
        mean_line.alias("avg_order_value"),
    )
    if not ordered:
        return trend
    return trend.orderBy("customer_id", "spending_growth_pct", "order_year", "order_month")


def retention_rate(sales: DataFrame) -> DataFrame:
    """Per year, how many of its customers also bought in the year before.

    A look-back over distinct (customer, year) rows replaces a self-join; a
    customer has at most one row per year there.
    """
    by_year = Window.partitionBy("customer_id").orderBy("order_year")
    stayed = F.lag("order_year").over(by_year) == F.col("order_year") - 1
    return (
        sales.select("customer_id", "order_year")
        .distinct()
        .withColumn("stayed", stayed)
        .groupBy(F.col("order_year").alias("current_year"))
        .agg(
            F.count("customer_id").alias("total_customers_current_year"),
            F.count(F.when(F.col("stayed"), F.col("customer_id"))).alias("retained_customers"),
        )
        .withColumn(
            "retention_rate_pct",
            percent(F.col("retained_customers"), F.col("total_customers_current_year")),
        )
        .orderBy("current_year")
    )


def product_mom_growth(sales: DataFrame, products: DataFrame, *, ordered: bool = True) -> DataFrame:
    """Quantity, sales and growth per product and month.

    Growth compares with the product's previous active month. The window leaves
    rows hashed on product_id, so the product join shuffles only the products.
    """
    by_month = Window.partitionBy("product_id").orderBy("order_year", "order_month")
    growth = (
        sales.groupBy("order_year", "order_month", "product_id")
        .agg(
            F.sum("quantity").alias("total_quantity_sold"),
            F.sum("sales_amount").alias("total_sales_amount"),
        )
        .withColumn("previous_month_sales", F.lag("total_sales_amount").over(by_month))
        .join(_named(products), "product_id")
        .select(
            "order_year",
            "order_month",
            "product_id",
            "product_name",
            "category",
            "total_quantity_sold",
            "total_sales_amount",
            "previous_month_sales",
            growth_pct(F.col("total_sales_amount"), F.col("previous_month_sales")).alias(
                "month_over_month_growth_pct"
            ),
        )
    )
    if not ordered:
        return growth
    return growth.orderBy("product_id", "order_year", "order_month")


def yoy_comparison(
    sales: DataFrame, products: DataFrame, *, n: int = 5, top: DataFrame | None = None
) -> DataFrame:
    """The top customers' product sales against the same month one year on record earlier.

    ``top`` may carry a list of ids of any length; ``sales`` may be ``sales_by_month``.
    """
    monthly = (
        _sales_of_top(sales, n, top)
        .groupBy(
            "customer_id",
            "product_id",
            F.year("order_date").alias("sales_year"),
            F.month("order_date").alias("sales_month"),
        )
        .agg(F.sum("sales_amount").alias("amount"))
    )
    by_year = Window.partitionBy(
        "customer_id", "product_id", "sales_month"
    ).orderBy("sales_year")
    return (
        monthly.join(_named(products), "product_id")
        .groupBy(
            "customer_id", "product_id", "product_name", "category", "sales_year", "sales_month"
        )
        .agg(F.sum("amount").alias("monthly_sales"))
        .withColumn("prev_year_sales", F.lag("monthly_sales").over(by_year))
        .withColumn(
            "yoy_growth_percent", growth_pct(F.col("monthly_sales"), F.col("prev_year_sales"))
        )
        # Growth is mostly NULL; the further keys keep that value splittable.
        .orderBy(
            "customer_id", F.desc("yoy_growth_percent"), "product_id", "sales_year", "sales_month"
        )
    )


def customer_segments(
    sales: DataFrame,
    *,
    high_value: tuple[int, float] = (10, 1000),
    regular: tuple[int, float] = (5, 500),
) -> DataFrame:
    """Customers sorted into three segments by line count and spend.

    Each threshold is (lines, spend), and both must be reached. ``sales`` may be
    ``sales_by_order``.
    """

    def reaches(threshold: tuple[int, float]):
        lines, spend = threshold
        return (F.col("purchase_count") >= lines) & (F.col("total_spent") >= spend)

    return (
        sales.groupBy("customer_id")
        .agg(
            (F.sum("lines") if "amounts" in sales.columns else F.count("order_id")).alias(
                "purchase_count"
            ),
            F.sum("sales_amount").alias("total_spent"),
            F.max("order_date").alias("last_order_date"),
        )
        .withColumn(
            "customer_segment",
            F.when(reaches(high_value), HIGH_VALUE)
            .when(reaches(regular), REGULAR)
            .otherwise(OCCASIONAL),
        )
    )
