"""Every operator on the test tables, by query name.

Each entry takes (spark, folder of one scale factor) and returns a DataFrame
over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger import operators as ops
from shopledger import plans
from shopledger.functions.dates import month_column, with_month
from shopledger.queries.adapters import HISTORY_END, LATE_MONTHS, ORDER_SHIFT_DAYS, Retail
from shopledger.session import tune
from shopledger.sources import (
    drop_staged,
    publish_table,
    read_audit_log,
    read_footers,
    read_parquet,
    read_path,
    sift,
    stage,
    staging_folder,
    write_dataset,
)

Query = Callable[[SparkSession, str], DataFrame]

# Key columns of the test tables, as far as they have a single one.
TABLE_KEYS = {
    "region": "r_regionkey",
    "nation": "n_nationkey",
    "customer": "c_custkey",
    "supplier": "s_suppkey",
    "part": "p_partkey",
    "orders": "o_orderkey",
    "lineitem": "l_orderkey",
    "events": "event_id",
    "documents": "doc_id",
    "embeddings": "vec_id",
    "pages": "page_id",
    "benchmark": "item_id",
    "labels": "doc_id",
    "conversations": "conv_id",
}

QUERIES: dict[str, Query] = {}


def _query(build: Callable[[Retail], DataFrame]) -> Callable[[Retail], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Retail(tune(spark), folder))
    return build


@_query
def top_customers_by_country(t: Retail) -> DataFrame:
    return ops.top_customers_by_country(
        t.orders(), t.customers(), as_of="2001-08-01", country_pattern="NATION_1%"
    )


@_query
def customer_ranks(t: Retail) -> DataFrame:
    """Ranks of all customers, of whatever country."""
    found = ops.top_customers_by_country(
        t.orders(), t.customers(), as_of="2001-08-01", days=3650, top_n=100_000,
        country_pattern=None,
    )
    return found.select("country", "customer_id", "total_spent", "spending_rank")


@_query
def top_customers_all_columns(t: Retail) -> DataFrame:
    return ops.top_customers_by_country(
        t.orders(),
        t.customers(),
        as_of="2001-08-01",
        country_pattern="NATION_1%",
        all_columns=True,
    )


@_query
def top_customers_by_month_folders(t: Retail) -> DataFrame:
    """The same from orders published by month, of which a year's folders are read.

    The result reads the published files, so their folder stays until the application ends.
    """
    folder = staging_folder(t.spark)
    orders = with_month(t.orders(), "order_date")
    write_dataset(orders, folder, partition_by=[month_column("order_date")], mode="append")
    published = t.spark.read.schema(orders.schema).parquet(folder)
    return ops.top_customers_by_country(
        published, t.customers(), as_of="2001-08-01", country_pattern="NATION_1%"
    )


@_query
def churn_risk(t: Retail) -> DataFrame:
    return ops.churn_risk(t.orders(), as_of="2001-08-02")


@_query
def high_risk_customers(t: Retail) -> DataFrame:
    return ops.high_risk_customers(t.orders(ORDER_SHIFT_DAYS), t.logins(), as_of="2024-01-31")


@_query
def clean_customers(t: Retail) -> DataFrame:
    return ops.clean_customers(t.dirty_customers())


@_query
def clean_orders(t: Retail) -> DataFrame:
    return ops.clean_orders(
        t.dirty_orders(), ops.valid_customers(t.dirty_customers()), as_of="2000-12-31"
    )


@_query
def campaign_interactions(t: Retail) -> DataFrame:
    return ops.flatten_campaign_interactions(t.campaigns())


@_query
def support_tickets(t: Retail) -> DataFrame:
    tickets = ops.flatten_support_tickets(t.support())
    return tickets.withColumn("Issue", F.to_json("Issue"))


def _engagement(t: Retail, zero_fill: bool) -> DataFrame:
    return ops.omni_channel_engagement(
        t.orders(ORDER_SHIFT_DAYS),
        ops.flatten_campaign_interactions(t.campaigns()),
        ops.flatten_support_tickets(t.support()),
        as_of="2024-04-09",
        zero_fill=zero_fill,
    )


@_query
def omni_channel_engagement(t: Retail) -> DataFrame:
    return _engagement(t, zero_fill=True)


@_query
def omni_channel_engagement_nulls(t: Retail) -> DataFrame:
    return _engagement(t, zero_fill=False)


@_query
def omni_channel_engagement_text_ids(t: Retail) -> DataFrame:
    """Profiles where one source pads its ids with zeros and another has a prefix in some."""
    tickets = ops.flatten_support_tickets(t.support())
    padded = F.lpad(F.col("CustomerID").cast("string"), 12, "0")
    named = F.when(F.col("CustomerID") % 9 == 4, F.concat(F.lit("C"), F.col("CustomerID")))
    interactions = ops.flatten_campaign_interactions(t.campaigns())
    return ops.omni_channel_engagement(
        t.orders(ORDER_SHIFT_DAYS),
        interactions.withColumn("CustomerID", padded),
        tickets.withColumn("CustomerID", F.coalesce(named, F.col("CustomerID").cast("string"))),
        as_of="2024-04-09",
        text_ids=True,
    )


@_query
def sales_fact(t: Retail) -> DataFrame:
    return t.sales()


@_query
def sales_by_order(t: Retail) -> DataFrame:
    return t.order_sales()


@_query
def sales_with_history(t: Retail) -> DataFrame:
    return ops.sales_with_history(t.sales(t.orders_since(HISTORY_END)), t.history())


@_query
def peak_sales_months(t: Retail) -> DataFrame:
    return ops.peak_sales_months(t.order_sales())


@_query
def top_customer_monthly_products(t: Retail) -> DataFrame:
    return ops.top_customer_monthly_products(t.sales(), t.products())


@_query
def customer_purchase_trend(t: Retail) -> DataFrame:
    return ops.customer_purchase_trend(t.order_sales())


@_query
def retention_rate(t: Retail) -> DataFrame:
    return ops.retention_rate(t.order_sales())


@_query
def product_mom_growth(t: Retail) -> DataFrame:
    return ops.product_mom_growth(t.sales(), t.products())


@_query
def yoy_comparison(t: Retail) -> DataFrame:
    return ops.yoy_comparison(t.sales(), t.products())


@_query
def yoy_comparison_by_family(t: Retail) -> DataFrame:
    return ops.yoy_comparison(t.family_sales(), t.families(), n=50)


@_query
def customer_segments(t: Retail) -> DataFrame:
    return ops.customer_segments(t.order_sales())


@_query
def data_quality_report(t: Retail) -> DataFrame:
    tables = {
        name: (read_footers(t.spark, f"{t.folder}/{name}.parquet"), key)
        for name, key in TABLE_KEYS.items()
    }
    tables["dirty_customers"] = (t.dirty_customers(), "customer_id")
    tables["dirty_orders"] = (t.dirty_orders(), "order_id")
    return ops.data_quality_report(tables)


LOST = "an order that cannot be read"

# Published tables and report files with what is summed over them: a key and an amount.
PUBLISHED: dict[str, tuple[str, str | None]] = {
    "customers": ("customer_id", None),
    "orders": ("order_id", "total_amount"),
    "order_items": ("order_id", "unit_price"),
    "products": ("product_id", None),
    "loginhistory": ("customer_id", None),
    "usage_history": ("customer_id", None),
    "customersupport": ("TicketID", None),
    "enterprisecampaigns": ("CustomerID", None),
    "historical_customer_sales": ("order_id", "sales_amount"),
}

REPORTS: dict[str, tuple[str, str | None]] = {
    "peak_sales_months": ("length(year_month)", "monthly_product_sales"),
    "top_customers": ("product_id * product_count", "monthly_sales"),
    "customer_purchase_trend": ("customer_id * orders_per_month", "monthly_spent"),
    "retention_rate_pct": ("retained_customers", None),
    "month_over_month_growth_pct": ("product_id * total_quantity_sold", "total_sales_amount"),
    "yoy_comparison": ("product_id * sales_month", "monthly_sales"),
    "customer_segmented": ("customer_id * purchase_count", "total_spent"),
}


def _contents(
    outputs: dict[str, DataFrame], sums: dict[str, tuple[str, str | None]]
) -> DataFrame:
    """Per output: rows, the sum of a whole-number expression, and that of an amount."""
    rows = []
    for name, df in outputs.items():
        key, amount = sums[name]
        amount = F.sum(amount).cast("decimal(38,2)") if amount else F.lit(None)
        rows.append(
            df.agg(
                F.count(F.lit(1)).alias("row_count"),
                F.sum(F.expr(key)).cast("decimal(38,0)").alias("key_sum"),
                amount.cast("decimal(38,2)").alias("amount_sum"),
            ).withColumn("output", F.lit(name))
        )
    return reduce(DataFrame.unionByName, rows)


def _kept(df: DataFrame) -> DataFrame:
    """A report of a few rows, held on the driver so that its files can be dropped."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


@_query
def rejected_values(t: Retail) -> DataFrame:
    """How many stored values of each column do not fit the sales fact."""
    history = t.dirty_history()
    types = {n: k for n, k in ops.fact_types(t.sales()).items() if n in history.columns}
    return ops.rejected_values(history, types)


@_query
def quarantined_values(t: Retail) -> DataFrame:
    """Every stored value that does not fit the sales fact, with its row and the reason.

    The result reads the staged rows, so their folder stays until the application ends.
    """
    history = t.dirty_history()
    types = {n: k for n, k in ops.fact_types(t.sales()).items() if n in history.columns}
    rejected = sift(history, types, staging_folder(t.spark)).rejected
    return rejected.select(*history.columns, F.inline("faults"))


@_query
def publish_after_failure(t: Retail) -> DataFrame:
    """What a table holds after one version, after a next one that fails, and after a third."""
    folder, database = staging_folder(t.spark), f"silver_{uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/warehouse'")

    def published(step: str, orders: DataFrame) -> DataFrame:
        try:
            publish_table(orders, f"{folder}/orders", database, "orders")
        except Exception as failure:
            if LOST not in str(failure):
                raise
        found = {"orders": t.spark.read.table(f"{database}.orders")}
        return _kept(_contents(found, PUBLISHED).withColumn("step", F.lit(step)))

    lost = F.when(F.col("order_id") % 1000 == 7, F.raise_error(F.lit(LOST)).cast("long"))
    broken = t.orders().withColumn("order_id", F.coalesce(lost, F.col("order_id")))
    steps = {"first": t.orders(), "failed": broken, "next": t.orders_since(HISTORY_END)}
    try:
        return reduce(DataFrame.unionByName, [published(*step) for step in steps.items()])
    finally:
        t.spark.sql(f"DROP DATABASE {database} CASCADE")
        drop_staged(t.spark, folder)


@_query
def csv_round_trip(t: Retail) -> DataFrame:
    """Orders written as CSV with a header and read back as text.

    The result reads the files, so their folder stays until the application ends.
    """
    path = f"{staging_folder(t.spark)}/orders"
    write_dataset(t.orders(), path, fmt="csv", options={"header": "true"})
    return read_path(t.spark, path)


@_query
def csv_malformed_lines(t: Retail) -> DataFrame:
    """Lines of a CSV file that do not fit its schema, as they are in the file.

    The result reads the staged rows, so their folder stays until the application ends.
    """
    folder = staging_folder(t.spark)
    path = f"{folder}/lines"
    key = F.col("order_id")
    lines = t.orders().select(
        F.concat_ws(
            ",",
            F.when(key % 97 == 3, F.lit("no number")).otherwise(key.cast("string")),
            F.when(key % 89 != 4, F.col("customer_id").cast("string")),
            F.col("total_amount").cast("string"),
            F.when(key % 83 == 5, F.lit("spare")),
        ).alias("value")
    )
    write_dataset(lines, path, fmt="text")
    schema = "order_id bigint, customer_id bigint, total_amount decimal(10,2)"
    found = read_path(t.spark, path, options={"header": "false"}, schema=schema, malformed="line")
    return stage(found, folder, "parsed").filter("line is not null").select("line")


def _all_sales(t: Retail) -> DataFrame:
    return ops.sales_with_history(t.sales(t.orders_since(HISTORY_END)), t.history())


@_query
def customer_purchase_trend_all_sales(t: Retail) -> DataFrame:
    return ops.customer_purchase_trend(_all_sales(t))


@_query
def product_mom_growth_all_sales(t: Retail) -> DataFrame:
    return ops.product_mom_growth(ops.sales_by_month(_all_sales(t)), t.products())


@_query
def yoy_comparison_all_sales(t: Retail) -> DataFrame:
    return ops.yoy_comparison(_all_sales(t), t.products())


def _source(t: Retail) -> Callable[[str], DataFrame]:
    """The shaped tables by the names the jobs ask for."""
    tables = {
        "customers": t.dirty_customers,
        "orders": t.dirty_orders,
        "order_items": t.order_items,
        "products": t.products,
        "loginhistory": t.logins,
        "usage_history": t.usage_history,
        "customersupport": t.support,
        "enterprisecampaigns": t.campaigns,
        "historical_customer_sales": t.history,
    }
    return lambda name: tables[name]()


@_query
def publish_passthrough(t: Retail) -> DataFrame:
    """Rows and sums of the nine tables the preprocessing job publishes, from the catalog."""
    folder, database = staging_folder(t.spark), f"silver_{uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/warehouse'")
    try:
        counts = plans.preprocessing_job(
            t.spark,
            _source(t),
            f"{folder}/silver",
            database,
            f"{folder}/audit_log",
            as_of="2000-12-31",
        )
        return _kept(
            _contents(
                {name: t.spark.read.table(f"{database}.{name}") for name in counts},
                PUBLISHED,
            )
        )
    finally:
        t.spark.sql(f"DROP DATABASE {database} CASCADE")
        drop_staged(t.spark, folder)


@_query
def sales_reports(t: Retail) -> DataFrame:
    """Rows and sums of the seven reports the sales job writes, read back.

    History is stored first, as it is wherever the job runs.
    """
    folder = staging_folder(t.spark)
    try:
        tables = {
            "orders": t.orders_since(HISTORY_END),
            "order_items": t.order_items(),
            "products": t.products(),
            "historical_customer_sales": stage(t.history(), folder, "history"),
        }
        gold = f"{folder}/gold"
        plans.sales_trends_job(t.spark, tables.__getitem__, gold, f"{folder}/audit_log")
        reports = {name: read_parquet(t.spark, f"{gold}/sales_trends/{name}") for name in REPORTS}
        return _kept(_contents(reports, REPORTS))
    finally:
        drop_staged(t.spark, folder)


@_query
def sales_months(t: Retail) -> DataFrame:
    """Five reports from kept monthly sums, after a run on all months but the last ones and
    a second run that reads those, and how many months the second run summed."""
    folder = staging_folder(t.spark)
    store, gold, log = (f"{folder}/{name}" for name in ("store", "gold", "audit_log"))
    tables = {
        "order_items": t.order_items(),
        "products": t.products(),
        "historical_customer_sales": stage(t.history(), folder, "history"),
    }
    early = t.orders_since(HISTORY_END).filter(F.col("order_date") < F.lit(LATE_MONTHS))
    try:
        plans.sales_months_job(t.spark, (tables | {"orders": early}).__getitem__, store, gold, log)
        counts = plans.sales_months_job(
            t.spark,
            (tables | {"orders": t.orders_since(HISTORY_END)}).__getitem__,
            store,
            gold,
            log,
            first=LATE_MONTHS,
        )
        reports = {name: read_parquet(t.spark, f"{gold}/sales_months/{name}") for name in counts}
        refreshed = t.spark.range(counts.months).agg(
            F.count(F.lit(1)).alias("row_count"),
            F.lit(None).cast("decimal(38,0)").alias("key_sum"),
            F.lit(None).cast("decimal(38,2)").alias("amount_sum"),
            F.lit("refreshed").alias("output"),
        )
        return _kept(_contents(reports, REPORTS).unionByName(refreshed))
    finally:
        drop_staged(t.spark, folder)


@_query
def audit_log(t: Retail) -> DataFrame:
    """What four report jobs leave in one audit log, without its clock times."""
    folder = staging_folder(t.spark)
    gold, log = f"{folder}/gold", f"{folder}/audit_log"
    tables = {
        "customers": t.customers(),
        "orders": t.orders(ORDER_SHIFT_DAYS),
        "loginhistory": t.logins(),
        "enterprisecampaigns": t.campaigns(),
        "customersupport": t.support(),
    }
    source = tables.__getitem__
    try:
        plans.churn_job(t.spark, source, gold, log, as_of="2024-01-31")
        plans.fraud_job(t.spark, source, gold, log, as_of="2024-01-31")
        plans.top_customers_job(
            t.spark, source, gold, log, as_of="2024-01-31", country_pattern="NATION_1%"
        )
        plans.engagement_job(t.spark, source, gold, log, as_of="2024-04-09")
        return _kept(read_audit_log(t.spark, log).select("job_name", "status", "record_count"))
    finally:
        drop_staged(t.spark, folder)
