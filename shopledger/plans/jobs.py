"""The six batch jobs.

Each takes a ``source`` (a function from table name to DataFrame, see
``sources.reading``), output and audit locations, and a report date. The date is
fixed once per job, so a run across midnight stays consistent. Every run, also
a failed one, leaves a row in the audit log.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shopledger import operators as ops
from shopledger.functions.casts import Types, lost_count
from shopledger.functions.dates import AsOf, as_of_date, dated, month_column, with_month
from shopledger.operators.cleaning import ORDER_TYPES
from shopledger.plans import months
from shopledger.session import input_bytes_of, sized, tune
from shopledger.sources.audit import write_audit_log
from shopledger.sources.quarantine import sift
from shopledger.sources.reading import Source
from shopledger.sources.staging import drop_staged, stage, staging_folder
from shopledger.sources.writing import (
    publish_table,
    side_by_side,
    write_dataset,
    write_datasets,
)

# Tables that go from raw to cleaned unchanged.
PASSTHROUGH_TABLES = [
    "order_items",
    "products",
    "loginhistory",
    "usage_history",
    "customersupport",
    "enterprisecampaigns",
    "historical_customer_sales",
]

SALES_TABLES = ["orders", "order_items", "products", "historical_customer_sales"]


class Counts(dict[str, int]):
    """Row counts by output; ``rejected`` is how many input values did not fit, ``months``
    how many months' sums were made anew."""

    rejected = 0
    months = 0


REJECTED = "rejected_values"

# Session setting: the id of a run, kept over retries.
RUN_ID = "spark.shopledger.runId"


def _audited(
    spark: SparkSession,
    job_name: str,
    audit_path: str,
    counted: str,
    run: Callable[[], Counts],
    tables: Callable[[], list[DataFrame]],
    input_bytes: int | None,
) -> Counts:
    """Runs a job, sized for its input, and logs it with the row count of ``counted``.

    The run's id is that of the setting ``RUN_ID``, if there is one; a scheduler that starts
    a job again with the same id leaves one row in the log.

    Without ``input_bytes`` the size is that of the job's ``tables`` by statistics.
    """
    tune(spark)
    start, run_id = datetime.now(), spark.conf.get(RUN_ID, None)
    run_id = run_id and f"{run_id}/{job_name}"
    try:
        size = input_bytes_of(tables()) if input_bytes is None else input_bytes
        with sized(spark, size):
            counts = run()
    except Exception as failure:
        try:
            write_audit_log(spark, audit_path, job_name, "FAILURE", 0, start, datetime.now(), run_id)
        except Exception as unlogged:
            failure.add_note(f"the failure could not be logged: {unlogged}")
        raise
    write_audit_log(
        spark, audit_path, job_name, "SUCCESS", counts[counted], start, datetime.now(), run_id
    )
    return counts


def _fixed_date(spark: SparkSession, as_of: AsOf):
    return spark.range(1).select(as_of_date(as_of)).first()[0]


def _checked(found: int, accepted: int) -> int:
    if found > accepted:
        raise ops.RejectedValuesError(f"{found} values do not fit, {accepted} are accepted")
    return found


@dataclass(frozen=True)
class _Raw:
    """Raw rows, and how many of their values do not fit, which is known once read."""

    rows: DataFrame
    rejected: Callable[[], int]


@contextmanager
def _raw(
    spark: SparkSession, df: DataFrame, types: Types, quarantine: str | None, accepted: int
) -> Iterator[_Raw]:
    """``df`` with a count of its misfits, more than ``accepted`` of which are an error.

    They are counted while ``df`` is read. With ``quarantine`` it is read into a staged
    table first, whose rejected rows go there before anything else is done.
    """
    if quarantine is None:
        seen = Observation()
        counted = df.observe(seen, lost_count(types).alias(REJECTED))
        yield _Raw(counted, lambda: _checked(seen.get[REJECTED], accepted))
        return
    folder = staging_folder(spark)
    try:
        found = sift(df, types, folder)
        write_dataset(found.rejected, quarantine, versioned=True)
        _checked(found.values, accepted)
        yield _Raw(found.rows, lambda: found.values)
    finally:
        drop_staged(spark, folder)


def preprocessing_job(
    spark: SparkSession,
    source: Source,
    output: str,
    database: str,
    audit_path: str,
    *,
    as_of: AsOf = None,
    max_rejected: int = 0,
    quarantine: str | None = None,
    by_month: Mapping[str, str] | None = None,
    input_bytes: int | None = None,
) -> Counts:
    """Cleans customers and orders, and publishes them and the other tables in ``database``.

    Orders are checked against the customers table just written, so cleaning
    runs once. Amounts that do not fit are counted meanwhile; more than ``max_rejected``
    fail the job. With ``quarantine`` their orders are first written there, with reasons.
    ``by_month`` maps tables to a date column: these are published in folders by its month,
    of which the reports on trailing windows read the recent ones.
    """
    by_month = by_month or {}

    def publish(df: DataFrame, table: str, folder: str) -> int:
        parts = []
        if table in by_month:
            df = with_month(df, by_month[table])
            parts = [month_column(by_month[table])]
        return publish_table(df, f"{output}/{folder}", database, table, partition_by=parts)

    def run() -> Counts:
        customers = ops.clean_customers(source("customers"))
        counts = Counts(customers=publish(customers, "customers", "customers_clean"))
        known = spark.read.table(f"{database}.customers")
        with _raw(spark, source("orders"), ORDER_TYPES, quarantine, max_rejected) as raw:
            orders = ops.clean_orders(raw.rows, known, as_of=_fixed_date(spark, as_of))
            counts["orders"] = publish(orders, "orders", "orders_clean")
            counts.rejected = raw.rejected()
        counts.update(
            side_by_side(lambda table: publish(source(table), table, table), PASSTHROUGH_TABLES)
        )
        return counts

    return _audited(
        spark,
        "preprocessing",
        audit_path,
        "customers",
        run,
        lambda: [source(name) for name in ("customers", "orders", *PASSTHROUGH_TABLES)],
        input_bytes,
    )


def _report_job(
    spark: SparkSession,
    job_name: str,
    output: str,
    audit_path: str,
    build: Callable[[], DataFrame],
    tables: Callable[[], list[DataFrame]],
    input_bytes: int | None,
) -> Counts:
    def run() -> Counts:
        return Counts({job_name: write_dataset(build(), f"{output}/{job_name}")})

    return _audited(spark, job_name, audit_path, job_name, run, tables, input_bytes)


def churn_job(
    spark: SparkSession,
    source: Source,
    output: str,
    audit_path: str,
    *,
    as_of: AsOf = None,
    input_bytes: int | None = None,
) -> Counts:
    """Churn risk per customer."""
    return _report_job(
        spark,
        "churn_risk",
        output,
        audit_path,
        lambda: ops.churn_risk(source("orders"), as_of=_fixed_date(spark, as_of)),
        lambda: [source("orders")],
        input_bytes,
    )


def fraud_job(
    spark: SparkSession,
    source: Source,
    output: str,
    audit_path: str,
    *,
    as_of: AsOf = None,
    input_bytes: int | None = None,
) -> Counts:
    """Ids of high-risk customers."""
    return _report_job(
        spark,
        "high_risk_customers",
        output,
        audit_path,
        lambda: ops.high_risk_customers(
            source("orders"), source("loginhistory"), as_of=_fixed_date(spark, as_of)
        ),
        lambda: [source("orders"), source("loginhistory")],
        input_bytes,
    )


def top_customers_job(
    spark: SparkSession,
    source: Source,
    output: str,
    audit_path: str,
    *,
    as_of: AsOf = None,
    country_pattern: str = "United %",
    input_bytes: int | None = None,
) -> Counts:
    """Top customers by country."""
    return _report_job(
        spark,
        "top_customers_by_country",
        output,
        audit_path,
        lambda: ops.top_customers_by_country(
            source("orders"),
            source("customers"),
            as_of=_fixed_date(spark, as_of),
            country_pattern=country_pattern,
        ),
        lambda: [source("orders"), source("customers")],
        input_bytes,
    )


def engagement_job(
    spark: SparkSession,
    source: Source,
    output: str,
    audit_path: str,
    *,
    as_of: AsOf = None,
    input_bytes: int | None = None,
) -> Counts:
    """Omni-channel profile per customer."""
    return _report_job(
        spark,
        "omni_channel_engagement",
        output,
        audit_path,
        lambda: ops.omni_channel_engagement(
            source("orders"),
            ops.flatten_campaign_interactions(source("enterprisecampaigns")),
            ops.flatten_support_tickets(source("customersupport")),
            as_of=_fixed_date(spark, as_of),
        ),
        lambda: [source("orders"), source("enterprisecampaigns"), source("customersupport")],
        input_bytes,
    )


def sales_outputs(
    sales: DataFrame,
    current: DataFrame,
    products: DataFrame,
    top: DataFrame | None = None,
    *,
    monthly: DataFrame | None = None,
    ordered: bool = True,
) -> dict[str, DataFrame]:
    """The seven sales reports by output name.

    ``sales`` holds current and historical sales, ``current`` only the current
    ones (segments look at those), ``top`` an already computed top-customer list,
    ``monthly`` an already computed ``sales_by_month`` of ``sales``, from which all
    reports but the trend and the segments then come. ``ordered=False`` leaves the
    two large reports unsorted.
    """
    by_month = monthly_outputs(sales if monthly is None else monthly, products, top, ordered=ordered)
    return by_month | {
        "customer_purchase_trend": ops.customer_purchase_trend(sales, ordered=ordered),
        "customer_segmented": ops.customer_segments(current),
    }


def monthly_outputs(
    monthly: DataFrame, products: DataFrame, top: DataFrame | None = None, *, ordered: bool = True
) -> dict[str, DataFrame]:
    """The five sales reports that monthly sums are enough for, by output name."""
    return {
        "peak_sales_months": ops.peak_sales_months(monthly),
        "top_customers": ops.top_customer_monthly_products(monthly, products, top=top),
        "retention_rate_pct": ops.retention_rate(monthly),
        "month_over_month_growth_pct": ops.product_mom_growth(monthly, products, ordered=ordered),
        "yoy_comparison": ops.yoy_comparison(monthly, products, top=top),
    }


def sales_trends_job(
    spark: SparkSession,
    source: Source,
    output: str,
    audit_path: str,
    *,
    job_name: str = "sales_trends",
    ordered: bool = True,
    max_rejected: int = 0,
    quarantine: str | None = None,
    input_bytes: int | None = None,
) -> Counts:
    """The seven sales reports.

    The current fact is joined once and staged on shared storage. One scan of current
    and historical sales sums them by month, one more makes the purchase trend; the
    other reports and the top list they share come from the monthly sums. Historical
    values that do not fit the fact are counted in the first scan; more than
    ``max_rejected`` fail the job before a report is written. With ``quarantine`` their rows
    are written there, with reasons, in any case.
    """

    def run() -> Counts:
        folder = staging_folder(spark)
        try:
            fact = ops.sales_fact(source("orders"), source("order_items"), source("products"))
            current = stage(fact, folder, "sales")
            stored, types = source("historical_customer_sales"), ops.fact_types(current)
            with _raw(spark, stored, types, quarantine, max_rejected) as raw:
                sums = ops.sales_by_month(ops.sales_with_history(current, raw.rows))
                monthly = stage(sums, folder, "sales_by_month")
                rejected = raw.rejected()
                history = stored if quarantine is None else raw.rows
                sales = ops.sales_with_history(current, history)
                top = stage(ops.top_customers(monthly), folder, "top_customers")
                reports = sales_outputs(
                    sales, current, source("products"), top, monthly=monthly, ordered=ordered
                )
                counts = Counts(write_datasets(reports, f"{output}/{job_name}"))
            counts.rejected = rejected
            return counts
        finally:
            drop_staged(spark, folder)

    return _audited(
        spark,
        job_name,
        audit_path,
        "customer_segmented",
        run,
        lambda: [source(name) for name in SALES_TABLES],
        input_bytes,
    )


def sales_months_job(
    spark: SparkSession,
    source: Source,
    store: str,
    output: str,
    audit_path: str,
    *,
    first: date | None = None,
    last: date | None = None,
    job_name: str = "sales_months",
    ordered: bool = True,
    max_rejected: int = 0,
    quarantine: str | None = None,
    input_bytes: int | None = None,
) -> Counts:
    """Five sales reports from monthly sums that are kept under ``store`` (see ``months``).

    A run with ``first`` or ``last`` loads the orders of those months only and sums the
    months whose facts changed; the reports are made from all months' sums. A run without
    loads all orders, and the historical sales, whose misfits are treated as in
    ``sales_trends_job``. ``months`` of the result counts the months that were summed.
    """

    def run() -> Counts:
        if first is None and last is None:
            fact = ops.sales_fact(source("orders"), source("order_items"), source("products"))
            months.store_facts(fact, store, first=date.min, last=date.max)
            stored, types = source("historical_customer_sales"), ops.fact_types(fact)
            with _raw(spark, stored, types, quarantine, max_rejected) as raw:
                months.store_facts(
                    raw.rows, store, origin="history", first=date.min, last=date.max
                )
                rejected = raw.rejected()
        else:
            orders, day = source("orders"), dated(source("orders"), "order_date")
            if first is not None:
                orders = orders.filter(day >= F.lit(first.replace(day=1)))
            if last is not None:
                orders = orders.filter(day < F.add_months(F.lit(last.replace(day=1)), 1))
            fact = ops.sales_fact(orders, source("order_items"), source("products"))
            months.store_facts(fact, store, first=first, last=last)
            rejected = 0
        summed = months.refresh_months(spark, store)
        monthly = months.monthly_sales(spark, store)
        folder = staging_folder(spark)
        try:
            top = stage(ops.top_customers(monthly), folder, "top_customers")
            reports = monthly_outputs(monthly, source("products"), top, ordered=ordered)
            counts = Counts(write_datasets(reports, f"{output}/{job_name}"))
        finally:
            drop_staged(spark, folder)
        counts.rejected, counts.months = rejected, len(summed)
        return counts

    return _audited(
        spark,
        job_name,
        audit_path,
        "peak_sales_months",
        run,
        lambda: [source(name) for name in SALES_TABLES],
        input_bytes,
    )
