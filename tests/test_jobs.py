from decimal import Decimal as D

import pytest
from conftest import bag, day
from pyspark.sql import functions as F

from shopledger import plans
from shopledger.queries.adapters import Retail
from shopledger.queries.registry import _source
from shopledger.sources import SCHEMAS, catalog_source, read_audit_log, read_parquet

FOLDER = "/root/testdata/sf0.001"


def log_rows(spark, path):
    return [
        (r.job_name, r.status, r.record_count) for r in read_audit_log(spark, path).collect()
    ]


@pytest.fixture
def silver(spark, tmp_path):
    """The catalog database the preprocessing job fills."""
    spark.sql("CREATE DATABASE IF NOT EXISTS silver")
    counts = plans.preprocessing_job(
        spark,
        _source(Retail(spark, FOLDER)),
        f"{tmp_path}/silver",
        "silver",
        f"{tmp_path}/log",
        as_of="2000-12-31",
    )
    return counts


def test_preprocessing_publishes_nine_tables(spark, silver, tmp_path):
    assert set(silver) == {"customers", "orders", *plans.PASSTHROUGH_TABLES}
    for table, count in silver.items():
        assert spark.read.table(f"silver.{table}").count() == count > 0
    assert read_parquet(spark, f"{tmp_path}/silver/customers_clean").count() == silver["customers"]
    assert log_rows(spark, f"{tmp_path}/log") == [
        ("preprocessing", "SUCCESS", silver["customers"])
    ]
    customers = spark.read.table("silver.customers")
    orphans = spark.read.table("silver.orders").join(customers, "customer_id", "left_anti")
    assert orphans.count() == 0


def test_report_jobs_read_what_preprocessing_published(spark, silver, tmp_path):
    source, gold, log = catalog_source(spark, "silver"), f"{tmp_path}/gold", f"{tmp_path}/log"
    found = [
        plans.churn_job(spark, source, gold, log, as_of="2001-01-01"),
        plans.top_customers_job(
            spark, source, gold, log, as_of="2000-12-31", country_pattern="NATION_%"
        ),
        plans.fraud_job(spark, source, gold, log, as_of="2024-01-31"),
        plans.engagement_job(spark, source, gold, log, as_of="2024-01-31"),
        plans.sales_trends_job(spark, source, gold, log),
    ]
    for counts in found[:4]:
        for name, count in counts.items():
            assert read_parquet(spark, f"{gold}/{name}").count() == count
    reports = found[4]
    assert len(reports) == 7
    for name, count in reports.items():
        assert read_parquet(spark, f"{gold}/sales_trends/{name}").count() == count > 0
    assert [row[:2] for row in log_rows(spark, log)] == [
        ("preprocessing", "SUCCESS"),
        ("churn_risk", "SUCCESS"),
        ("top_customers_by_country", "SUCCESS"),
        ("high_risk_customers", "SUCCESS"),
        ("omni_channel_engagement", "SUCCESS"),
        ("sales_trends", "SUCCESS"),
    ]


def orders(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMAS["orders"])


def test_log_survives_runs_that_overwrite_the_output(spark, tmp_path):
    source = {
        "orders": orders(
            spark,
            (1, 1, day("2024-01-01"), "F", D("1")),
            (2, 1, day("2024-01-02"), "F", D("1")),
        )
    }.__getitem__
    for _ in range(2):
        plans.churn_job(spark, source, f"{tmp_path}/gold", f"{tmp_path}/log", as_of="2024-03-01")
    assert log_rows(spark, f"{tmp_path}/log") == [("churn_risk", "SUCCESS", 1)] * 2
    assert read_parquet(spark, f"{tmp_path}/gold/churn_risk").count() == 1


def test_a_retried_run_leaves_one_row(spark, tmp_path):
    source = {"orders": orders(spark, (1, 1, day("2024-01-01"), "F", D("1")))}
    gold, log = f"{tmp_path}/gold", f"{tmp_path}/log"
    spark.conf.set(plans.jobs.RUN_ID, "nightly-7")
    try:
        with pytest.raises(KeyError):
            plans.churn_job(spark, {}.__getitem__, gold, log)
        for _ in range(2):
            plans.churn_job(spark, source.__getitem__, gold, log, as_of="2024-03-01")
    finally:
        spark.conf.unset(plans.jobs.RUN_ID)
    assert log_rows(spark, log) == [("churn_risk", "SUCCESS", 0)]


def test_failure_is_logged_and_raised(spark, tmp_path):
    with pytest.raises(KeyError, match="orders"):
        plans.churn_job(spark, {}.__getitem__, f"{tmp_path}/gold", f"{tmp_path}/log")
    assert log_rows(spark, f"{tmp_path}/log") == [("churn_risk", "FAILURE", 0)]


def test_failure_while_running_is_logged(spark, tmp_path):
    broken = orders(spark, (1, 1, day("2024-01-01"), "F", D("1"))).withColumn(
        "order_id", F.raise_error(F.lit("lost input")).cast("bigint")
    )
    with pytest.raises(Exception, match="lost input"):
        plans.churn_job(spark, lambda _: broken, f"{tmp_path}/gold", f"{tmp_path}/log")
    assert log_rows(spark, f"{tmp_path}/log") == [("churn_risk", "FAILURE", 0)]


def test_unloggable_failure_keeps_its_own_error(spark, tmp_path):
    (tmp_path / "log").write_text("not a folder")
    with pytest.raises(KeyError) as caught:
        plans.fraud_job(spark, {}.__getitem__, f"{tmp_path}/gold", f"{tmp_path}/log")
    assert "could not be logged" in caught.value.__notes__[0]


def test_sales_job_leaves_no_staged_data(spark, silver, tmp_path):
    from pathlib import Path

    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    plans.sales_trends_job(
        spark, catalog_source(spark, "silver"), f"{tmp_path}/gold", f"{tmp_path}/log"
    )
    assert set(shared.iterdir()) == before


def test_outputs_equal_the_operators_on_the_whole_fact(spark, silver, tmp_path):
    from shopledger import operators as ops

    source = catalog_source(spark, "silver")
    plans.sales_trends_job(spark, source, f"{tmp_path}/gold", f"{tmp_path}/log")
    current = ops.sales_fact(source("orders"), source("order_items"), source("products"))
    sales = ops.sales_with_history(current, source("historical_customer_sales"))
    for name, df in plans.sales_outputs(sales, current, source("products")).items():
        assert bag(read_parquet(spark, f"{tmp_path}/gold/sales_trends/{name}")) == bag(df), name


def test_fact_is_read_once_for_all_monthly_reports(spark, silver, tmp_path, monkeypatch):
    """Besides the staged sums, the fact is scanned for the trend and for the segments."""
    from shopledger.plans import jobs

    seen = {}

    def outputs(sales, current, products, top, *, monthly, ordered):
        found = real(sales, current, products, top, monthly=monthly, ordered=ordered)
        for name, df in found.items():
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            seen[name] = "unit_price" in plan or "order_id" in plan
        return found

    real = jobs.sales_outputs
    monkeypatch.setattr(jobs, "sales_outputs", outputs)
    plans.sales_trends_job(
        spark, catalog_source(spark, "silver"), f"{tmp_path}/gold", f"{tmp_path}/log"
    )
    assert {name for name, reads in seen.items() if reads} == {
        "customer_purchase_trend", "customer_segmented",
    }


def test_rejected_rows_can_be_read_back(spark, tmp_path):
    t = Retail(spark, FOLDER)
    tables = {
        "orders": t.orders(), "order_items": t.order_items(), "products": t.products(),
        "historical_customer_sales": t.sales().withColumns(
            {n: F.lit(None).cast(k) for n, k in t.sales().dtypes if n not in t.dirty_history().columns}
        ).select("order_id", "product_id", "unit_price", "order_year", "order_month").limit(0)
        .unionByName(t.dirty_history(), allowMissingColumns=True),
    }
    gold, log, apart = (f"{tmp_path}/{n}" for n in ("gold", "log", "apart"))
    with pytest.raises(plans.jobs.ops.RejectedValuesError):
        plans.sales_trends_job(spark, tables.__getitem__, gold, log, quarantine=apart)
    assert not (tmp_path / "gold").exists()
    first = read_parquet(spark, apart)
    n_values = first.select(F.sum(F.size("faults"))).first()[0]
    assert n_values > first.count() > 0
    counts = plans.sales_trends_job(
        spark, tables.__getitem__, gold, log, quarantine=apart, max_rejected=n_values
    )
    assert counts.rejected == n_values
    plain = plans.sales_trends_job(
        spark, tables.__getitem__, f"{gold}_plain", log, max_rejected=n_values
    )
    assert dict(plain) == dict(counts) and plain.rejected == n_values
    for name in counts:
        one, two = (read_parquet(spark, f"{g}/sales_trends/{name}") for g in (gold, f"{gold}_plain"))
        assert bag(one) == bag(two), name


def test_rejected_orders_are_kept_apart(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS apart")
    shaped = _source(Retail(spark, FOLDER))
    odd = shaped("orders").withColumn(
        "total_amount",
        F.when(F.col("customer_id") % 5 == 1, "1e30").otherwise(F.col("total_amount").cast("string")),
    )
    counts = plans.preprocessing_job(
        spark, lambda name: odd if name == "orders" else shaped(name), f"{tmp_path}/silver", "apart",
        f"{tmp_path}/log", as_of="2000-12-31", max_rejected=10**9, quarantine=f"{tmp_path}/q",
    )
    kept = read_parquet(spark, f"{tmp_path}/q")
    assert counts.rejected == kept.count() == odd.filter("total_amount = '1e30'").count() > 0
    reasons = {tuple(r) for r in kept.select(F.inline("faults")).distinct().collect()}
    assert reasons == {("total_amount", "1e30", "out of the range of decimal(10,2)")}
