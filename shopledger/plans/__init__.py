"""End-to-end jobs: read tables, run operators, write datasets, log the run."""

from shopledger.plans.jobs import (
    PASSTHROUGH_TABLES,
    churn_job,
    engagement_job,
    fraud_job,
    monthly_outputs,
    preprocessing_job,
    sales_months_job,
    sales_outputs,
    sales_trends_job,
    top_customers_job,
)
from shopledger.plans.months import monthly_sales, refresh_months, store_facts

__all__ = [
    "PASSTHROUGH_TABLES",
    "churn_job",
    "engagement_job",
    "fraud_job",
    "monthly_outputs",
    "monthly_sales",
    "preprocessing_job",
    "refresh_months",
    "sales_months_job",
    "sales_outputs",
    "sales_trends_job",
    "store_facts",
    "top_customers_job",
]
