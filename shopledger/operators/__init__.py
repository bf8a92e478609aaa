"""Named transformations: functions from DataFrames to one lazy DataFrame."""

from shopledger.operators.churn import churn_risk
from shopledger.operators.cleaning import clean_customers, clean_orders, valid_customers
from shopledger.operators.engagement import (
    flatten_campaign_interactions,
    flatten_support_tickets,
    omni_channel_engagement,
)
from shopledger.operators.quality import (
    DataQualityError,
    RejectedValuesError,
    data_quality_report,
    rejected_values,
    validate_data_quality,
)
from shopledger.operators.ranking import top_customers_by_country
from shopledger.operators.risk import high_risk_customers
from shopledger.operators.sales import (
    fact_types,
    sales_by_order,
    sales_fact,
    sales_with_history,
)
from shopledger.operators.trends import (
    customer_purchase_trend,
    customer_segments,
    peak_sales_months,
    product_mom_growth,
    retention_rate,
    sales_by_month,
    top_customer_monthly_products,
    top_customers,
    yoy_comparison,
)

__all__ = [
    "DataQualityError",
    "RejectedValuesError",
    "churn_risk",
    "clean_customers",
    "clean_orders",
    "customer_purchase_trend",
    "customer_segments",
    "data_quality_report",
    "fact_types",
    "flatten_campaign_interactions",
    "flatten_support_tickets",
    "high_risk_customers",
    "omni_channel_engagement",
    "peak_sales_months",
    "product_mom_growth",
    "rejected_values",
    "retention_rate",
    "sales_by_month",
    "sales_by_order",
    "sales_fact",
    "sales_with_history",
    "top_customer_monthly_products",
    "top_customers",
    "top_customers_by_country",
    "valid_customers",
    "validate_data_quality",
    "yoy_comparison",
]
