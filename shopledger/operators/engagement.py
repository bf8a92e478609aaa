"""Campaign interactions, support tickets and the profile built from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.functions.casts import canonical_id, common_id_type
from shopledger.functions.dates import AsOf, in_trailing_days

# What the sources call channels, actions and ticket states.
EMAIL = "Email"
AD_CHANNELS = ["Web", "App"]
OPENED, CLICKED = "Opened", "Clicked"
OPEN_TICKET, RESOLVED_TICKET = "Open", "Resolved"

# The output columns in report order.
ENGAGEMENT_COUNTS = ["emails_opened", "emails_clicked", "ad_clicks", "ad_views"]
PURCHASE_TOTALS = ["purchases", "total_spent"]
TICKET_COUNTS = ["total_ticket", "open_ticket", "resolved_ticket"]
PROFILE_MEASURES = ENGAGEMENT_COUNTS + PURCHASE_TOTALS + TICKET_COUNTS


def flatten_campaign_interactions(campaigns: DataFrame, *, keep_empty: bool = False) -> DataFrame:
    """One row per interaction; campaigns without any vanish unless ``keep_empty``."""
    explode = F.explode_outer if keep_empty else F.explode
    return campaigns.select(
        "CustomerID",
        "CampaignID",
        "Engagement.Opens",
        "Engagement.Clicks",
        explode("Interactions").alias("interaction"),
    ).select(
        "CustomerID",
        "CampaignID",
        "Opens",
        "Clicks",
        "interaction.InteractionID",
        "interaction.Timestamp",
        "interaction.Channel",
        "interaction.Action",
    )


def flatten_support_tickets(tickets: DataFrame) -> DataFrame:
    """All ticket columns, with the issue's status beside them."""
    return tickets.select("*", "Issue.Status")


def _count_where(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def omni_channel_engagement(
    orders: DataFrame,
    interactions: DataFrame,
    tickets: DataFrame,
    *,
    as_of: AsOf = None,
    days: int = 90,
    zero_fill: bool = True,
    ordered: bool = True,
    text_ids: bool = False,
) -> DataFrame:
    """One row per customer seen in any of the three sources in the trailing window.

    ``interactions`` and ``tickets`` are flattened tables. A source that has
    nothing on a customer gives zeros, or NULLs with ``zero_fill=False``. Rows
    without a customer id match nothing, so they stay one row per source. Ids of
    different types are compared as the wider integer, or as text if one of them is
    none; telling that takes a scan of the ids that are text. With ``text_ids`` nothing is
    scanned: all ids become text, in which whole numbers have one spelling.

    Each source is reduced to one narrow row per customer (one shuffle each,
    after map-side partial counts). The three results are stacked and merged by
    a second aggregate: they are hashed on the customer alike, so it needs no
    further shuffle or sort, which a chain of full outer joins would.
    """
    keys = ((orders, "customer_id"), (interactions, "CustomerID"), (tickets, "CustomerID"))
    key_type = None if text_ids else common_id_type(keys)

    def per_customer(df: DataFrame, key: str, day: str, measures: list[Column]) -> DataFrame:
        same = canonical_id(F.col(key)) if text_ids else F.col(key).cast(key_type)
        return (
            df.filter(in_trailing_days(df, day, as_of, days))
            .groupBy(same.alias("customer_id"))
            .agg(*measures)
        )

    opened, clicked = F.col("Action") == OPENED, F.col("Action") == CLICKED
    by_email, by_ad = F.col("Channel") == EMAIL, F.col("Channel").isin(AD_CHANNELS)
    engagement = per_customer(
        interactions,
        "CustomerID",
        "Timestamp",
        [
            _count_where(opened & by_email, "emails_opened"),
            _count_where(clicked & by_email, "emails_clicked"),
            _count_where(clicked & by_ad, "ad_clicks"),
            _count_where(opened & by_ad, "ad_views"),
        ],
    )
    purchases = per_customer(
        orders,
        "customer_id",
        "order_date",
        [F.count("order_id").alias("purchases"), F.sum("total_amount").alias("total_spent")],
    )
    support = per_customer(
        tickets,
        "CustomerID",
        "Timestamp",
        [
            F.count("TicketID").alias("total_ticket"),
            _count_where(F.col("Status") == OPEN_TICKET, "open_ticket"),
            _count_where(F.col("Status") == RESOLVED_TICKET, "resolved_ticket"),
        ],
    )

    sources = [
        df.withColumn("source", F.lit(position))
        for position, df in enumerate([engagement, purchases, support])
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
    unknown_from = F.when(F.col("customer_id").isNull(), F.col("source")).alias("unknown_from")
    profile = (
        stacked.groupBy("customer_id", unknown_from)
        .agg(*[F.max(name).alias(name) for name in PROFILE_MEASURES])
        .drop("unknown_from")
    )
    if zero_fill:
        zeros = [
            F.coalesce(f.name, F.lit(0).cast(f.dataType)).alias(f.name)
            for f in profile.select(*PROFILE_MEASURES).schema
        ]
        profile = profile.select("customer_id", *zeros)
    if not ordered:
        return profile
    # Most customers may share one total (0 or NULL): the id splits that value.
    return profile.orderBy(F.desc("total_spent"), "customer_id")
