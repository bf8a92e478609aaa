from datetime import datetime
from decimal import Decimal

import pytest
from conftest import bag, day, plan, tuples
from pyspark.sql import functions as F

from shopledger import operators as ops
from shopledger.sources import SCHEMAS

ORDERS = "order_id bigint, customer_id bigint, order_date date, total_amount decimal(10,2)"
FLAT = "CustomerID bigint, Timestamp timestamp, Channel string, Action string"
TICKETS = "CustomerID bigint, TicketID bigint, Timestamp timestamp, Status string"

NOON = datetime(2024, 5, 20, 12)


def test_one_row_per_interaction(spark):
    campaigns = spark.createDataFrame(
        [
            (1, 7, (3, 4), [(10, NOON, "Email", "Opened"), (11, NOON, "Web", "Clicked")]),
            (2, 7, (0, 0), []),
            (3, 7, None, None),
        ],
        SCHEMAS["enterprisecampaigns"],
    )
    flat = ops.flatten_campaign_interactions(campaigns)
    assert flat.columns == [
        "CustomerID", "CampaignID", "Opens", "Clicks",
        "InteractionID", "Timestamp", "Channel", "Action",
    ]
    assert bag(flat) == [
        (1, 7, 3, 4, 10, NOON, "Email", "Opened"),
        (1, 7, 3, 4, 11, NOON, "Web", "Clicked"),
    ]
    kept = ops.flatten_campaign_interactions(campaigns, keep_empty=True)
    assert sorted(r.CustomerID for r in kept.collect()) == [1, 1, 2, 3]


def test_ticket_status_beside_all_columns(spark):
    tickets = spark.createDataFrame([(1, 5, NOON, ("Open",))], SCHEMAS["customersupport"])
    flat = ops.flatten_support_tickets(tickets)
    assert flat.columns == ["CustomerID", "TicketID", "Timestamp", "Issue", "Status"]
    assert flat.first().Status == "Open"


def profile_inputs(spark):
    orders = spark.createDataFrame(
        [
            (1, 1, day("2024-05-01"), Decimal("10.00")),
            (2, 1, day("2024-05-02"), Decimal("2.50")),
            (3, 2, day("2024-05-02"), Decimal("99.00")),
            (4, 1, day("2024-03-01"), Decimal("1000.00")),
            (5, None, day("2024-05-02"), Decimal("1.00")),
        ],
        ORDERS,
    )
    interactions = spark.createDataFrame(
        [
            (1, NOON, "Email", "Opened"),
            (1, NOON, "Email", "Opened"),
            (1, NOON, "Email", "Clicked"),
            (1, NOON, "Web", "Clicked"),
            (1, NOON, "App", "Opened"),
            (3, NOON, "SMS", "Opened"),
            (3, datetime(2024, 3, 1), "Email", "Opened"),
            (4, datetime(2024, 3, 2), "Email", None),
            (None, NOON, "Email", "Opened"),
        ],
        FLAT,
    )
    tickets = spark.createDataFrame(
        [
            (2, 1, NOON, "Open"),
            (2, 2, NOON, "Resolved"),
            (2, None, NOON, "Resolved"),
            (5, 3, NOON, "Pending"),
            (None, 4, NOON, "Open"),
        ],
        TICKETS,
    )
    return orders, interactions, tickets


def test_one_profile_per_customer_from_all_sources(spark):
    found = ops.omni_channel_engagement(*profile_inputs(spark), as_of="2024-05-31")
    assert found.columns == [
        "customer_id", "emails_opened", "emails_clicked", "ad_clicks", "ad_views",
        "purchases", "total_spent", "total_ticket", "open_ticket", "resolved_ticket",
    ]
    spent = Decimal
    assert tuples(found)[:3] == [
        (2, 0, 0, 0, 0, 1, spent("99.00"), 2, 1, 2),
        (1, 2, 1, 1, 1, 2, spent("12.50"), 0, 0, 0),
        (None, 0, 0, 0, 0, 1, spent("1.00"), 0, 0, 0),
    ]
    rest = [(r[0], str(r[6]), *r[1:6], *r[7:]) for r in tuples(found)[3:]]
    assert sorted(rest, key=repr) == [
        (3, "0.00", 0, 0, 0, 0, 0, 0, 0, 0),
        (4, "0.00", 0, 0, 0, 0, 0, 0, 0, 0),
        (5, "0.00", 0, 0, 0, 0, 0, 1, 0, 0),
        (None, "0.00", 0, 0, 0, 0, 0, 1, 1, 0),
        (None, "0.00", 1, 0, 0, 0, 0, 0, 0, 0),
    ]


def test_absent_sources_stay_null_on_request(spark):
    found = ops.omni_channel_engagement(
        *profile_inputs(spark), as_of="2024-05-31", zero_fill=False
    )
    by_id = {r[0]: r[1:] for r in tuples(found) if r[0] is not None}
    assert by_id[2] == (None, None, None, None, 1, Decimal("99.00"), 2, 1, 2)
    assert by_id[3] == (0, 0, 0, 0, None, None, None, None, None)
    assert by_id[5] == (None, None, None, None, None, None, 1, 0, 0)


def test_one_shuffle_per_source_and_no_join(spark):
    found = ops.omni_channel_engagement(
        *profile_inputs(spark), as_of="2024-05-31", ordered=False
    )
    text = plan(found)
    assert text.count("Exchange") == 3
    assert "Join" not in text
    assert "Sort" not in text


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_sources_of_unlike_size_meet_in_one_row(spark, conf, adaptive):
    conf(
        adaptive__enabled=adaptive,
        shuffle__partitions="16",
        adaptive__advisoryPartitionSizeInBytes="4KB",
        adaptive__coalescePartitions__minPartitionSize="4KB",
    )

    def customers(count):
        return spark.range(count * 3).select((F.col("id") % count).alias("customer_id"))

    orders = customers(20_000).select(
        "customer_id",
        F.monotonically_increasing_id().alias("order_id"),
        F.lit(day("2024-05-01")).alias("order_date"),
        F.lit(1.0).alias("total_amount"),
    )
    interactions = customers(3_000).select(
        F.col("customer_id").alias("CustomerID"),
        F.lit(NOON).alias("Timestamp"),
        F.lit("Email").alias("Channel"),
        F.lit("Opened").alias("Action"),
    )
    tickets = customers(40).select(
        F.col("customer_id").alias("CustomerID"),
        F.lit(1).alias("TicketID"),
        F.lit(NOON).alias("Timestamp"),
        F.lit("Open").alias("Status"),
    )
    found = ops.omni_channel_engagement(orders, interactions, tickets, as_of="2024-05-31")
    shapes = found.groupBy("emails_opened", "purchases", "open_ticket").count()
    assert bag(shapes) == [(0, 3, 0, 17_000), (3, 3, 0, 2_960), (3, 3, 3, 40)]


def test_ids_of_other_types_are_matched(spark):
    orders, interactions, tickets = profile_inputs(spark)
    interactions = interactions.withColumn("CustomerID", interactions.CustomerID.cast("string"))
    tickets = tickets.withColumn("CustomerID", tickets.CustomerID.cast("int"))
    found = ops.omni_channel_engagement(orders, interactions, tickets, as_of="2024-05-31")
    assert dict(found.dtypes)["customer_id"] == "bigint"
    assert found.count() == 8


def test_text_ids_meet_in_one_spelling_without_a_job(spark, tmp_path):
    orders = spark.createDataFrame([(1, 7, day("2024-01-02"), Decimal("5.00"))], ORDERS)
    interactions = spark.createDataFrame(
        [("007", day("2024-01-02"), "Email", "Opened"), ("C1", day("2024-01-02"), "Email", "Opened"),
         ("007a", day("2024-01-02"), "Web", "Opened"), ("-0", day("2024-01-02"), "Web", "Opened")],
        "CustomerID string, Timestamp date, Channel string, Action string",
    )
    tickets = spark.createDataFrame(
        [(" +7", 1, day("2024-01-02"), "Open"), (None, 2, day("2024-01-02"), "Open"),
         ("0", 3, day("2024-01-02"), "Open"), ("-007", 4, day("2024-01-02"), "Open")],
        "CustomerID string, TicketID int, Timestamp date, Status string",
    )
    interactions.write.parquet(f"{tmp_path}/i")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan", "planning")
    found = ops.omni_channel_engagement(
        orders, spark.read.parquet(f"{tmp_path}/i"), tickets, as_of="2024-01-03", text_ids=True
    )
    planned = [*tracker.getJobIdsForGroup("plan")]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(planned) <= 1  # the schema of the files
    rows = {r.customer_id: (r.emails_opened, r.ad_views, r.purchases, r.total_ticket) for r in found.collect()}
    assert rows == {
        "7": (1, 0, 1, 1), "C1": (1, 0, 0, 0), "007a": (0, 1, 0, 0), "0": (0, 1, 0, 1),
        "-7": (0, 0, 0, 1), None: (0, 0, 0, 1),
    }
