"""Test tables shaped like the operators' inputs.

``Retail`` takes the Parquet directory of one scale factor. Columns the test
tables lack (email, ip, channel, ...) are derived row by row, so shaping adds no
shuffle: nothing is collected per key and no table is sampled.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.operators.sales import sales_by_order, sales_fact

# Orders end on 2001-08-01, events on 2024-01-30. This many days later, orders
# fall into the time of the events.
ORDER_SHIFT_DAYS = 8217

# Sales before this day count as history.
HISTORY_END = "1999-01-01"

# The months from here on are loaded by a run of their own.
LATE_MONTHS = date(2001, 6, 1)

FAMILIES = 20


def _id_suffix(name: str) -> Column:
    return F.split_part(F.col(name), F.lit("#"), F.lit(2))


def _choose(number: Column, *values: str | int) -> Column:
    """The value at ``number`` modulo the count of values."""
    position = (number % len(values) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(value) for value in values]), position)


@dataclass(frozen=True)
class Retail:
    spark: SparkSession
    folder: str

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    def customers(self) -> DataFrame:
        nation = self.raw("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        return (
            self.raw("customer")
            .join(nation, "c_nationkey")
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
                _id_suffix("c_name").alias("last_name"),
                F.concat(F.replace("c_name", F.lit("#"), F.lit("")), F.lit("@example.com")).alias(
                    "email"
                ),
                F.col("n_name").alias("country"),
            )
        )

    def dirty_customers(self) -> DataFrame:
        """Customers with padding, broken emails, missing ids and copies."""
        nation = self.raw("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        once = self.raw("customer")
        key, digits = F.col("c_custkey"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")
        text_key = key.cast("string")
        return (
            once.unionAll(once.filter(key % 17 == 1))
            .join(nation, "c_nationkey")
            .select(
                F.when(key % 13 != 5, key).alias("customer_id"),
                F.concat(F.lit("  "), F.split_part("c_name", F.lit("#"), F.lit(1)), F.lit(" "))
                .alias("first_name"),
                F.concat(F.lit(" "), _id_suffix("c_name")).alias("last_name"),
                F.when(key % 7 == 3, "NoAtSign.example.com")
                .when(key % 11 == 4, F.concat(F.lit("C"), text_key, F.lit("@nodot")))
                .otherwise(F.concat(F.lit(" C"), text_key, F.lit("@Example.COM ")))
                .alias("email"),
                F.concat(
                    F.lit("("), F.substring(digits, 1, 3), F.lit(") "), F.substring(digits, 4, 6)
                ).alias("phone"),
                F.concat(F.lit(" "), text_key, F.lit(" Main St ")).alias("address"),
                F.col("n_name").alias("city"),
                F.col("c_mktsegment").alias("state"),
                F.col("c_nationkey").alias("zip_code"),
                F.col("n_name").alias("country"),
            )
        )

    def orders(self, shift_days: int = 0) -> DataFrame:
        day = F.col("o_orderdate").cast("date")
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            (F.date_add(day, shift_days) if shift_days else day).alias("order_date"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").cast("decimal(10,2)").alias("total_amount"),
        )

    def dirty_orders(self) -> DataFrame:
        """Orders with missing ids and negative amounts."""
        key = F.col("order_id")
        return self.orders().select(
            F.when(key % 19 != 2, key).alias("order_id"),
            "customer_id",
            "order_date",
            "status",
            F.when(key % 23 == 3, -1.0)
            .otherwise(F.col("total_amount").cast("double"))
            .alias("total_amount"),
        )

    def order_items(self) -> DataFrame:
        """Lines priced by their own amount, which spares a join with the parts."""
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("unit_price"),
        )

    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
        )

    def logins(self) -> DataFrame:
        """Events as logins; the properties stand in for the address."""
        return self.raw("events").select(
            F.col("user_id").alias("customer_id"),
            F.col("ts").cast("date").alias("login_date"),
            F.col("props").alias("ip_address"),
        )

    def usage_history(self) -> DataFrame:
        return self.raw("events").select(
            F.col("user_id").alias("customer_id"), "event_type", "ts", "value"
        )

    def campaigns(self) -> DataFrame:
        """One campaign contact per event, with none to three interactions.

        Sign-ups have no interaction array and every tenth k an empty one.
        """
        k = F.get_json_object("props", "$.k").cast("int")
        event = F.col("event_id")

        def interaction(step: int) -> Column:
            return F.struct(
                (event * 10 + step).alias("InteractionID"),
                F.col("ts").alias("Timestamp"),
                _choose(F.floor(event / 3) + step, "Email", "Web", "App", "SMS").alias("Channel"),
                _choose(event + step, "Opened", "Clicked", "Ignored").alias("Action"),
            )

        steps = F.array(*[interaction(step) for step in range(3)])
        taken = _choose(k, 1, 2, 3, 1, 2, 3, 1, 2, 3, 0)
        return self.raw("events").select(
            F.col("user_id").alias("CustomerID"),
            (event % 5).alias("CampaignID"),
            F.struct(
                (F.col("event_type") == "view").cast("int").alias("Opens"),
                (F.col("event_type") == "click").cast("int").alias("Clicks"),
            ).alias("Engagement"),
            F.when(F.col("event_type") != "signup", F.slice(steps, F.lit(1), taken)).alias(
                "Interactions"
            ),
        )

    def support(self) -> DataFrame:
        """Events as tickets."""
        k = F.get_json_object("props", "$.k").cast("int")
        return self.raw("events").select(
            F.col("user_id").alias("CustomerID"),
            F.col("event_id").alias("TicketID"),
            F.col("ts").alias("Timestamp"),
            F.struct(_choose(k, "Open", "Resolved", "Pending").alias("Status")).alias("Issue"),
        )

    def orders_since(self, day: str) -> DataFrame:
        return self.orders().filter(F.col("order_date") >= F.lit(day).cast("date"))

    def orders_before(self, day: str) -> DataFrame:
        return self.orders().filter(F.col("order_date") < F.lit(day).cast("date"))

    def sales(self, orders: DataFrame | None = None) -> DataFrame:
        """The sales fact of all orders, or of the given ones."""
        orders = self.orders() if orders is None else orders
        return sales_fact(orders, self.order_items(), self.products())

    def order_sales(self) -> DataFrame:
        """The lines of all orders, summed per order."""
        return sales_by_order(self.orders(), self.order_items(), self.products())

    def history(self) -> DataFrame:
        """Sales before HISTORY_END in the stored form, dated by timestamps.

        Stored amounts differ from the lines' own, so that reports show whether they
        hold the stored half once.
        """
        past = self.sales(self.orders_before(HISTORY_END))
        return past.withColumns(
            {
                "order_date": F.col("order_date").cast("timestamp"),
                "sales_amount": F.col("sales_amount") + F.lit("7.25").cast("decimal(10,2)"),
            }
        )

    def dirty_history(self) -> DataFrame:
        """Stored sales as text, with commas in some amounts and letters in some ids."""
        key = F.col("order_id")
        amount, customer = (F.col(n).cast("string") for n in ("sales_amount", "customer_id"))
        return self.history().select(
            F.when(key % 31 == 5, F.concat(F.lit("C"), customer))
            .when(key % 37 != 6, customer)
            .alias("customer_id"),
            F.when(key % 29 == 4, F.replace(amount, F.lit("."), F.lit(",")))
            .otherwise(amount)
            .alias("sales_amount"),
            F.col("order_date").cast("string").alias("order_date"),
            (F.col("quantity").cast("bigint") * F.when(key % 41 == 7, 2_000_000_000).otherwise(1))
            .alias("quantity"),
        )

    def family_sales(self) -> DataFrame:
        """The fact with products grouped into 20 families, which sell every month."""
        return self.sales().withColumn("product_id", F.col("product_id") % FAMILIES)

    def families(self) -> DataFrame:
        family = (F.col("p_partkey") % FAMILIES).alias("product_id")
        return (
            self.raw("part")
            .groupBy(family)
            .agg(F.min("p_name").alias("name"), F.min("p_type").alias("category"))
        )
