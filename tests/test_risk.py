from conftest import bag, day

from shopledger import operators as ops

ORDERS = "customer_id string, order_id string, order_date date, total_amount double"
LOGINS = "customer_id string, login_date date, ip_address string"


def logins(name, count, ips, on="2024-05-20"):
    return [(name, day(on), f"10.0.0.{i % ips}") for i in range(count)]


def orders(name, count, amount, on="2024-05-20"):
    return [(name, f"{name}{i}", day(on), amount) for i in range(count)]


def test_both_limits_must_be_passed(spark):
    bought = spark.createDataFrame(
        orders("ips", 1, 6000.0)
        + orders("logins", 6, 1.0)
        + orders("poor", 5, 1000.0)
        + orders("calm", 1, 6000.0)
        + orders("stale", 1, 6000.0, on="2024-04-30")
        + orders("edge", 1, 5000.01, on="2024-05-01")
        + orders("nologin", 9, 9000.0),
        ORDERS,
    )
    seen = spark.createDataFrame(
        logins("ips", 4, 4)
        + logins("logins", 11, 1)
        + logins("poor", 20, 5)
        + logins("calm", 10, 3)
        + logins("stale", 20, 5)
        + logins("edge", 4, 4, on="2024-05-01")
        + logins("noorder", 20, 5),
        LOGINS,
    )
    found = ops.high_risk_customers(bought, seen, as_of="2024-05-31")
    assert bag(found) == [("edge",), ("ips",), ("logins",)]


def test_limits_are_parameters(spark):
    bought = spark.createDataFrame(orders("a", 1, 10.0), ORDERS)
    seen = spark.createDataFrame(logins("a", 2, 1), LOGINS)
    assert ops.high_risk_customers(bought, seen, as_of="2024-05-31").count() == 0
    found = ops.high_risk_customers(
        bought, seen, as_of="2024-05-31", max_logins=1, max_spent=9
    )
    assert bag(found) == [("a",)]


def test_text_dates(spark):
    bought = spark.createDataFrame(
        [("a", "1", "2024-05-20", 6000.0)],
        "customer_id string, order_id string, order_date string, total_amount double",
    )
    seen = spark.createDataFrame(
        [("a", "2024-05-20", str(i)) for i in range(4)],
        "customer_id string, login_date string, ip_address string",
    )
    assert bag(ops.high_risk_customers(bought, seen, as_of="2024-05-31")) == [("a",)]
