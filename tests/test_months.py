"""Monthly sums that are kept: only months whose facts changed are read again."""

import os
from datetime import date
from decimal import Decimal as D

import pytest
from conftest import bag, day

from shopledger import operators as ops
from shopledger import plans
from shopledger.operators.sales import SALES_COLUMNS

SALES = (
    "order_id bigint, customer_id bigint, order_date date, product_id bigint, quantity int, "
    "unit_price decimal(10,2), sales_amount decimal(21,2), order_year int, order_month int"
)


def sales(spark, *lines):
    """Lines of (order, customer, day or None, product, amount)."""
    rows = [
        (o, c, d and day(d), p, 1, D(a), D(a), d and int(d[:4]), d and int(d[5:7]))
        for o, c, d, p, a in lines
    ]
    return spark.createDataFrame(rows, SALES).select(*SALES_COLUMNS)


FIRST = [
    (1, 1, "2023-01-05", 10, "5"), (2, 1, "2023-02-06", 10, "7"), (3, 2, "2023-02-28", 11, "1"),
    (4, 2, None, 11, "3"), (5, None, "2023-01-31", 10, "2"),
]


def equal_to_full(spark, root, lines):
    kept, full = plans.monthly_sales(spark, root), ops.sales_by_month(sales(spark, *lines))
    assert bag(kept.select(*full.columns)) == bag(full)


def test_only_changed_months_are_read(spark, tmp_path):
    root = str(tmp_path)
    found = plans.store_facts(sales(spark, *FIRST), root)
    assert found == [None, date(2023, 1, 1), date(2023, 2, 1)]
    assert plans.refresh_months(spark, root) == [date(2023, 1, 1), date(2023, 2, 1), None]
    equal_to_full(spark, root, FIRST)
    assert plans.refresh_months(spark, root) == []
    # Facts of unchanged months become unreadable: a second run must not touch them.
    for file in (tmp_path / "facts").rglob("*.parquet"):
        status = file.stat()
        file.write_bytes(b"x" * status.st_size)
        os.utime(file, ns=(status.st_atime_ns, status.st_mtime_ns))
    for crc in (tmp_path / "facts").rglob(".*.crc"):
        crc.unlink()
    late = [(6, 1, "2023-03-01", 10, "4"), (7, 3, "2023-03-31", 10, "4")]
    plans.store_facts(sales(spark, *late), root, first=date(2023, 3, 1))
    assert plans.refresh_months(spark, root) == [date(2023, 3, 1)]
    equal_to_full(spark, root, FIRST + late)


def test_reloaded_emptied_and_added_months(spark, tmp_path):
    root = str(tmp_path)
    plans.store_facts(sales(spark, *FIRST), root)
    plans.store_facts(sales(spark, (90, 9, "2023-02-01", 12, "8")), root, origin="history")
    plans.refresh_months(spark, root)
    equal_to_full(spark, root, [*FIRST, (90, 9, "2023-02-01", 12, "8")])
    # All of February's and January's current facts: January has none left.
    again = [(2, 1, "2023-02-06", 10, "70")]
    plans.store_facts(sales(spark, *again), root, first=date(2023, 1, 9), last=date(2023, 2, 3))
    assert plans.refresh_months(spark, root) == [date(2023, 2, 1)]
    equal_to_full(spark, root, [FIRST[3], *again, (90, 9, "2023-02-01", 12, "8")])


def test_a_failed_refresh_is_made_up_for(spark, tmp_path, monkeypatch):
    from shopledger.plans import months

    root = str(tmp_path)
    plans.store_facts(sales(spark, *FIRST), root)
    with monkeypatch.context() as broken:
        broken.setattr(months, "_replace", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            plans.refresh_months(spark, root)
    assert len(plans.refresh_months(spark, root)) == 3
    equal_to_full(spark, root, FIRST)


def test_reports_equal_a_full_run(spark, tmp_path):
    root = str(tmp_path)
    lines = [
        (i, i % 7, f"20{20 + i % 4}-{1 + i % 12:02d}-{1 + i % 28:02d}", i % 5, str(1 + i % 9))
        for i in range(400)
    ]
    plans.store_facts(sales(spark, *lines[:300]), root, origin="history")
    plans.refresh_months(spark, root)
    plans.store_facts(sales(spark, *lines[300:]), root)
    plans.refresh_months(spark, root)
    products = spark.createDataFrame(
        [(p, f"n{p}", "c") for p in range(5)], "product_id bigint, name string, category string"
    )
    kept = plans.monthly_outputs(plans.monthly_sales(spark, root), products)
    full = plans.monthly_outputs(sales(spark, *lines), products)
    for name in full:
        assert bag(kept[name]) == bag(full[name]), name
        assert kept[name].dtypes == full[name].dtypes
