from datetime import datetime
from decimal import Decimal as D

import pytest
from conftest import bag, day
from pyspark.sql import functions as F

from shopledger import sources
from shopledger.operators import customer_segments


def test_csv_by_default_with_header_as_text(spark, tmp_path):
    path = f"{tmp_path}/orders"
    rows = [(1, day("2024-01-02"), D("3.50"))]
    df = spark.createDataFrame(rows, "order_id bigint, order_date date, total_amount decimal(10,2)")
    assert sources.write_dataset(df, path, fmt="csv", options={"header": "true"}) == 1
    assert bag(sources.read_path(spark, path)) == [("1", "2024-01-02", "3.50")]
    typed = sources.read_path(spark, path, schema=df.schema)
    assert bag(typed) == rows


def test_malformed_lines_are_shown(spark, tmp_path):
    (tmp_path / "orders.csv").write_text("id,day,amount\n1,2024-01-02,3.50\nx,2024-01-02,1\n2,2024-01-03\n3,,7,8\n")
    found = sources.read_path(
        spark, f"{tmp_path}/orders.csv", schema="id int, day date, amount decimal(10,2)", malformed="line"
    )
    assert found.columns == ["id", "day", "amount", "line"]
    assert sorted(r.line for r in found.collect() if r.line) == ["2,2024-01-03", "3,,7,8", "x,2024-01-02,1"]
    assert [r.id for r in found.collect() if not r.line] == [1]
    with pytest.raises(ValueError, match="schema"):
        sources.read_path(spark, f"{tmp_path}/orders.csv", malformed="line")


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_other_formats(spark, tmp_path, fmt):
    assert sources.write_dataset(spark.range(3), f"{tmp_path}/t", fmt=fmt) == 3
    assert bag(sources.read_path(spark, f"{tmp_path}/t", fmt)) == [(0,), (1,), (2,)]


def test_conform_types_untyped_rows(spark):
    raw = spark.createDataFrame(
        [("7", "x", "2", "1.5", "spare")],
        "order_id string, product_id string, quantity string, unit_price string, other string",
    )
    shaped = sources.conform(raw, "order_items")
    assert shaped.dtypes == [
        ("order_id", "bigint"), ("product_id", "bigint"), ("quantity", "int"),
        ("unit_price", "decimal(10,2)"),
    ]
    assert bag(shaped) == [(7, None, 2, D("1.50"))]
    with pytest.raises(Exception, match="unit_price"):
        sources.conform(raw.drop("unit_price"), "order_items")


@pytest.mark.parametrize("table", sorted(sources.SCHEMAS))
def test_every_schema_parses(spark, table):
    empty = spark.createDataFrame([], sources.SCHEMAS[table])
    assert sources.conform(empty, table).schema == empty.schema


def test_overwrite_append_and_counts(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert sources.write_dataset(spark.range(3), path) == 3
    assert sources.write_dataset(spark.range(2), path, mode="append") == 2
    assert sources.read_parquet(spark, path).count() == 5
    assert sources.write_dataset(spark.range(1), path) == 1
    assert sources.read_parquet(spark, path).count() == 1


def test_an_empty_result_counts_zero(spark, tmp_path):
    empty = spark.range(10).filter("id > 99").groupBy("id").count().orderBy("id")
    assert sources.write_dataset(empty, f"{tmp_path}/t") == 0
    assert sources.read_parquet(spark, f"{tmp_path}/t").count() == 0


def test_a_missing_value_in_a_filter_that_folds_to_nothing(spark, tmp_path):
    nothing = spark.range(10).filter(F.lit(False))
    assert sources.write_dataset(nothing, f"{tmp_path}/t") == 0


def test_partitioned_output(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("part"))
    assert sources.write_dataset(df, f"{tmp_path}/t", partition_by=["part"]) == 100
    back = sources.read_parquet(spark, f"{tmp_path}/t")
    assert back.filter("part = 1").count() == 33
    assert {p.name for p in (tmp_path / "t").glob("part=*")} == {"part=0", "part=1", "part=2"}


def test_published_table_is_external_and_readable_both_ways(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS published")
    path = f"{tmp_path}/numbers"
    assert sources.publish_table(spark.range(3), path, "published", "numbers") == 3
    assert sources.publish_table(spark.range(4), path, "published", "numbers") == 4
    assert sources.read_table(spark, "numbers", "published").count() == 4
    assert sources.catalog_source(spark, "published")("numbers").count() == 4
    assert sources.directory_source(spark, str(tmp_path))("numbers").count() == 4
    (kind,) = spark.sql("DESCRIBE EXTENDED published.numbers").filter(
        "col_name = 'Type'"
    ).select("data_type").first()
    assert kind == "EXTERNAL"


def failing(spark):
    """Rows of which a late one cannot be made, after files of others were written."""
    lost = F.when(F.col("id") == 999, F.raise_error(F.lit("lost input")).cast("bigint"))
    return spark.range(0, 1000, 1, 4).select(F.coalesce(lost, F.col("id")).alias("id"))


def test_a_failing_overwrite_leaves_the_table_readable(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS published")
    path = f"{tmp_path}/stable"
    sources.publish_table(spark.range(3), path, "published", "stable")
    begun = sources.read_table(spark, "stable", "published")
    for _ in range(2):
        with pytest.raises(Exception, match="lost input"):
            sources.publish_table(failing(spark), path, "published", "stable")
        assert bag(sources.read_table(spark, "stable", "published")) == [(0,), (1,), (2,)]
        assert sources.read_parquet(spark, path).count() == 3
    assert len(list((tmp_path / "stable/_versions").iterdir())) == 1
    sources.publish_table(spark.range(7), path, "published", "stable")
    assert begun.count() == 3
    assert sources.read_table(spark, "stable", "published").count() == 7
    assert sources.read_parquet(spark, path).count() == 7


def test_a_killed_write_is_not_seen_and_old_versions_go(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS published")
    path = f"{tmp_path}/killed"
    sources.publish_table(spark.range(1), path, "published", "killed")
    # What a job that was killed in its write leaves: files without a marker.
    spark.range(50).write.parquet(f"{path}/_versions/v20000101T000000-x")
    assert sources.read_parquet(spark, path).count() == 1
    assert sources.read_table(spark, "killed", "published").count() == 1
    for n in range(2, 6):
        sources.publish_table(spark.range(n), path, "published", "killed")
        assert sources.read_table(spark, "killed", "published").count() == n
    assert len(list((tmp_path / "killed/_versions").iterdir())) == 2
    assert len([p for p in (tmp_path / "killed/_published").iterdir() if p.suffix != ".crc"]) == 2


def test_partitioned_tables_switch_and_schemas_may_change(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS published")
    path = f"{tmp_path}/parts"

    def publish(n, **more):
        df = spark.range(n).select((F.col("id") % 3).cast("int").alias("part"), "id", *[
            F.lit(value).alias(name) for name, value in more.items()
        ])
        return sources.publish_table(df, path, "published", "parts", partition_by=["part"])

    assert publish(9) == 9
    assert publish(6) == 6
    found = sources.read_table(spark, "parts", "published")
    assert bag(found) == [(i, i % 3) for i in range(6)]
    assert found.columns == ["id", "part"]
    assert found.filter("part = 1").count() == 2
    assert publish(4, **{"a b": "x"}) == 4
    assert sources.read_table(spark, "parts", "published").columns == ["id", "a b", "part"]
    assert sources.publish_table(
        spark.range(3).selectExpr("id", "'y' as `a b`", "cast(id as int) as part"), path,
        "published", "parts", mode="append", partition_by=["part"],
    ) == 3
    assert sources.read_table(spark, "parts", "published").count() == 7


def test_versioned_datasets(spark, tmp_path):
    path = f"{tmp_path}/d"
    assert sources.current_folder(spark, path) == path
    for n in (5, 6, 7):
        assert sources.write_dataset(spark.range(n), path, fmt="orc", versioned=True) == n
    assert sources.read_path(spark, path, "orc").count() == 7
    with pytest.raises(Exception, match="lost input"):
        sources.write_dataset(failing(spark), path, fmt="orc", versioned=True)
    assert sources.read_path(spark, path, "orc").count() == 7
    with pytest.raises(ValueError, match="overwrite"):
        sources.write_dataset(spark.range(1), path, mode="append", versioned=True)
    sources.write_datasets({"a": spark.range(2)}, str(tmp_path), versioned=True)
    assert sources.directory_source(spark, str(tmp_path))("a").count() == 2


def test_a_slow_clock_does_not_publish_into_the_past(spark, tmp_path):
    path = f"{tmp_path}/clock"
    sources.write_dataset(spark.range(1), path, versioned=True)
    marker = tmp_path / "clock/_published/v29990101T000000000000-0"
    marker.touch()
    (tmp_path / "clock/_versions/v29990101T000000000000-0").mkdir()
    sources.write_dataset(spark.range(4), path, versioned=True)
    assert sources.read_parquet(spark, path).count() == 4


def test_many_outputs_under_one_root(spark, tmp_path):
    counts = sources.write_datasets({"a": spark.range(1), "b": spark.range(2)}, str(tmp_path))
    assert counts == {"a": 1, "b": 2}
    assert sources.read_parquet(spark, f"{tmp_path}/b").count() == 2


def test_one_failing_output_fails_the_run(spark, tmp_path):
    bad = spark.range(1).select(F.raise_error(F.lit("lost input")).alias("x"))
    with pytest.raises(Exception, match="lost input"):
        sources.write_datasets({"a": spark.range(3), "b": bad}, str(tmp_path))
    assert sources.read_parquet(spark, f"{tmp_path}/a").count() == 3


def test_rows_with_schema(spark):
    assert bag(sources.rows(spark, [(1, "a")], "id bigint, name string")) == [(1, "a")]


def test_audit_log_grows(spark, tmp_path):
    path = f"{tmp_path}/log"
    start, end = datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 11)
    sources.write_audit_log(spark, path, "first", "SUCCESS", 5, start, end)
    sources.write_audit_log(spark, path, "second", "FAILURE", 0, start, end)
    log = sources.read_audit_log(spark, path)
    assert log.columns == [
        "job_name", "status", "record_count", "start_time", "end_time", "log_ts"
    ]
    found = [tuple(r)[:5] for r in log.collect()]
    assert found == [("first", "SUCCESS", 5, start, end), ("second", "FAILURE", 0, start, end)]


def test_a_run_logged_again_counts_once_and_files_stay_few(spark, tmp_path):
    path = f"{tmp_path}/log"
    start = datetime(2024, 1, 1, 10)
    old = [("old", "SUCCESS", 1, start, start, start)] * 2
    spark.createDataFrame(old, sources.AUDIT_SCHEMA).coalesce(1).write.parquet(path)
    for status in ("FAILURE", "FAILURE", "SUCCESS"):
        sources.write_audit_log(spark, path, "job", status, 3, start, start, run_id="r1")
    sources.write_audit_log(spark, path, "job", "SUCCESS", 4, start, start)
    log = sources.read_audit_log(spark, path, run_ids=True)
    found = [(r.job_name, r.status, r.record_count) for r in log.collect()]
    assert found == [("old", "SUCCESS", 1)] * 2 + [("job", "SUCCESS", 3), ("job", "SUCCESS", 4)]
    assert log.filter("run_id = 'r1'").count() == 1
    sources.merge_audit_log(spark, path, most_files=3)
    assert len(list((tmp_path / "log").glob("*.parquet"))) == 1
    merged = sources.read_audit_log(spark, path)
    assert [(r.job_name, r.status, r.record_count) for r in merged.collect()] == found
    # A merge that is killed before the old files go leaves rows twice.
    merged = sources.read_audit_log(spark, path, run_ids=True).filter("run_id is not null")
    merged.coalesce(1).write.mode("append").parquet(path)
    assert sources.read_audit_log(spark, path).count() == 4


def test_staging_lies_in_the_checkpoint_folder(spark):
    folder = sources.staging_folder(spark)
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert folder != sources.staging_folder(spark)
    staged = sources.stage(spark.range(3), folder, "numbers")
    assert "FileScan parquet" in staged._jdf.queryExecution().executedPlan().toString()
    assert staged.count() == 3
    sources.drop_staged(spark, folder)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(folder)


class ClusterWithoutSharedFolder:
    class conf:
        @staticmethod
        def get(name, default=None):
            return {"spark.master": "yarn"}.get(name, default)


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        sources.staging_folder(ClusterWithoutSharedFolder())


def test_staged_tables_are_pruned(spark):
    folder = sources.staging_folder(spark)
    sales = spark.range(3).select(
        F.col("id").alias("customer_id"), F.col("id").alias("order_id"),
        F.lit(day("2024-01-01")).alias("order_date"), F.lit(1).alias("sales_amount"),
        F.lit("unused").alias("note"),
    )
    report = customer_segments(sources.stage(sales, folder, "sales"))
    text = report._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<customer_id" in text
    assert "note" not in text
