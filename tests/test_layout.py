"""Plan shapes and file layouts that have to hold at any data volume."""

import contextlib
import io
import os
from datetime import date, datetime

import pytest
from conftest import bronze_rows
from pyspark.sql import functions as F

from stratalake.operators import rollups
from stratalake.operators.dedup import latest_per_key
from stratalake.operators.wordcount import word_count
from stratalake.plans import silver
from stratalake.session import MAX_PARTITIONS, get_spark, scratch_dir, sizing
from stratalake.sources.layers import read_bronze, read_silver
from stratalake.sources.sinks import write_partitioned
from stratalake.tables import spec_for


def plan(df, mode="simple"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode=mode)
    return text.getvalue()


@pytest.fixture
def stored_silver(spark, path):
    for table in ("orders", "customers", "products"):
        empty = spark.createDataFrame([], spec_for(table).silver)
        write_partitioned(empty, path("silver", table))
    return lambda table: read_silver(spark, table, path("silver", table))


@pytest.fixture
def stored_bronze(spark, path):
    spark.createDataFrame([], spec_for("orders").bronze).write.parquet(path("bronze"))
    return read_bronze(spark, "orders", path("bronze"))


def test_dedup_limits_each_key_before_its_only_shuffle(spark):
    text = plan(latest_per_key(bronze_rows(spark, "orders", []), "order_id"))
    shuffle = text.index("Exchange hashpartitioning(order_id")
    assert text.count("Exchange") == 1
    # Plans print top down: what runs before the shuffle comes after it.
    assert "Partial" in text[shuffle:] and "WindowGroupLimit" in text[shuffle:]


def test_silver_rules_reach_the_scan_and_derived_columns_stay_out_of_the_shuffle(stored_bronze):
    df = silver.refined(stored_bronze, "orders")
    text = plan(df)
    for pushed in ("IsNull(_corrupt_record)", "IsNotNull(order_id)", "GreaterThan(quantity,0)",
                   "GreaterThan(unit_price,0.0)"):
        assert pushed in plan(df, "formatted")
    assert "net_revenue" not in text[text.index("Exchange") :]
    assert text.count("Exchange") == 1


def test_rollups_combine_before_every_shuffle(stored_silver):
    orders = stored_silver("orders")
    for df in (
        rollups.daily_revenue(orders),
        rollups.customer_metrics(orders, stored_silver("customers"), date(2024, 1, 1)),
        rollups.product_performance(orders, stored_silver("products")),
    ):
        text = plan(df)
        scan = text[: text.index("FileScan")]
        assert "partial_count(order_id" in scan[scan.rindex("Exchange hashpartitioning") :]
        assert "Python" not in text and "BatchEval" not in text and "Cartesian" not in text


def test_rollups_read_only_what_they_use(stored_silver):
    text = plan(rollups.daily_revenue(stored_silver("orders")))
    assert "PushedFilters: [In(status, [completed,shipped])]" in text
    columns = text.split("ReadSchema: ")[1]
    assert "product_id" not in columns and "_source_file" not in columns
    text = plan(
        rollups.customer_metrics(
            stored_silver("orders"), stored_silver("customers"), date(2024, 1, 1)
        )
    )
    assert "is_active" not in text and "registration_date" not in text


def test_customer_join_reuses_the_aggregate_partitioning(spark, stored_silver):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(
            rollups.customer_metrics(
                stored_silver("orders"), stored_silver("customers"), date(2024, 1, 1)
            )
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text
    # Two for the distinct count, one for the dimension, none for the joined aggregate.
    assert text.count("Exchange") == 3


def test_word_count_combines_before_its_only_shuffle(spark):
    text = plan(word_count(spark.createDataFrame([], "value string")))
    assert text.count("Exchange") == 1
    assert "partial_count" in text[text.index("Exchange") :]


def test_silver_files_follow_batches_not_tasks(spark, path):
    rows = spark.range(0, 2000, 1, 16).select(
        F.col("id").cast("string").alias("order_id"),
        F.expr("date_add(date'2024-01-01', cast(id % 5 as int))").alias("_batch_date"),
    )
    assert write_partitioned(rows, path("out")) == 2000
    files = [n for _, _, names in os.walk(path("out")) for n in names if n.endswith(".parquet")]
    assert len(files) == 5


def test_one_batch_holding_nearly_all_rows_is_split_over_tasks(spark, path):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "200k")
    try:
        rows = spark.range(0, 200_000, 1, 8).select(
            F.sha2(F.col("id").cast("string"), 256).alias("order_id"),
            F.lit(date(2024, 1, 1)).alias("d"),
        )
        hot = rows.withColumn("_batch_date", F.expr("if(rand(1) < 0.99, d, date_add(d, 1))"))
        write_partitioned(hot.drop("d"), path("out"))
    finally:
        spark.conf.unset(key)
    assert len(os.listdir(path("out", "_batch_date=2024-01-01"))) > 10


def test_sizing_grows_with_the_data_up_to_a_bound():
    number = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    share = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    split = "spark.sql.files.maxPartitionBytes"
    tiny, middle, large = ({k: int(v) for k, v in sizing(gb).items() if v.isdigit()}
                           for gb in (0.05, 100, 100 * 1024))
    assert (tiny[number], tiny[share] >> 20, tiny[split] >> 20) == (16, 4, 128)
    assert (middle[number], middle[share] >> 20, middle[split] >> 20) == (800, 128, 128)
    assert (large[number], large[share] >> 20, large[split] >> 20) == (MAX_PARTITIONS, 128, 1024)


def test_session_defaults(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.parquet.compression.codec") == "snappy"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert get_spark("again", conf={"spark.ui.enabled": "false"}) is spark


def test_scratch_lies_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(base) and second.startswith(base) and first != second


def test_timestamps_do_not_depend_on_the_session_time_zone(spark, path):
    from stratalake.operators.audit import with_audit

    naive = with_audit(spark.range(1), "x", datetime(2024, 1, 1, 23, 30))
    row = naive.select(F.unix_timestamp("_ingested_at").alias("t"), "_batch_date").collect()[0]
    assert (row.t, row._batch_date) == (1704151800, date(2024, 1, 1))
