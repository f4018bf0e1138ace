"""Deliveries of more rows and groups than may be broadcast: what meets in a shuffle, and that results stay whole."""

import glob
import os
import time
from datetime import date

import pytest
from pyspark.sql import functions as F
from test_daily import batch, check_layers, daily, deliver, order, refreshed
from test_layout import plan
from test_run import LINES

from stratalake.operators import rollups
from stratalake.operators.contested import Contested
from stratalake.plans import full_run, gold_delta, silver_delta
from stratalake.session import CHAINED, chained_jobs
from stratalake.sources import star_landing as star
from stratalake.sources import storage
from stratalake.sources.landing import read_csv
from stratalake.tables import ORDERS


@pytest.fixture
def many(monkeypatch):
    monkeypatch.setattr(silver_delta, "MOST_KEYS", 0)


def keyed(spark, *keys):
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, n int")


def test_every_key_of_several_rows_is_contested(spark):
    left = keyed(spark, *(f"a{i}" for i in range(5000)), "a7", None, None)
    right = keyed(spark, *(f"a{i}" for i in range(4900, 9900)))
    shared_keys = {*(f"a{i}" for i in range(4900, 5000)), "a7", None}
    for contested in (Contested("k", left, right), Contested("k", left, right, most_bits=1)):
        for rows in (left, right):
            alone, shared = (part.collect() for part in contested.parted(rows))
            assert sorted(alone + shared, key=lambda r: r.n) == sorted(rows.collect(), key=lambda r: r.n)
            assert not shared_keys & {r.k for r in alone}
            assert len(shared) < 500
    alone, shared = Contested("k", keyed(spark, "x", "y")).parted(keyed(spark, "x", "y"))
    assert alone.count() == 2 and shared.count() == 0


def test_rows_that_have_their_key_alone_are_not_compared(spark, path, many, monkeypatch):
    seen = []
    for name in ("changed_rows", "latest_per_key"):
        work = getattr(silver_delta, name)
        monkeypatch.setattr(silver_delta, name, lambda *a, work=work: (seen.extend(d.count() for d in a if hasattr(d, "count") and hasattr(d, "columns")), work(*a))[1])
    batch(spark, path, 0, *(order(f"a{i}") for i in range(2000)), order("a5", quantity=9), order("a5", quantity=9))
    assert refreshed(spark, path).added == 2000
    batch(spark, path, 1, *(order(f"b{i}") for i in range(2000)), order("a3", quantity=4), order("b7", quantity=2), order("bad", quantity=-1))
    done = refreshed(spark, path)
    assert (done.added, done.removed) == (2001, 1)
    assert seen and max(seen) < 200


def test_days_of_many_rows_equal_full_builds(spark, path, many):
    lake = full_run.Lake(path("lake"))
    nameless = [order(f"n{i}", customer="", product="", quantity=i + 1) for i in range(3)]
    deliver(lake, "day0", orders=[*LINES["orders"], *nameless], customers=LINES["customers"], products=LINES["products"])
    _, day = daily(spark, lake, 0)
    check_layers(spark, lake, day)
    deliver(
        lake, "day1",
        orders=[order("n1", customer="", product="p1", quantity=8), order("o1", quantity=7), order("o8", customer="c5", day="2024-06-02"), order("o8", customer="c5", day="2024-06-02")],
        customers=["c1,ann,NEW,a@b.c,peru,2020-01-01,", "c5,eve,x,e@x.y,chile,2020-01-01,true"],
    )
    _, day = daily(spark, lake, 1)
    check_layers(spark, lake, day)
    deliver(lake, "day2", products=["p9,Late,gifts,3.0,1.0"], orders=[order("o2", customer="c9", product="p9", day="bad"), order("o9", status="cancelled")])
    _, day = daily(spark, lake, 2)
    check_layers(spark, lake, day)


def test_orders_of_many_groups_are_shuffled_once_and_without_their_ids(spark, path, many):
    spark.createDataFrame([], ORDERS.silver).write.parquet(path("orders"))
    orders = spark.read.schema(ORDERS.silver).parquet(path("orders"))
    groups = spark.createDataFrame([("c1",)], "customer_id string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(gold_delta._again(orders, groups, "customer_id", lambda o: rollups.purchase_profile(o, date(2024, 1, 1))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange") == 2  # orders and groups, none for the rollup
    assert "Exchange hashpartitioning(customer_id" in text
    below = text[text.index("Exchange hashpartitioning(customer_id") :]
    assert "isnotnull(order_id" in below[: below.index("FileScan")]  # only a mark is shuffled


def test_customers_of_stored_orders_are_counted_apart_from_the_totals(spark, path):
    columns = "order_id string, order_date date, channel string, customer_id string, status string, net_revenue double, quantity int"
    days = (None, date(2024, 1, 1), date(2024, 1, 2))
    rows = [
        (f"o{i}" if i % 11 else None, days[i % 3], (None, "A", "B")[i % 5 % 3], (None, "x", "y", "z")[i % 7 % 4],
         ("completed", "shipped", "pending")[i % 13 % 3], (None, 1.25, float("nan"))[i % 17 % 3] if i % 4 else 10.5, i % 6 or None)
        for i in range(300)
    ]
    rows += [("only", date(2024, 2, 1), "A", None, "shipped", 1.0, 1)]
    spark.createDataFrame(rows, columns).write.parquet(path("orders"))
    orders = spark.read.parquet(path("orders"))
    apart, together = rollups.daily_revenue(orders, stored=True), rollups.daily_revenue(orders)
    assert apart.dtypes == together.dtypes
    assert [str(r) for r in apart.collect()] == [str(r) for r in together.collect()]
    text = plan(apart)
    of_customers = [line for line in text.splitlines() if "keys=[order_date" in line and "customer_id" in line.split("functions")[0]]
    assert of_customers and all("functions=[]" in line for line in of_customers)


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for top in found for f in glob.glob(f"{top}/*/shuffle_*.data")}


def test_a_chain_of_jobs_leaves_no_shuffle_files(spark, path):
    held = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    held.write.parquet(path("held"))
    before, set_before = shuffle_files(spark), {k: spark.conf.get(k, None) for k in CHAINED}
    assert before  # outside a chain they stay
    with chained_jobs(spark):
        for i in range(3):
            spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().write.parquet(path(f"out{i}"))
            assert spark.read.parquet(path(f"out{i}")).count() == 7
        until = time.time() + 20
        while (left := shuffle_files(spark) - before) and time.time() < until:
            time.sleep(0.2)
    assert not left
    assert {k: spark.conf.get(k, None) for k in CHAINED} == set_before


def test_landing_files_by_day_are_read_back_whole_once_moved(spark, path):
    names = ORDERS.landing.names
    rows = spark.range(50).select(
        *(F.lit(None).cast(ORDERS.landing[n].dataType).alias(n) if n != "order_id" else F.concat(F.lit(" o"), "id").alias(n) for n in names),
        (F.col("id") % 2).cast("int").alias("day"),
    )
    star.write_csv_landing(rows, path("waiting"), by="day", compression="gzip")
    storage.move(spark, path("waiting", "day=1"), path("landing", "orders", "day-1"))
    storage.move(spark, path("waiting", "day=7"), path("landing", "orders", "day-7"))  # nothing came that day
    assert os.listdir(path("landing", "orders")) == ["day-1"]
    found = read_csv(spark, "orders", path("landing", "orders", "day-1")).select("order_id").collect()
    assert sorted(r.order_id for r in found) == sorted(f" o{i}" for i in range(1, 50, 2))
