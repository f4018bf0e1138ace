"""Validity rules, tidy-up, derived columns, deduplication, Silver files."""

import math
import random
from datetime import date, datetime, timezone
from pathlib import Path

import pytest
from conftest import bronze_rows
from pyspark.sql import functions as F

from stratalake.functions.dates import iso_date
from stratalake.operators.cleaning import apply_rules
from stratalake.operators.dedup import latest_per_key
from stratalake.plans import silver
from stratalake.sources.layers import read_silver
from stratalake.sources.sinks import write_batch, write_partitioned
from stratalake.tables import spec_for

GOOD_ORDER = {
    "order_id": "A-17",
    "customer_id": "buyer-3",
    "product_id": "lamp-4",
    "order_date": "2023-11-20",
    "quantity": 2,
    "unit_price": 63.6,
    "discount_pct": 0.25,
    "channel": "kiosk",
    "status": "shipped",
    "_ingested_at": datetime(2024, 1, 1, 8),
    "_source_file": "f",
    "_batch_date": date(2024, 1, 1),
}
GOOD_CUSTOMER = {"customer_id": "c1", "email": "a@b.c", "_ingested_at": datetime(2024, 1, 1)}
GOOD_PRODUCT = {"product_id": "p1", "unit_price": 10.0, "unit_cost": 5.0}


def orders(spark, *changes):
    return bronze_rows(spark, "orders", [{**GOOD_ORDER, **c} for c in changes])


def cleaned(spark, **change):
    rows = apply_rules(orders(spark, change), "orders").collect()
    return rows[0] if rows else None


def customer(spark, **change):
    df = bronze_rows(spark, "customers", [{**GOOD_CUSTOMER, **change}])
    rows = apply_rules(df, "customers").collect()
    return rows[0] if rows else None


def product(spark, **change):
    df = bronze_rows(spark, "products", [{**GOOD_PRODUCT, **change}])
    rows = apply_rules(df, "products").collect()
    return rows[0] if rows else None


def test_rows_without_a_key_leave_silver(spark):
    kept = apply_rules(orders(spark, {}, {"order_id": None}), "orders").collect()
    assert [r.order_id for r in kept] == ["A-17"]


def test_nonpositive_and_null_quantity_dropped(spark):
    changes = [{"order_id": str(q), "quantity": q} for q in (3, -1, 0, None)]
    assert [r.order_id for r in apply_rules(orders(spark, *changes), "orders").collect()] == ["3"]


def test_nonpositive_and_null_price_dropped_but_nan_passes(spark):
    assert cleaned(spark, unit_price=0.0) is None
    assert cleaned(spark, unit_price=-1.0) is None
    assert cleaned(spark, unit_price=None) is None
    assert math.isnan(cleaned(spark, unit_price=float("nan")).net_revenue)


def test_revenue_is_net_of_the_discount(spark):
    assert cleaned(spark).net_revenue == 95.4


def test_net_revenue_rounds_half_up_on_the_decimal_form(spark):
    assert cleaned(spark, quantity=1, unit_price=1.005, discount_pct=0.0).net_revenue == 1.01
    assert cleaned(spark, quantity=1, unit_price=100.0, discount_pct=0.333333).net_revenue == 66.67


def test_discount_defaults_to_zero_and_is_not_range_checked(spark):
    row = cleaned(spark, discount_pct=None)
    assert (row.discount_pct, row.net_revenue) == (0.0, 127.2)
    assert cleaned(spark, discount_pct=1.5).net_revenue == -63.6


def test_channels_are_tidied_and_status_lowercased(spark):
    row = cleaned(spark, channel="  Pop-up stall ", status=" On Hold")
    assert (row.channel, row.status) == ("POP-UP STALL", "on hold")


def test_trim_removes_spaces_only(spark):
    assert cleaned(spark, channel="\t a ").channel == "\t A"


def test_keys_are_not_trimmed(spark):
    row = cleaned(spark, order_id="  o6  ", customer_id=" c ")
    assert (row.order_id, row.customer_id) == ("  o6  ", " c ")


def test_bad_dates_become_null_and_keep_the_row(spark):
    for text in ("2024-1-5", "2024-02-30", "", "15/01/2024", "2024-01-15T00:00:00", None):
        row = cleaned(spark, order_date=text)
        assert row is not None and row.order_date is None
    assert cleaned(spark, order_date="2024-02-29").order_date == date(2024, 2, 29)


def test_date_text_agrees_with_the_formatter(spark):
    rng = random.Random(5)
    texts = ["+10000-01-01", "-0001-01-01", "0000-02-29", "2024-01-1T", "2024-01-1 ", " 024-01-01",
             "2024-01-15\n", "２024-01-15", "10000-01-01", "+024-01-01", "2024-01-00", None]
    alphabet = "0123456789-+ /T"
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(8, 12))) for _ in range(500)]
    for _ in range(2000):
        text = list(f"{rng.randint(0, 9999):04}-{rng.randint(0, 13):02}-{rng.randint(0, 32):02}")
        if rng.random() < 0.5:
            text[rng.randrange(len(text))] = rng.choice(alphabet)
        texts.append("".join(text))
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    slow, fast = "try_to_date(s, 'yyyy-MM-dd')", iso_date("s")
    wrong = df.where(f"NOT ({slow} <=> {fast})").collect()
    assert wrong == []
    assert df.where(f"{fast} IS NOT NULL").count() > 500


def test_customer_rules(spark):
    row = customer(
        spark,
        first_name=" o'neil mc-donald VAN ",
        last_name="a\tb c",
        email=" A@B.C ",
        country=" united KINGDOM",
        registration_date="2020-05-01",
    )
    assert row.first_name == "O'neil Mc-donald Van"
    assert row.last_name == "A\tb C"
    assert (row.email, row.country) == ("a@b.c", "United Kingdom")
    assert row.registration_date == date(2020, 5, 1)
    assert row.is_active is True
    assert customer(spark, is_active=False).is_active is False


def test_customers_need_key_and_email_but_a_blank_email_passes(spark):
    assert customer(spark, customer_id=None) is None
    assert customer(spark, email=None) is None
    assert customer(spark, email="  ").email == ""


def test_product_rules(spark):
    row = product(spark, product_name="  small RING ", category=" home appliances ")
    assert (row.product_name, row.category) == ("small RING", "Home Appliances")
    assert row.margin_pct == 50.0
    assert product(spark, unit_cost=12.5).margin_pct == -25.0
    assert product(spark, unit_cost=None).margin_pct is None
    assert product(spark, unit_price=0.0) is None
    assert product(spark, product_id=None) is None


def test_deduplication_keeps_the_latest(spark):
    early, late = datetime(2024, 1, 1, 8), datetime(2024, 1, 1, 10)
    df = orders(
        spark,
        {"_ingested_at": late, "channel": "late"},
        {"_ingested_at": early, "channel": "early"},
        {"_ingested_at": None, "channel": "never"},
    )
    assert [r.channel for r in latest_per_key(df, "order_id").collect()] == ["late"]


def test_latest_valid_version_survives_a_later_invalid_one(spark):
    df = orders(
        spark,
        {"_ingested_at": datetime(2024, 1, 1), "quantity": 5},
        {"_ingested_at": datetime(2024, 1, 2), "quantity": -5},
    )
    assert [r.quantity for r in silver.refined(df, "orders").collect()] == [5]


def many_versions(spark, n=3000, keys=40):
    """Random versions with many ties, and one key that holds a third of all rows."""
    rng = random.Random(11)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(keys)}"
        rows.append(
            {
                "order_id": key,
                "quantity": rng.randint(-1, 5),
                "channel": rng.choice(["a", "b", None]),
                "discount_pct": rng.choice([0.1, 0.2, None]),
                "_ingested_at": datetime(2024, 1, rng.randint(1, 5), tzinfo=timezone.utc),
                "_batch_date": date(2024, 1, 1),
            }
        )
    return orders(spark, *rows)


def as_set(df):
    return sorted(map(str, df.collect()))


def test_deduplication_does_not_depend_on_layout_and_is_idempotent(spark):
    df = many_versions(spark)
    once = silver.refined(df, "orders")
    expected = as_set(once)
    assert len(expected) == 41
    assert as_set(silver.refined(df.repartition(7).orderBy(F.rand(3)), "orders")) == expected
    assert as_set(silver.refined(df.repartition(3, "channel"), "orders")) == expected
    again = latest_per_key(once, "order_id")
    assert as_set(again) == expected


def test_deduplication_agrees_with_brute_force_under_skew(spark):
    df = many_versions(spark)
    best = {}
    columns = [c for c in df.columns if c not in ("order_id", "_ingested_at")]
    for row in df.collect():
        rank = [row._ingested_at] + [(row[c] is not None, row[c] or 0) if not isinstance(row[c], str)
                                     else (True, row[c]) for c in columns]
        rank = [r if isinstance(r, tuple) else (True, r) for r in rank]
        rank = [(known, value) if known else (False,) for known, value in rank]
        if row.order_id not in best or rank > best[row.order_id][0]:
            best[row.order_id] = (rank, row)
    expected = sorted(str(row) for _, row in best.values())
    assert as_set(latest_per_key(df, "order_id").select(*df.columns)) == expected


def test_silver_files_round_trip_with_the_declared_schema(spark, path):
    rows = silver.refined(orders(spark, {}, {"order_id": "b", "_batch_date": date(2024, 2, 1)}), "orders")
    assert write_partitioned(rows, path("silver")) == 2
    stored = read_silver(spark, "orders", path("silver"))
    assert stored.columns == [
        "order_id", "customer_id", "product_id", "order_date", "quantity", "unit_price",
        "discount_pct", "channel", "status", "_ingested_at", "_source_file", "net_revenue",
        "_batch_date",
    ]
    assert dict(stored.dtypes)["order_date"] == "date"
    footer = dict(spark.read.parquet(path("silver")).dtypes)
    assert footer == dict(stored.dtypes)
    assert stored.where("order_id = 'A-17'").collect()[0].net_revenue == 95.4
    assert read_silver(spark, "orders", path("silver"), until=date(2024, 1, 31)).count() == 1
    assert spec_for("products").silver.names[-2:] == ["margin_pct", "_batch_date"]


def deliver(spark, root, day, *changes):
    batch = date(2024, 1, day)
    stamp = {"_ingested_at": datetime(2024, 1, day, tzinfo=timezone.utc), "_batch_date": batch}
    write_batch(orders(spark, *({**c, **stamp} for c in changes)), root, batch)


def test_redelivered_record_moves_to_its_newest_batch(spark, path):
    deliver(spark, path("bronze"), 1, {"order_id": "a"}, {"order_id": "b"})
    deliver(spark, path("bronze"), 2, {"order_id": "a", "quantity": 9})
    assert silver.refine(spark, "orders", path("bronze"), path("silver")) == 2
    rows = read_silver(spark, "orders", path("silver")).collect()
    assert sorted((r.order_id, r.quantity, r._batch_date.day) for r in rows) == [
        ("a", 9, 2),
        ("b", 2, 1),
    ]


def test_refining_newer_batches_onto_silver_equals_a_rebuild(spark, path):
    deliver(spark, path("bronze"), 1, *({"order_id": str(i % 5), "quantity": i} for i in range(20)))
    silver.refine(spark, "orders", path("bronze"), path("v1"))
    deliver(spark, path("bronze"), 2, {"order_id": "3"}, {"order_id": "9"}, {"order_id": "1", "quantity": 0})
    silver.refine(spark, "orders", path("bronze"), path("rebuilt"))
    step = {"earlier": path("v1"), "since": date(2024, 1, 2)}
    silver.refine(spark, "orders", path("bronze"), path("v2"), **step)
    rebuilt = as_set(read_silver(spark, "orders", path("rebuilt")))
    assert len(rebuilt) == 6  # the invalid later version of "1" is ignored
    assert as_set(read_silver(spark, "orders", path("v2"))) == rebuilt
    with pytest.raises(ValueError, match="go together"):
        silver.refine(spark, "orders", path("bronze"), path("v3"), earlier=path("v1"))


def test_a_skipped_batch_is_refused(spark, path):
    deliver(spark, path("bronze"), 1, {"order_id": "1"})
    silver.refine(spark, "orders", path("bronze"), path("v1"))
    deliver(spark, path("bronze"), 2, {"order_id": "2"})
    deliver(spark, path("bronze"), 3, {"order_id": "3"})
    with pytest.raises(ValueError, match="2024-01-02 lies between"):
        silver.refine(
            spark, "orders", path("bronze"), path("v2"), earlier=path("v1"), since=date(2024, 1, 3)
        )
    whole = {"earlier": path("v1"), "since": date(2024, 1, 2)}
    assert silver.refine(spark, "orders", path("bronze"), path("v2"), **whole) == 3


def test_a_table_of_one_batch_is_not_gathered_by_date(spark, path, monkeypatch):
    rows = spark.range(0, 2000, 1, 16).select(F.col("id").cast("string").alias("order_id"), F.lit(date(2024, 1, 1)).alias("_batch_date"))
    assert write_partitioned(rows, path("one"), date(2024, 1, 1)) == 2000
    assert spark.read.parquet(path("one")).select("_batch_date").distinct().collect()[0][0] == date(2024, 1, 1)
    assert len([f for f in Path(path("one", "_batch_date=2024-01-01")).iterdir() if f.suffix == ".parquet"]) == 16
    batches = []
    monkeypatch.setattr(silver, "write_partitioned", lambda df, root, batch=None: batches.append(batch) or 0)
    for day in (1, 2):
        Path(path("bronze", f"_batch_date=2024-01-0{day}")).mkdir(parents=True)
        silver.refine(spark, "orders", path("bronze"), path("silver"))
    assert batches == [date(2024, 1, 1), None]
