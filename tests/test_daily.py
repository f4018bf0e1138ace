"""The incremental path: file table, ledger, delta Silver, Gold by group, and what a crash leaves."""

import itertools
import os
import random
import shutil
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from test_bronze import write_file
from test_layout import plan
from test_run import LINES

from stratalake.plans import arrivals, bronze, full_run, gold, gold_delta, silver, silver_delta
from stratalake.sources import snapshots, storage
from stratalake.sources.layers import read_bronze, read_gold, read_silver
from stratalake.sources.sinks import batch_path
from stratalake.tables import ORDERS, TABLES, spec_for

DAY = datetime(2024, 6, 1, 12, tzinfo=timezone.utc)


def header(table):
    return ",".join(TABLES[table].landing.names)


def order(key, customer="c1", product="p1", day="2024-05-01", quantity=1, price=10.0, channel="online", status="completed"):
    return f"{key},{customer},{product},{day},{quantity},{price},,{channel},{status}"


def deliver(lake, name, **tables):
    for table, lines in tables.items():
        write_file(f"{lake.path('landing', table)}/{name}.csv", lines, header(table))


def rows_of(df):
    return sorted(str(tuple(row[c] for c in sorted(df.columns))) for row in df.collect())


def rebuilt(spark, lake, table):
    """Silver as a rebuild from the same Bronze files makes it."""
    stored = silver.refined(read_bronze(spark, table, lake.path("bronze", table)), table)
    return rows_of(stored.select(*spec_for(table).silver.names))


def check_layers(spark, lake, as_of):
    for table in TABLES:
        assert rows_of(read_silver(spark, table, lake.path("silver", table))) == rebuilt(spark, lake, table), table
    for job, (name, build) in gold.JOBS.items():
        full = build(lambda table: read_silver(spark, table, lake.path("silver", table)), as_of)
        found = read_gold(spark, lake.path("gold", name))
        assert sorted(found.columns) == sorted(full.columns)
        assert rows_of(found) == rows_of(full), job


def daily(spark, lake, day, **options):
    moment = DAY + timedelta(days=day)
    return full_run.run_new(spark, lake, ingested_at=moment, **options), moment.date()


@pytest.fixture
def lake(path):
    lake = full_run.Lake(path("lake"))
    deliver(lake, "day0", orders=LINES["orders"], customers=LINES["customers"], products=LINES["products"])
    return lake


# Files


def test_listing_holds_visible_files_in_pages(spark, path):
    for name in ("a/x.csv", "a/b/y y.csv", "z.csv", "_hidden.csv", ".crc", "_SUCCESS", "_k=1/w.csv"):
        write_file(path("root", *name.split("/")), ["line"], None)
    found = storage.list_files(spark, path("root"), page=2).collect()
    assert sorted(os.path.basename(r.path) for r in found) == ["w.csv", "x.csv", "y y.csv", "z.csv"]
    assert {r.length for r in found} == {5} and all(r.modified > 1.6e12 for r in found)
    assert storage.list_files(spark, path("nowhere")).count() == 0
    assert storage.total_bytes(spark, path("root", "a"), path("nowhere"), path("root", "z*")) == 15


def test_listing_keeps_one_page_in_the_driver(spark, path):
    os.makedirs(path("many"))
    for i in range(3000):
        with open(path("many", f"f{i}.csv"), "w"):
            pass
    sizes = [len(rows) for rows in storage._pages(spark, path("many"), 500)]
    assert sizes == [500] * 6
    held = max(len(rows) for rows in storage._pages(spark, path("many"), 100))
    assert held == 100
    assert storage.list_files(spark, path("many"), page=1000).count() == 3000


def test_pointer_is_replaced_in_one_step(spark, path):
    target = path("table", "_current")
    assert storage.read_pointer(spark, target) is None
    for version in (1, 2):
        storage.write_pointer(spark, target, {"version": version, "text": "é\n"})
        assert storage.read_pointer(spark, target) == {"version": version, "text": "é\n"}
    assert [n for n in os.listdir(path("table")) if not n.endswith(".crc")] == ["_current"]


def arrive(spark, path, day=0, **options):
    moment = DAY + timedelta(days=day)
    return arrivals.ingest_arrivals(spark, "orders", path("landing"), path("bronze"), ingested_at=moment, **options)


def test_each_file_is_read_once_whatever_its_name_or_time(spark, path):
    write_file(path("landing", "a {1}* b.csv"), [order("o1")], header("orders"))
    assert arrive(spark, path).rows == 1
    assert arrive(spark, path).rows == 0
    late = path("landing", "old.csv")
    write_file(late, [order("o2"), order("o3")], header("orders"))
    os.utime(late, (1, 1))
    assert arrive(spark, path, 1).rows == 2
    write_file(late, [order("o2"), order("o3"), order("o4")], header("orders"))  # changed: read again
    assert arrive(spark, path, 2).rows == 3
    found = read_bronze(spark, "orders", path("bronze")).groupBy("order_id").count().collect()
    assert {r.order_id: r["count"] for r in found} == {"o1": 1, "o2": 2, "o3": 2, "o4": 1}
    assert arrivals.files_read(spark, path("bronze")).count() == 3


def test_arrivals_in_steps_with_letters_and_lineage(spark, path):
    for i in range(9):
        write_file(path("landing", f"f{i}.csv"), [order(f"o{i}"), order("", quantity=2), order(f"b{i}", quantity="x")], header("orders"))
    done = arrive(spark, path, files_per_step=2, dead_letter=path("dead"), strict=True)
    assert (done.rows, done.rejected) == (27, 18)
    assert arrivals.committed_steps(spark, path("bronze")) > 2
    letters = bronze.read_dead_letters(spark, "orders", path("dead"))
    assert letters.count() == 18 and letters.select("_source_file").distinct().count() == 9
    assert read_bronze(spark, "orders", path("bronze")).count() == 9


def test_a_step_that_dies_is_written_anew(spark, path, monkeypatch):
    write_file(path("landing", "a.csv"), [order("o1")], header("orders"))
    with monkeypatch.context() as patch:
        patch.setattr(storage, "write_pointer", lambda *args: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            arrive(spark, path)
    assert arrivals.files_read(spark, path("bronze")).count() == 0
    assert silver_delta.bronze_files(spark, path("bronze")).count() == 0
    write_file(path("landing", "b.csv"), [order("o2")], header("orders"))
    assert arrive(spark, path, 1).rows == 2
    assert read_bronze(spark, "orders", path("bronze")).count() == 2


def test_kinds_of_ingest_refuse_each_others_paths(spark, path):
    from stratalake.streaming.incremental import ingest_new_files

    write_file(path("landing", "a.csv"), [order("o1")], header("orders"))
    arrive(spark, path)
    with pytest.raises(ValueError, match="another kind|file table"):
        ingest_new_files(spark, "orders", path("landing"), path("bronze"), path("progress"))
    with pytest.raises(ValueError, match="another kind"):
        bronze.ingest(spark, "orders", path("landing"), path("bronze"))
    ingest_new_files(spark, "orders", path("landing"), path("streamed"), path("progress"))
    with pytest.raises(ValueError, match="streaming"):
        arrivals.ingest_arrivals(spark, "orders", path("landing"), path("streamed"))


# Silver


_landings = itertools.count()


def batch(spark, path, day, *lines):
    """A Bronze batch of a given day, ingested by the batch job."""
    landing = path(f"landing-{next(_landings)}")
    write_file(f"{landing}/a.csv", [*lines], header("orders"))
    bronze.ingest(spark, "orders", landing, path("bronze"), ingested_at=DAY + timedelta(days=day), source_name="x")


def refreshed(spark, path):
    done = silver_delta.refresh(spark, "orders", path("bronze"), path("silver"))
    found = rows_of(read_silver(spark, "orders", path("silver")))
    if storage.matches(spark, path("bronze", "_batch_date=*")):
        full = silver.refined(read_bronze(spark, "orders", path("bronze")), "orders")
        assert found == rows_of(full.select(*ORDERS.silver.names))
    return done


def files_below(root):
    return {os.path.join(d, n) for d, _, names in os.walk(root) for n in names if n.endswith(".parquet")}


def test_only_touched_dates_are_written(spark, path):
    for day in range(4):
        batch(spark, path, day, order(f"o{day}"), order(f"k{day}"))
    assert refreshed(spark, path).touched == tuple((DAY + timedelta(days=d)).date() for d in range(4))
    before = files_below(path("silver", "_version=1"))
    batch(spark, path, 4, order("o1", quantity=5), order("new"), order("bad", quantity=-1))
    done = refreshed(spark, path)
    assert (done.added, done.removed) == (2, 1)
    assert done.touched == (date(2024, 6, 2), date(2024, 6, 5))
    assert files_below(path("silver", "_version=1")) == before
    state = snapshots.current(spark, path("silver"))
    assert {d: p["version"] for d, p in state.parts.items()} == {
        "2024-06-01": 1, "2024-06-02": 2, "2024-06-03": 1, "2024-06-04": 1, "2024-06-05": 2,
    }
    assert refreshed(spark, path) == silver_delta.Refresh(2, 0, 0, ())


def test_late_batches_and_batches_ingested_again_are_picked_up(spark, path):
    batch(spark, path, 10, order("a"), order("b"))
    batch(spark, path, 12, order("a", quantity=2))
    refreshed(spark, path)
    batch(spark, path, 11, order("a", quantity=9), order("c"))  # older than a's version, but c is new
    done = refreshed(spark, path)
    assert (done.added, done.removed, done.touched) == (1, 0, (date(2024, 6, 12),))
    batch(spark, path, 12, order("b", quantity=3))  # again, without a: its earlier versions come back
    done = refreshed(spark, path)
    found = {r.order_id: (r.quantity, r._batch_date.day) for r in read_silver(spark, "orders", path("silver")).collect()}
    assert found == {"a": (9, 12), "b": (3, 13), "c": (1, 12)}
    storage.delete(spark, batch_path(path("bronze"), date(2024, 6, 12)))  # a batch taken back
    refreshed(spark, path)
    for day in (11, 13):
        storage.delete(spark, batch_path(path("bronze"), date(2024, 6, day)))
    refreshed(spark, path)
    assert snapshots.current(spark, path("silver")).parts == {}


def test_ties_repeats_and_nulls_do_not_touch_anything(spark, path):
    batch(spark, path, 0, order("a"), order("a"), order("n", price="NaN"), order("x", day="bad", channel=""))
    refreshed(spark, path)
    batch(spark, path, 0, order("x", day="bad", channel=""), order("a"), order("n", price="NaN"))
    done = refreshed(spark, path)
    assert (done.added, done.removed, done.touched) == (0, 0, ())


def test_random_deliveries_equal_rebuilds(spark, path):
    rng = random.Random(7)
    for step in range(7):
        for day in rng.sample(range(6), rng.randint(1, 2)):
            lines = [order(f"o{rng.randint(0, 12)}", quantity=rng.choice([0, 1, 2, 3]), channel=rng.choice(["a", "b"])) for _ in range(6)]
            batch(spark, path, day, *lines)
        refreshed(spark, path)


def test_wide_earlier_rows_pass_no_shuffle(spark, path):
    for day in range(3):
        batch(spark, path, day, *(order(f"o{day}-{i}") for i in range(50)))
    refreshed(spark, path)
    state = snapshots.current(spark, path("silver"))
    earlier = snapshots.read_parts(spark, path("silver"), ORDERS.silver, state)
    keys = earlier.limit(3).select("order_id")
    keys.write.parquet(path("keys"))
    keys = spark.read.parquet(path("keys"))
    for how in ("left_semi", "left_anti"):
        text = plan(silver_delta.with_known(earlier, keys, ["order_id"], how))
        assert "BroadcastHashJoin" in text and "Exchange hash" not in text and "ShuffleExchange" not in text
    moved = earlier.drop("net_revenue").limit(4).withColumn("_change", F.expr("if(quantity > 1, 'added', 'removed')"))
    moved.write.parquet(path("changes"))
    text = plan(silver_delta.touched_rows(earlier, spark.read.parquet(path("changes")), ORDERS))
    shuffles = [line for line in text.splitlines() if "Exchange" in line and "BroadcastExchange" not in line]
    assert len(shuffles) == 1 and "REBALANCE" in shuffles[0]  # of the added rows
    assert "Union" in text and "Window" not in text


def test_many_keys_are_joined_instead_of_broadcast(spark, path, monkeypatch):
    monkeypatch.setattr(silver_delta, "MOST_KEYS", 0)
    batch(spark, path, 0, order("a"), order("b"))
    refreshed(spark, path)
    batch(spark, path, 1, order("a", quantity=4), order("c"))
    assert refreshed(spark, path).added == 2


def test_a_plain_silver_table_is_refused(spark, path):
    batch(spark, path, 0, order("a"))
    silver.refine(spark, "orders", path("bronze"), path("silver"))
    with pytest.raises(ValueError, match="pointer"):
        silver_delta.refresh(spark, "orders", path("bronze"), path("silver"))


def test_versions_no_reader_needs_can_go(spark, path):
    for day in range(3):
        batch(spark, path, day, order("a", quantity=day + 1), order(f"k{day}"))
        refreshed(spark, path)
    before = rows_of(read_silver(spark, "orders", path("silver")))
    dropped = snapshots.drop_unreferenced(spark, path("silver"), keep_changes_from=3)
    assert [d.split("/silver/")[1] for d in dropped] == [
        "_version=1",  # its only date was written anew by version 2
        "_ledger/_version=1",
        "_ledger/_version=2",
        "_changes/_version=2",
    ]
    assert rows_of(read_silver(spark, "orders", path("silver"))) == before
    assert refreshed(spark, path).touched == ()


# Header lines and sizes


def test_columns_follow_each_files_header(spark, path):
    from stratalake.sources.landing import file_headers, read_csv

    names = list(ORDERS.landing.names)
    turned = [names[1], "note", *reversed(names[2:]), " order_id"]
    write_file(path("landing", "a b.csv"), [order("o1"), order("o2")], header("orders"))
    write_file(path("landing", "b.csv"), ["c9,x,shipped,store,0.5,2.5,3,2024-05-09,p7,o3", "c9,x,shipped,store,0.5,2.5,many,2024-05-09,p7,o4"], ",".join(turned))
    write_file(path("landing", "c.csv"), ["o5,7"], '"order_id",quantity')
    write_file(path("landing", "d.csv"), [], header("orders"))
    (open(path("landing", "empty.csv"), "w")).close()
    assert file_headers(spark, "orders", path("landing")).count() == 4
    found = {r.order_id: r for r in read_csv(spark, "orders", path("landing"), by_header=True, keep_rejects=True).collect()}
    assert list(found["o1"].asDict()) == [*names, "_corrupt_record"]
    assert (found["o3"].customer_id, found["o3"].quantity, found["o3"].unit_price, found["o3"].status) == ("c9", 3, 2.5, "shipped")
    assert found["o4"].quantity is None and found["o4"]._corrupt_record.startswith("c9,x") and found["o4"].channel == "store"
    assert (found["o5"].quantity, found["o5"].status, found["o5"]._corrupt_record) == (7, None, None)
    assert found["o1"].customer_id == "c1" and len(found) == 5
    write_file(path("landing", "e.csv"), ["x"], "name")
    with pytest.raises(ValueError, match="no header with order_id in 1 files.*e.csv"):
        read_csv(spark, "orders", path("landing"), by_header=True)
    with pytest.raises(ValueError, match="choose one"):
        read_csv(spark, "orders", path("landing"), by_header=True, check_header=True)


def test_ingests_bind_by_header_with_letters_and_lineage(spark, path):
    turned = ",".join(reversed(ORDERS.landing.names))
    write_file(path("landing", "a.csv"), [order("o1"), order("o2", quantity="x")], header("orders"))
    write_file(path("landing", "b.csv"), [",".join(reversed(order("o3").split(",")))], turned)
    options = {"by_header": True, "dead_letter": path("dead"), "lineage": "file", "ingested_at": DAY}
    assert bronze.ingest(spark, "orders", path("landing"), path("batch"), **options).rejected == 1
    options["dead_letter"] = path("dead2")
    assert arrivals.ingest_arrivals(spark, "orders", path("landing"), path("bronze"), **options).rows == 3
    for stored in ("batch", "bronze"):
        found = read_bronze(spark, "orders", path(stored)).collect()
        assert {(r.order_id, r.quantity, os.path.basename(r._source_file)) for r in found} == {("o1", 1, "a.csv"), ("o3", 1, "b.csv")}


def test_stage_sizes_follow_the_input(spark, path):
    from stratalake.plans.sizes import size_for
    from stratalake.session import MB

    keys = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.maxPartitionBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.parallelismFirst")
    before = {k: spark.conf.get(k, None) for k in keys}
    os.makedirs(path("big", "part"))
    for name in ("a", "part/b"):
        with open(path("big", name), "w") as f:
            f.truncate(150 * 1024 * MB)  # a file with a hole: it takes no room
    try:
        assert size_for(spark, path("big"), path("none")) == 300
        assert spark.conf.get(keys[0]) == "2400" and spark.conf.get(keys[1]) == str(128 * MB)
        assert size_for(spark, path("big"), data_gb=0.5) == 0.5
        assert spark.conf.get(keys[0]) == "128"
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# Gold and the whole day


def test_days_equal_full_builds(spark, lake):
    result, day = daily(spark, lake, 0)
    assert result.gold["daily_revenue_by_channel"] == gold_delta.Update(1, 2, None)
    check_layers(spark, lake, day)
    deliver(
        lake, "day1",
        orders=[order("o1", quantity=7), order("o7", customer="c5", product="p9", day="bad"), order("o8", channel="store", day="2024-06-02")],
        customers=["c1,ann,NEW,a@b.c,peru,2020-01-01,", "c5,eve,x,e@x.y,chile,2020-01-01,true"],
    )
    result, day = daily(spark, lake, 1)
    assert {name: u.groups for name, u in result.gold.items()} == {
        "daily_revenue_by_channel": 3, "customer_metrics": 2, "product_performance": 2,
    }
    check_layers(spark, lake, day)
    deliver(lake, "day2", products=["p9,Late,gifts,3.0,1.0"], orders=[order("o2", status="cancelled", customer="c9", day="2024-05-02", channel="store")])
    result, day = daily(spark, lake, 2)
    check_layers(spark, lake, day)
    # nothing new: only what depends on the day is written
    result, day = daily(spark, lake, 5)
    assert all(u.groups == 0 for u in result.gold.values()) and result.bronze["orders"].rows == 0
    assert [result.gold[n].version for n in ("daily_revenue_by_channel", "customer_metrics")] == [3, 4]
    check_layers(spark, lake, day)


def test_two_days_equal_the_batch_run(spark, lake, path):
    daily(spark, lake, 0)
    deliver(lake, "day1", orders=[order("o1", quantity=7), order("o9")])
    _, day = daily(spark, lake, 1)
    whole = full_run.Lake(path("whole"))
    for moment, name in ((0, "day0"), (1, "day1")):
        for table in TABLES:
            source, target = (f"{x.path('landing', table)}/{n}.csv" for x, n in ((lake, name), (whole, "today")))
            if os.path.exists(source):
                os.makedirs(os.path.dirname(target), exist_ok=True)
                shutil.copy(source, target)
            else:
                write_file(target, [], header(table))
        full_run.run(spark, whole, ingested_at=DAY + timedelta(days=moment), as_of=day)
    for name in ("daily_revenue_by_channel", "customer_metrics", "product_performance"):
        ours, theirs = (read_gold(spark, x.path("gold", name)) for x in (lake, whole))
        drop = [c for c in ("_source_file",) if c in theirs.columns]
        assert rows_of(ours.drop(*drop)) == rows_of(theirs.drop(*drop))


def test_daily_revenue_reads_only_batches_that_can_hold_its_days(spark, lake):
    for day in range(4):
        deliver(lake, f"d{day}", orders=[order(f"x{day}", day=f"2024-06-0{day + 1}")])
        daily(spark, lake, day)
    state = {"orders": snapshots.current(spark, lake.path("silver", "orders"))}
    groups = spark.createDataFrame([(date(2024, 6, 3), "ONLINE")], "order_date date, channel string")
    rows = gold_delta.daily_orders(gold_delta._Silver(spark, lake.path("silver"), state), groups)
    assert {r._batch_date for r in rows.collect()} == {date(2024, 6, 3)}
    text = plan(rows, "formatted")
    assert "_batch_date=2024-06-03]" in text and "_batch_date=2024-06-02" not in text
    assert "EqualTo(order_date,2024-06-03)" in text or "In(order_date" in text
    assert len(rows.inputFiles()) == 1
    assert state["orders"].dates_with({None}) == [] or all(
        state["orders"].parts[d.isoformat()]["range"][2] for d in state["orders"].dates_with({None})
    )


STEPS = {
    "ingest writes": (arrivals, "_write"),
    "ingest commits": (storage, "write_pointer"),
    "changes found": (silver_delta, "touched_rows"),
    "silver described": (snapshots, "described"),
    "ledger": (silver_delta, "_ledger"),
    "silver or gold pointed": (snapshots, "point"),
    "groups": (gold_delta, "with_known"),
}


def test_a_run_that_dies_anywhere_is_repeated_without_loss(spark, lake, monkeypatch):
    daily(spark, lake, 0)
    for number, (module, name) in enumerate(STEPS.values(), 1):
        deliver(lake, f"day{number}", orders=[order("o1", quantity=number), order(f"n{number}", day=f"2024-06-0{number}")])
        work, dead = getattr(module, name), []

        def dies(*args, work=work, dead=dead, **kwargs):
            result = work(*args, **kwargs)
            dead.append(args)
            raise RuntimeError("driver lost")

        with monkeypatch.context() as patch:
            patch.setattr(module, name, dies)
            with pytest.raises(RuntimeError, match="driver lost"):
                daily(spark, lake, number)
        assert dead
        for job in ("daily_revenue_by_channel", "customer_metrics", "product_performance"):
            assert read_gold(spark, lake.path("gold", job)).count() > 0  # a version is readable all along
        if number % 2:  # else the next day's run takes both deliveries
            _, day = daily(spark, lake, number)
    check_layers(spark, lake, day)
    counts = read_bronze(spark, "orders", lake.path("bronze", "orders")).groupBy("order_id").count().collect()
    assert {r["count"] for r in counts if r.order_id and r.order_id.startswith("n")} == {1}
    assert len([r for r in counts if r.order_id and r.order_id.startswith("n")]) == len(STEPS)


def test_a_write_that_fails_half_way_leaves_the_old_rows(spark, lake, monkeypatch):
    daily(spark, lake, 0)
    before = rows_of(read_silver(spark, "orders", lake.path("silver", "orders")))
    deliver(lake, "day1", orders=[order("o1", quantity=7)])
    broken = lambda kept, changes, spec: kept.withColumn("quantity", F.raise_error(F.lit("disk lost")).cast("int"))
    with monkeypatch.context() as patch:
        patch.setattr(silver_delta, "touched_rows", broken)
        with pytest.raises(Exception, match="disk lost"):
            daily(spark, lake, 1)
    assert rows_of(read_silver(spark, "orders", lake.path("silver", "orders"))) == before
    _, day = daily(spark, lake, 1)
    check_layers(spark, lake, day)


def test_gold_is_copied_before_it_becomes_current(spark, lake, path):
    from stratalake.sources.sinks import Target

    def targets(table):
        return [Target("parquet", {"path": path("copy", table)})]

    daily(spark, lake, 0, targets=targets)
    deliver(lake, "day1", orders=[order("o1", quantity=7)])
    daily(spark, lake, 1, targets=targets)
    for name in ("daily_revenue_by_channel", "customer_metrics", "product_performance"):
        assert rows_of(spark.read.parquet(path("copy", name))) == rows_of(read_gold(spark, lake.path("gold", name)))


def test_versions_published_at_once(spark, lake):
    first = full_run.run(spark, lake, ingested_at=DAY, at_once=True)
    assert first.silver == {"orders": 2, "customers": 1, "products": 1} and first.gold["customer_metrics"] == 2
    check_layers(spark, lake, DAY.date())
    second = full_run.run(spark, lake, ingested_at=DAY + timedelta(days=1), at_once=True)
    assert second.silver == first.silver
    check_layers(spark, lake, (DAY + timedelta(days=1)).date())
    # afterwards a delta finds what is new, and Gold is built in full once
    bronze_path = lake.path("bronze", "orders")
    write_file(f"{lake.path('landing', 'orders')}/more.csv", [order("o77")], header("orders"))
    bronze.ingest(spark, "orders", lake.path("landing", "orders"), bronze_path, ingested_at=DAY + timedelta(days=2), source_name="x")
    assert silver_delta.refresh(spark, "orders", bronze_path, lake.path("silver", "orders")).version == 3
    done = gold_delta.update(spark, lake.path("silver"), lake.path("gold"), "daily_revenue")
    assert (done.version, done.groups) == (3, 2)


def test_command_line_of_the_daily_path(spark, lake, path):
    from stratalake.__main__ import main

    done = main(["run", "--root", lake.root, "--incremental", "--ingested-at", "2024-06-01T12:00:00+00:00"])
    assert done.silver["orders"].added == 2
    common = ["--table", "orders", "--landing", lake.path("landing", "orders"), "--bronze", path("b")]
    options = ["--dead-letter", path("dead"), "--strict", "--lineage", "landing", "--check-header", "--multi-line"]
    done = main(["bronze-new", *common, "--progress", path("progress"), *options])
    assert (done.rows, done.rejected) == (6, 2)
    common[-1] = path("c")
    assert main(["bronze-arrivals", *common, "--by-header", "--files-per-step", "1"]).rows == 6
    for table in TABLES:
        main(["silver-delta", "--table", table, "--bronze", lake.path("bronze", table), "--silver", path("silver", table)])
    done = main(["gold-delta", "--job", "all", "--silver", path("silver"), "--gold", path("gold"), "--as-of", "2024-06-01"])
    assert {job: update.rows for job, update in done.items()} == {"daily_revenue": 2, "customer_metrics": 2, "product_performance": 1}
    assert main(["silver-delta", "--rebuild", "--table", "orders", "--bronze", path("c"), "--silver", path("silver", "orders")]).version == 2


def test_a_lost_progress_folder_is_noticed(spark, path):
    from stratalake.streaming.incremental import ingest_new_files

    write_file(path("landing", "a.csv"), [order("o1")], header("orders"))
    ingest_new_files(spark, "orders", path("landing"), path("bronze"), path("progress"))
    storage.delete(spark, path("progress"))
    with pytest.raises(ValueError, match="lost"):
        ingest_new_files(spark, "orders", path("landing"), path("bronze"), path("progress"))


def test_many_fresh_rows_meet_the_earlier_ones_in_one_join(spark, path, monkeypatch):
    keys = ["a", "b", "c", "d"]
    old = [order(k, quantity=q) for k, q in zip(keys, (1, 2, 3, 4), strict=True)]
    batch(spark, path, 1, *old)
    refreshed(spark, path)
    earlier = snapshots.read_parts(spark, path("silver"), ORDERS.silver, snapshots.current(spark, path("silver")))
    names = [n for n in ORDERS.silver.names if n not in ORDERS.derived]
    later, before = F.expr("_ingested_at + interval 1 day"), F.expr("_ingested_at - interval 1 day")
    rows = earlier.select(*names)
    fresh = (
        rows.where("order_id = 'a'").withColumn("_ingested_at", later)
        .union(rows.where("order_id = 'b'").withColumn("_ingested_at", before))
        .union(rows.where("order_id = 'c'").withColumn("status", F.lit(None).cast("string")))
        .union(rows.where("order_id = 'd'"))
        .union(rows.where("order_id = 'a'").withColumn("order_id", F.lit("new")))
    )
    fresh.write.parquet(path("fresh"))
    fresh = spark.read.parquet(path("fresh"))
    few = rows_of(silver_delta.changed_rows(earlier, fresh, ORDERS))
    monkeypatch.setattr(silver_delta, "MOST_KEYS", 0)
    many = silver_delta.changed_rows(earlier, fresh, ORDERS)
    assert rows_of(many) == few and many.where("_change = 'added'").count() == 2 and many.count() == 3
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(silver_delta.changed_rows(earlier, fresh, ORDERS))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange") == 2 and "REBALANCE" not in text  # fresh rows by key, earlier rows by key


def test_rows_added_to_one_batch_are_not_gathered_by_date(spark, path):
    batch(spark, path, 0, order("a"))
    refreshed(spark, path)
    earlier = snapshots.read_parts(spark, path("silver"), ORDERS.silver, snapshots.current(spark, path("silver")))
    earlier.drop("net_revenue").withColumn("_change", F.lit("added")).write.parquet(path("changes"))
    assert "REBALANCE" not in plan(silver_delta.touched_rows(earlier, spark.read.parquet(path("changes")), ORDERS))
