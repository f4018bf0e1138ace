"""All layers end to end, and the command line."""

from datetime import date, datetime, timezone

import pytest
from pyspark import TaskContext
from test_bronze import write_file

from stratalake.__main__ import main
from stratalake.plans import bronze, full_run, silver
from stratalake.sources import star_landing as star
from stratalake.sources.layers import read_bronze, read_silver
from stratalake.sources.sinks import write_batch, write_partitioned
from stratalake.tables import TABLES

NOON = datetime(2024, 6, 1, 12, tzinfo=timezone.utc)
LINES = {
    "orders": [
        "o1,c1,p1,2024-05-01,2,10.0,,online,Completed",
        "o1,c1,p1,2024-05-01,2,10.0,,online,Completed",
        "o2,c9,p1,2024-05-02,1,10.0,0.5, store ,SHIPPED ",
        "o3,c1,p2,2024-05-02,0,10.0,0.5,store,shipped",
        "o4,c1,p2,2024-05-02,many,10.0,0.5,store,shipped",
        ",c1,p2,2024-05-02,1,10.0,0.5,store,shipped",
    ],
    "customers": ["c1,ann,LEE,A@B.C,peru,2020-01-01,", "c2,bo,li,,peru,2020-01-01,true"],
    "products": ["p1, Ring ,gifts,10.0,4.0", "p2,Free,gifts,0.0,4.0"],
}


def land(path):
    for table, lines in LINES.items():
        header = ",".join(TABLES[table].landing.names)
        write_file(path("lake", "landing", table, "a.csv"), lines, header)
    return full_run.Lake(path("lake"))


def test_full_run(spark, path):
    lake = land(path)
    result = full_run.run(spark, lake, dead_letters=True, ingested_at=NOON)
    assert result.bronze["orders"] == bronze.IngestResult("orders", date(2024, 6, 1), 6, 1)
    assert result.silver == {"orders": 2, "customers": 1, "products": 1}
    assert result.gold == {
        "daily_revenue_by_channel": 2, "customer_metrics": 2, "product_performance": 1,
    }
    daily = spark.read.parquet(lake.path("gold", "daily_revenue_by_channel")).collect()
    assert sorted((str(r.order_date), r.channel, r.total_revenue) for r in daily) == [
        ("2024-05-01", "ONLINE", 20.0),
        ("2024-05-02", "STORE", 5.0),
    ]
    people = spark.read.parquet(lake.path("gold", "customer_metrics")).collect()
    assert {(r.customer_id, r.first_name, r.recency_days) for r in people} == {
        ("c1", "Ann", 31),
        ("c9", None, 30),
    }
    performance = spark.read.parquet(lake.path("gold", "product_performance")).collect()[0]
    assert (performance.total_revenue, performance.gross_profit) == (25.0, 13.0)


def test_running_a_day_again_changes_nothing(spark, path):
    lake = land(path)
    first = full_run.run(spark, lake, ingested_at=NOON)
    assert full_run.run(spark, lake, ingested_at=NOON) == first
    assert read_bronze(spark, "orders", lake.path("bronze", "orders")).count() == 6


def test_next_day_updates_without_losing_history(spark, path):
    lake = land(path)
    full_run.run(spark, lake, ingested_at=NOON)
    header = ",".join(TABLES["orders"].landing.names)
    write_file(
        path("lake", "landing", "orders", "a.csv"),
        ["o1,c1,p1,2024-05-01,5,10.0,,online,Completed"],
        header,
    )
    full_run.run(spark, lake, ingested_at=NOON.replace(day=2))
    rows = read_silver(spark, "orders", lake.path("silver", "orders")).collect()
    assert sorted((r.order_id, r.quantity, r._batch_date.day) for r in rows) == [
        ("o1", 5, 2),
        ("o2", 1, 1),
    ]


def test_tasks_that_fail_and_rerun_change_neither_rows_nor_counts(spark, path):
    def fails_once(batches):
        """Pass data on, then fail the first attempt of every second task."""
        yield from batches
        task = TaskContext.get()
        if task.attemptNumber() == 0 and task.partitionId() % 2 == 0:
            raise RuntimeError("first attempt lost")

    rows = star.staged_orders(spark, "/root/testdata/sf0.001").repartition(4)
    spark.sparkContext.setLogLevel("OFF")
    expected = sorted(map(str, silver.refined(rows, "orders").collect()))
    assert write_batch(rows.mapInArrow(fails_once, rows.schema), path("b"), NOON.date()) == {
        "rows": 6000
    }
    assert spark.read.parquet(path("b")).count() == 6000
    before = silver.refined(rows.mapInArrow(fails_once, rows.schema), "orders")
    after = silver.refined(rows, "orders")
    after = after.mapInArrow(fails_once, after.schema)
    for name, df in (("before", before), ("after", after)):
        assert write_partitioned(df, path(name)) == len(expected)
        stored = spark.read.parquet(path(name)).select(*df.columns)
        assert sorted(map(str, stored.collect())) == expected


def test_command_line_layers(spark, path):
    lake = land(path)
    for table in TABLES:
        result = main(
            ["bronze", "--table", table, "--landing", lake.path("landing", table),
             "--bronze", lake.path("bronze", table), "--ingested-at", "2024-06-01T12:00:00+00:00",
             "--dead-letter", lake.path("dead", table), "--check-header", "--lineage", "file"]
        )
        assert result.rows == len(LINES[table])
        main(
            ["silver", "--table", table, "--bronze", lake.path("bronze", table),
             "--silver", lake.path("silver", table)]
        )
    written = main(
        ["gold", "--job", "customer_metrics", "--silver", lake.path("silver"),
         "--gold", lake.path("gold"), "--as-of", "2024-06-01"]
    )
    assert written == {"customer_metrics": 2}


def test_command_line_run_and_words(spark, path):
    lake = land(path)
    result = main(["run", "--root", lake.root, "--ingested-at", "2024-06-01"])
    assert result.silver["orders"] == 2
    write_file(path("texts", "a.txt"), ["a b a"], header=None)
    main(["wordcount", "--texts", path("texts"), "--output", path("counts")])
    main(["merge-counts", "--partials", path("counts"), "--output", path("merged")])
    assert {r.value for r in spark.read.text(path("merged")).collect()} == {"a\t2", "b\t1"}


def test_command_line_increments(spark, path):
    lake = land(path)
    common = ["--table", "orders", "--landing", lake.path("landing", "orders")]
    common += ["--bronze", path("b"), "--progress", path("progress")]
    main(["bronze-new", *common, "--ingested-at", "2024-06-01"])
    silver_paths = ["silver", "--table", "orders", "--bronze", path("b"), "--silver"]
    assert main([*silver_paths, path("v1")]) == 2
    header = ",".join(TABLES["orders"].landing.names)
    late = ["o5,c1,p1,2024-06-01,1,10.0,,online,Completed"]
    write_file(path("lake", "landing", "orders", "b.csv"), late, header)
    main(["bronze-new", *common, "--ingested-at", "2024-06-02"])
    assert main([*silver_paths, path("v2"), "--earlier", path("v1"), "--since", "2024-06-02"]) == 3


def test_command_line_refuses_unknown_names():
    for argv in (["bronze", "--table", "returns"], ["gold", "--job", "weekly"], []):
        with pytest.raises(SystemExit):
            main(argv)
