"""Landing scans, audit columns, batches and dead letters."""

from datetime import date, datetime, timezone
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.audit import with_audit
from stratalake.plans import bronze, queries_daily
from stratalake.sources import star_landing
from stratalake.sources.landing import read_csv, read_json, read_landing
from stratalake.sources.layers import read_bronze
from stratalake.streaming.incremental import ingest_new_files
from stratalake.tables import ORDERS, TABLES, TableSpec, spec_for

EDGE = TableSpec(
    name="edge",
    key="order_id",
    landing=T.StructType()
    .add("order_id", "string", False)
    .add("quantity", "integer")
    .add("unit_price", "double")
    .add("is_active", "boolean"),
    valid=(),
    tidy={},
)
EDGE_LINES = [
    "o1,2,3.5,true",
    "o2,abc,3.5,TRUE",
    "o3,2",
    "o4,2,3.5,true,extra",
    ",2,3.5,yes",
    "",
    "  o6  ,3, 4.5 ,False",
    "o8,2.0,1e2,1",
    "o9,99999999999,NaN,t",
]
CLEAN_EDGE = {"o1", "  o6  "}

ORDER = "{},c1,p1,2024-01-15,{},17.25,0.2,online,completed"
HEADER = ",".join(ORDERS.landing.names)
DAY1 = datetime(2024, 1, 15, 8, tzinfo=timezone.utc)
DAY2 = datetime(2024, 1, 16, 8, tzinfo=timezone.utc)


def write_file(path, lines, header=HEADER):
    file = Path(path)
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text("\n".join(([header] if header else []) + lines) + "\n")


def edge_landing(path):
    write_file(path("landing", "a.csv"), EDGE_LINES, ",".join(EDGE.landing.names))
    return path("landing")


def test_schemas_match_the_landing_contract():
    assert list(TABLES) == ["orders", "customers", "products"]
    assert ORDERS.landing["quantity"].dataType == T.IntegerType()
    assert ORDERS.landing["unit_price"].dataType == T.DoubleType()
    assert not ORDERS.landing["order_id"].nullable
    assert spec_for("customers").landing["is_active"].dataType == T.BooleanType()
    assert spec_for("products").landing.names == [
        "product_id", "product_name", "category", "unit_price", "unit_cost",
    ]
    with pytest.raises(ValueError, match="unknown table"):
        spec_for("returns")


def test_csv_edge_lines(spark, path):
    rows = {r.order_id: r for r in read_csv(spark, EDGE, edge_landing(path)).collect()}
    assert len(rows) == 8  # the blank line is skipped
    assert rows["o1"][1:] == (2, 3.5, True)
    assert rows["o2"][1:] == (None, 3.5, True)
    assert rows["o3"][1:] == (2, None, None)
    assert rows["o4"][1:] == (2, 3.5, True)
    assert rows[None][1:] == (2, 3.5, None)
    assert rows["  o6  "][1:] == (3, 4.5, False)
    assert rows["o8"][1:] == (None, 100.0, None)
    assert rows["o9"].quantity is None and str(rows["o9"].unit_price) == "nan"


def test_csv_schema_is_enforced_not_inferred(spark, path):
    write_file(path("landing", "a.csv"), [ORDER.format("1", "2")])
    scanned = read_csv(spark, "orders", path("landing"))
    assert [(f.name, f.dataType) for f in scanned.schema] == [
        (f.name, f.dataType) for f in ORDERS.landing
    ]
    assert all(f.nullable for f in scanned.schema)
    assert scanned.collect()[0].order_id == "1"


def test_csv_binds_by_position_unless_the_header_is_checked(spark, path):
    write_file(path("landing", "a.csv"), ["5,oX,1.0,true"], "quantity,order_id,unit_price,is_active")
    row = read_csv(spark, EDGE, path("landing")).collect()[0]
    assert (row.order_id, row.quantity) == ("5", None)
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, EDGE, path("landing"), check_header=True).collect()


def test_csv_multi_line(spark, path):
    write_file(path("landing", "a.csv"), ['"o7', 'x",1,1.0,true'], ",".join(EDGE.landing.names))
    assert read_csv(spark, EDGE, path("landing")).count() == 2
    rows = read_csv(spark, EDGE, path("landing"), multi_line=True).collect()
    assert [r.order_id for r in rows] == ["o7\nx"]


def test_json_scan_keeps_bad_records_as_null(spark, path):
    lines = ['{"order_id":"o1","quantity":2}', '{"order_id":"o2","quantity":"abc"}', "{bad"]
    write_file(path("landing", "a.json"), lines, header=None)
    scanned = read_json(spark, EDGE, path("landing"), keep_rejects=True)
    rows = sorted(map(tuple, scanned.collect()), key=str)
    assert sorted(r[:2] for r in rows if r[0]) == [("o1", 2), ("o2", None)]
    assert sorted(r[-1] for r in rows if r[-1]) == [lines[1], "{bad"]
    assert read_landing(spark, EDGE, path("landing"), "json").count() == 3
    with pytest.raises(ValueError, match="unknown landing format"):
        read_landing(spark, EDGE, path("landing"), "xml")


def test_every_row_carries_its_batch(spark):
    rows = [("line-8", "c", "p", "2024-03-02", 4, 17.25, 0.2, "partner", "shipped")]
    df = with_audit(spark.createDataFrame(rows, ORDERS.landing), "landing/orders/", DAY1)
    assert df.columns[-3:] == ["_ingested_at", "_source_file", "_batch_date"]
    row = df.withColumn("t", F.unix_timestamp("_ingested_at")).collect()[0]
    assert (row.t, row._batch_date) == (int(DAY1.timestamp()), date(2024, 1, 15))
    assert row._source_file == "landing/orders/"


def test_audit_clock_defaults_to_now_and_is_one_per_call(spark):
    before = datetime.now(timezone.utc)
    df = with_audit(spark.range(0, 1000, 1, 8), "x").select(
        F.unix_timestamp("_ingested_at").alias("t")
    )
    moments = {r.t for r in df.collect()}
    assert len(moments) == 1
    assert int(before.timestamp()) <= moments.pop() <= datetime.now(timezone.utc).timestamp()


def test_an_ingest_keeps_and_counts_every_line(spark, path):
    write_file(path("landing", "a.csv"), [ORDER.format(f"B/{i}", i) for i in (11, 12, 29)])
    result = bronze.ingest(spark, "orders", path("landing"), path("bronze"), ingested_at=DAY1)
    assert result == bronze.IngestResult("orders", date(2024, 1, 15), 3, 0)
    stored = read_bronze(spark, "orders", path("bronze"))
    assert stored.count() == 3
    assert {r._source_file for r in stored.collect()} == {path("landing")}


def test_malformed_rows_stay_in_bronze_without_dead_letter_path(spark, path):
    result = bronze.ingest(spark, EDGE, edge_landing(path), path("bronze"), ingested_at=DAY1)
    assert (result.rows, result.rejected) == (8, 0)
    assert read_bronze(spark, EDGE, path("bronze")).count() == 8


def test_empty_landing(spark, path):
    write_file(path("landing", "a.csv"), [])
    result = bronze.ingest(
        spark, "orders", path("landing"), path("bronze"), dead_letter=path("dead"), ingested_at=DAY1
    )
    assert (result.rows, result.rejected) == (0, 0)
    assert read_bronze(spark, "orders", path("bronze")).count() == 0


def test_batches_are_kept_and_a_rerun_replaces_its_own(spark, path):
    landing, stored = path("landing"), path("bronze")
    write_file(path("landing", "a.csv"), [ORDER.format("a", 1), ORDER.format("b", 1)])
    bronze.ingest(spark, "orders", landing, stored, ingested_at=DAY1)
    bronze.ingest(spark, "orders", landing, stored, ingested_at=DAY2)
    write_file(path("landing", "a.csv"), [ORDER.format("c", 1)])
    bronze.ingest(spark, "orders", landing, stored, ingested_at=DAY2)
    rows = read_bronze(spark, "orders", stored).collect()
    assert sorted((r._batch_date.day, r.order_id) for r in rows) == [(15, "a"), (15, "b"), (16, "c")]
    late = read_bronze(spark, "orders", stored, since=DAY2.date())
    assert [r.order_id for r in late.collect()] == ["c"]
    assert "PartitionFilters: [isnotnull(_batch_date" in explained(late)


def explained(df):
    import contextlib
    import io

    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def test_file_lineage(spark, path):
    write_file(path("landing", "a.csv"), [ORDER.format("a", 1)])
    write_file(path("landing", "b.csv"), [ORDER.format("b", 1)])
    bronze.ingest(spark, "orders", path("landing"), path("bronze"), lineage="file")
    sources = {
        r.order_id: r._source_file.rsplit("/", 1)[1]
        for r in read_bronze(spark, "orders", path("bronze")).collect()
    }
    assert sources == {"a": "a.csv", "b": "b.csv"}


def test_dead_letters_and_accepted_rows_make_up_the_landing(spark, path):
    result = bronze.ingest(
        spark, EDGE, edge_landing(path), path("bronze"), dead_letter=path("dead"), ingested_at=DAY1
    )
    assert (result.rows, result.rejected) == (8, 6)
    accepted = read_bronze(spark, EDGE, path("bronze"))
    letters = bronze.read_dead_letters(spark, EDGE, path("dead"))
    # A narrow select and a bare count must agree with the full rows.
    assert {r.order_id for r in accepted.select("order_id").collect()} == CLEAN_EDGE
    assert accepted.count() == 2 and letters.count() == 6
    texts = {r[0] for r in letters.select("_corrupt_record").collect()}
    assert texts | {"o1,2,3.5,true", "  o6  ,3, 4.5 ,False", ""} == set(EDGE_LINES)
    assert {r._batch_date for r in letters.collect()} == {DAY1.date()}


def test_dead_letters_of_a_repaired_batch_disappear(spark, path):
    landing = edge_landing(path)
    paths = {"dead_letter": path("dead"), "ingested_at": DAY1}
    bronze.ingest(spark, EDGE, landing, path("bronze"), **paths)
    write_file(path("landing", "a.csv"), ["o1,2,3.5,true"], ",".join(EDGE.landing.names))
    result = bronze.ingest(spark, EDGE, landing, path("bronze"), **paths)
    assert (result.rows, result.rejected) == (1, 0)
    assert bronze.read_dead_letters(spark, EDGE, path("dead")).count() == 0


def test_json_dead_letters(spark, path):
    lines = ['{"order_id":"o1","quantity":2}', '{"order_id":"o2","quantity":"abc"}', "{bad"]
    write_file(path("landing", "a.json"), lines, header=None)
    result = bronze.ingest(
        spark, EDGE, path("landing"), path("bronze"), file_format="json", dead_letter=path("dead")
    )
    assert (result.rows, result.rejected) == (3, 2)
    letters = bronze.read_dead_letters(spark, EDGE, path("dead"))
    assert {r._corrupt_record for r in letters.collect()} == set(lines[1:])


def test_missing_key_is_rejected_only_when_strict(spark, path):
    write_file(path("landing", "a.csv"), [ORDER.format("", 1), ORDER.format("a", 1)])
    common = {"dead_letter": path("dead"), "ingested_at": DAY1}
    result = bronze.ingest(spark, "orders", path("landing"), path("bronze"), **common)
    assert (result.rows, result.rejected) == (2, 0)
    result = bronze.ingest(
        spark, "orders", path("landing"), path("bronze"), strict=True, **common
    )
    assert (result.rows, result.rejected) == (2, 1)
    letter = bronze.read_dead_letters(spark, "orders", path("dead")).collect()[0]
    assert letter._corrupt_record == ORDER.format("", 1)
    with pytest.raises(ValueError, match="strict needs"):
        bronze.ingest(spark, "orders", path("landing"), path("bronze"), strict=True)


def test_batches_with_and_without_reject_marker_read_together(spark, path):
    landing = edge_landing(path)
    bronze.ingest(spark, EDGE, landing, path("bronze"), ingested_at=DAY1)
    bronze.ingest(spark, EDGE, landing, path("bronze"), dead_letter=path("dead"), ingested_at=DAY2)
    per_day = read_bronze(spark, EDGE, path("bronze")).groupBy("_batch_date").count()
    assert {r[0].day: r[1] for r in per_day.collect()} == {15: 8, 16: 2}


def test_source_and_target_must_differ(spark, path):
    with pytest.raises(ValueError, match="same path"):
        bronze.ingest(spark, "orders", path("x"), path("x") + "/")


def test_incremental_ingest_reads_each_file_once(spark, path):
    args = (spark, "orders", path("landing"), path("bronze"), path("progress"))
    write_file(path("landing", "a.csv"), [ORDER.format("a", 1), ORDER.format("b", "x")])
    first = ingest_new_files(*args, ingested_at=DAY1, dead_letter=path("dead"))
    assert (first.rows, first.rejected) == (2, 1)
    write_file(path("landing", "b.csv"), [ORDER.format("c", 1)])
    write_file(path("landing", "c.csv"), [ORDER.format("d", 1)])
    old = DAY1.timestamp() - 30 * 86_400
    os.utime(path("landing", "c.csv"), (old, old))
    second = ingest_new_files(*args, ingested_at=DAY2, files_per_step=1, dead_letter=path("dead"))
    assert (second.rows, second.rejected) == (2, 0)
    assert ingest_new_files(*args, ingested_at=DAY2, dead_letter=path("dead")).rows == 0
    letters = bronze.read_dead_letters(spark, "orders", path("dead")).collect()
    assert [(r._corrupt_record, r._batch_date.day) for r in letters] == [(ORDER.format("b", "x"), 15)]
    rows = read_bronze(spark, "orders", path("bronze")).collect()
    assert sorted((r.order_id, r._batch_date.day) for r in rows) == [("a", 15), ("c", 16), ("d", 16)]
    assert {r._source_file.rsplit("/", 1)[1] for r in rows} == {"a.csv", "b.csv", "c.csv"}


def test_incremental_ingest_keeps_damaged_rows_without_letters(spark, path):
    write_file(path("landing", "a.csv"), [ORDER.format("a", 1), ORDER.format("b", "x"), ORDER.format("c", 2) + ",more"])
    done = ingest_new_files(spark, "orders", path("landing"), path("bronze"), path("progress"), ingested_at=DAY1)
    assert (done.rows, done.rejected) == (3, 0)
    rows = {r.order_id: r.quantity for r in read_bronze(spark, "orders", path("bronze")).collect()}
    assert rows == {"a": 1, "b": None, "c": 2}


def test_a_step_that_failed_before_its_commit_is_replaced(spark, path):
    args = (spark, "orders", path("landing"), path("bronze"), path("progress"))
    write_file(path("landing", "a.csv"), [ORDER.format("a", 1), ORDER.format("b", "x")])
    ingest_new_files(*args, ingested_at=DAY1, dead_letter=path("dead"))
    for name in ("0", ".0.crc"):  # as if the driver had stopped before the commit
        (Path(path("progress")) / "commits" / name).unlink(missing_ok=True)
    again = ingest_new_files(*args, ingested_at=DAY2, dead_letter=path("dead"))
    assert (again.rows, again.rejected) == (2, 1)
    rows = read_bronze(spark, "orders", path("bronze")).collect()
    assert [(r.order_id, r._batch_date.day) for r in rows] == [("a", 16)]
    letters = bronze.read_dead_letters(spark, "orders", path("dead")).collect()
    assert [r._batch_date.day for r in letters] == [16]


def test_the_two_ingests_refuse_each_others_paths(spark, path):
    write_file(path("landing", "a.csv"), [ORDER.format("a", 1)])
    bronze.ingest(spark, "orders", path("landing"), path("batch"), ingested_at=DAY1)
    with pytest.raises(ValueError, match="another kind of ingest"):
        ingest_new_files(spark, "orders", path("landing"), path("batch"), path("p1"))
    ingest_new_files(spark, "orders", path("landing"), path("steps"), path("p2"), ingested_at=DAY1)
    with pytest.raises(ValueError, match="another kind of ingest"):
        bronze.ingest(spark, "orders", path("landing"), path("steps"), ingested_at=DAY1)


def star_tables(spark, path, lines):
    spark.range(lines).selectExpr(
        "id AS l_orderkey", "id % 7 AS l_partkey", "id % 3 AS l_suppkey", "cast(id % 5 AS int) AS l_linenumber",
        "double(id % 9) AS l_quantity", "double(0.01 * (id % 4)) AS l_discount", "'N' AS l_returnflag",
        "timestamp'1996-01-01' AS l_shipdate",
    ).write.parquet(path("lineitem.parquet"))
    spark.range(lines).selectExpr(
        "id AS o_orderkey", "if(id % 6 = 0, NULL, id) AS o_custkey", "'F' AS o_orderstatus", "timestamp'1996-01-01' AS o_orderdate"
    ).write.parquet(path("orders.parquet"))
    spark.range(7).selectExpr("id AS p_partkey", "double(9.5) AS p_retailprice").write.parquet(path("part.parquet"))
    return path()


def test_landing_files_follow_the_number_of_lines(spark, path, monkeypatch):
    root = star_tables(spark, path, 120)
    monkeypatch.setattr(star_landing, "LINES_PER_FILE", 10, raising=False)
    landing = queries_daily._raw_landing(spark, root, path("raw"))
    assert len([n for n in os.listdir(landing) if n.endswith(".csv")]) == 12
    monkeypatch.setattr(star_landing, "LINES_PER_FILE", 1000, raising=False)
    assert len([n for n in os.listdir(queries_daily._raw_landing(spark, root, path("few"))) if n.endswith(".csv")]) == 5


def test_raw_lines_name_each_field_once(spark, path):
    root = star_tables(spark, path, 500)
    lines = star_landing.raw_order_lines(spark, root)
    joined = star_landing._order_lines(spark, root)
    expected = joined.select(F.expr(star_landing.RAW_ORDER_LINE)).collect()
    assert sorted(r[0] for r in lines.collect()) == sorted(r[0] for r in expected)
    text = lines._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("% 29") == 1 and text.count("% 83") <= 3
