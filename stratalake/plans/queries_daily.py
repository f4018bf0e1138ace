"""Queries over the daily path and over jobs as they are run, on the star-schema test tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.operators.wordcount import merge_counts
from stratalake.plans import arrivals, bronze, full_run, gold, silver, silver_delta
from stratalake.plans.count_words import count_words
from stratalake.session import chained_jobs, scratch_dir
from stratalake.sources import star_landing as star
from stratalake.sources import storage
from stratalake.sources.landing import read_csv, read_lines
from stratalake.sources.layers import read_bronze, read_gold, read_silver
from stratalake.sources.sinks import child, write_lines, write_partitioned
from stratalake.tables import BATCH_DATE, CORRUPT, INGESTED_AT, ORDERS, SOURCE_FILE

AS_OF = date(2001, 8, 2)
LANDED_AT = datetime(2001, 8, 1, 6, tzinfo=timezone.utc)
METADATA = (INGESTED_AT, SOURCE_FILE, BATCH_DATE)
#: Deliveries of the daily runs; which one a row belongs to follows from its supplier, customer or part number.
DAYS = 3


def _number(column: str) -> Column:
    return F.regexp_extract(column, "([0-9]+)", 1).cast("long")


def _in_seconds(df: DataFrame) -> DataFrame:
    return df.withColumn(INGESTED_AT, F.unix_timestamp(INGESTED_AT))


def _early_and_late(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    staged = star.staged_orders(spark, sf_dir)
    early = F.col(BATCH_DATE) < F.lit(date(1998, 1, 1))
    return {name: staged.where(rows).select(*ORDERS.landing.names) for name, rows in (("early", early), ("late", ~early))}


def bronze_header_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries with other orders of columns, one with a column that is not declared."""
    root = scratch_dir(spark, "header-order")
    rows = _early_and_late(spark, sf_dir)
    names = ORDERS.landing.names
    star.write_csv_landing(rows["early"].select(*names[4:], *names[:4]), child(root, "early"))
    noted = rows["late"].withColumn("note", F.concat("status", F.lit("!")))
    star.write_csv_landing(noted.select(*names[:2], "note", *reversed(names[2:])), child(root, "late"))
    return read_csv(spark, "orders", [child(root, "early"), child(root, "late")], by_header=True)


def bronze_file_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row with the folder of the landing file it was read from."""
    root = scratch_dir(spark, "file-lineage")
    for name, rows in _early_and_late(spark, sf_dir).items():
        star.write_csv_landing(rows, child(root, "landing", name))
    bronze.ingest(spark, "orders", child(root, "landing", "*"), child(root, "bronze"), lineage="file", ingested_at=LANDED_AT)
    stored = read_bronze(spark, "orders", child(root, "bronze"))
    folder = F.regexp_extract(SOURCE_FILE, "/landing/([a-z]+)/part-[^/]*csv$", 1)
    return stored.select(*ORDERS.landing.names, folder.alias("folder"))


def bronze_json_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected JSON lines: what could be parsed, and whether the object was complete."""
    root = scratch_dir(spark, "json-letters")
    write_lines(star.raw_order_json(spark, sf_dir), child(root, "landing"))
    bronze.ingest(
        spark, "orders", child(root, "landing"), child(root, "bronze"),
        file_format="json", dead_letter=child(root, "letters"), ingested_at=LANDED_AT,
    )
    letters = bronze.read_dead_letters(spark, "orders", child(root, "letters"))
    return letters.select(*ORDERS.landing.names, F.col(CORRUPT).endswith("}").alias("complete"))


def _raw_landing(spark: SparkSession, sf_dir: str, root: str) -> str:
    path = child(root, "landing")
    files = star.landing_files(spark, sf_dir, least=5)
    star.write_raw_landing(star.raw_order_lines(spark, sf_dir).repartition(files), path)
    return path


def bronze_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted rows when a missing key is a reject as well."""
    root = scratch_dir(spark, "strict")
    bronze.ingest(
        spark, "orders", _raw_landing(spark, sf_dir, root), child(root, "bronze"),
        dead_letter=child(root, "letters"), strict=True, ingested_at=LANDED_AT,
    )
    return read_bronze(spark, "orders", child(root, "bronze")).select(*ORDERS.landing.names)


def _arrivals(spark: SparkSession, sf_dir: str) -> str:
    """Damaged landing files in steps of about two files, then once more without new files."""
    root = scratch_dir(spark, "arrivals")
    landing = _raw_landing(spark, sf_dir, root)
    for _ in range(2):
        arrivals.ingest_arrivals(
            spark, "orders", landing, child(root, "bronze"), dead_letter=child(root, "letters"),
            lineage="landing", source_name="landing/orders", ingested_at=LANDED_AT, files_per_step=2,
        )
    return root


def bronze_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_bronze(spark, "orders", child(_arrivals(spark, sf_dir), "bronze")).select(*ORDERS.landing.names)


def bronze_arrivals_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = bronze.read_dead_letters(spark, "orders", child(_arrivals(spark, sf_dir), "letters"))
    return letters.select(
        F.col(CORRUPT).alias("raw_line"), F.col(SOURCE_FILE).alias("source_file"), F.col(BATCH_DATE).alias("batch_date")
    )


def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver kept up to date over three deliveries of monthly batches, the second of them older than the first."""
    root = scratch_dir(spark, "silver-delta")
    staged = star.staged_orders(spark, sf_dir)
    year = F.year(BATCH_DATE)
    for rows in (year <= 1994, year >= 1997, (year > 1994) & (year < 1997)):
        batches = staged.where(rows).hint("rebalance", F.col(BATCH_DATE))
        batches.write.mode("append").partitionBy(BATCH_DATE).parquet(child(root, "bronze"))
        silver_delta.refresh(spark, "orders", child(root, "bronze"), child(root, "silver"))
    return _in_seconds(read_silver(spark, "orders", child(root, "silver")))


def _daily_run(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Three days of deliveries through every layer; later ones redeliver lines, customers and products."""
    lake = full_run.Lake(scratch_dir(spark, "daily"))
    orders = star.staged_orders(spark, sf_dir).withColumn("day", F.pmod(_number(SOURCE_FILE), F.lit(DAYS)))
    customers, products = star.staged_customers(spark, sf_dir), star.staged_products(spark, sf_dir)
    customer, part = _number("customer_id"), _number("product_id")
    late = customers.where(customer % 5 == 0).withColumn("country", F.lit("late land"))
    cheaper = products.where(part % 7 == 0).withColumn("unit_cost", F.col("unit_cost") * 0.5)
    deliveries = [
        {"customers": customers, "products": products.where(part % 4 != 0)},
        {"products": products.where(part % 4 == 0)},
        {"customers": late, "products": cheaper},
    ]
    # The lines of all days are joined once and wait outside the landing folder for their day.
    waiting = child(lake.root, "waiting")
    with chained_jobs(spark):
        star.write_csv_landing(orders.where("day IS NOT NULL").drop(*METADATA), waiting, by="day", compression="gzip")
    for day, delivered in enumerate(deliveries):
        storage.move(spark, child(waiting, f"day={day}"), child(lake.path("landing", "orders"), f"day-{day}"))
        for name, rows in delivered.items():
            landing = child(lake.path("landing", name), f"day-{day}")
            star.write_csv_landing(rows.drop(*METADATA), landing, compression="gzip")
        full_run.run(spark, lake, ingested_at=LANDED_AT + timedelta(days=day), as_of=AS_OF, incremental=True)
    return read_gold(spark, lake.path("gold", table))


def full_run_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily_run(spark, sf_dir, "daily_revenue_by_channel")


def full_run_incremental_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily_run(spark, sf_dir, "customer_metrics")


def full_run_incremental_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_seconds(_daily_run(spark, sf_dir, "product_performance").drop(SOURCE_FILE))


def _stored_silver(spark: SparkSession, sf_dir: str, root: str) -> str:
    stages = {"orders": star.staged_orders, "customers": star.staged_customers, "products": star.staged_products}
    for table, stage in stages.items():
        write_partitioned(silver.refined(stage(spark, sf_dir), table), child(root, "silver", table))
    return child(root, "silver")


def silver_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by the codec that the names of the stored files state."""
    root = scratch_dir(spark, "codec")
    stored = read_silver(spark, "orders", child(_stored_silver(spark, sf_dir, root), "orders"))
    codec = F.regexp_extract("_metadata.file_name", r"\.([a-z0-9]+)\.parquet$", 1)
    return stored.select(codec.alias("codec")).groupBy("codec").agg(F.count(F.lit(1)).alias("rows"))


def gold_daily_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily revenue with each row's place in the stored files, taken in the order of their names."""
    root = scratch_dir(spark, "gold-order")
    gold.build(spark, _stored_silver(spark, sf_dir, root), child(root, "gold"), "daily_revenue", as_of=AS_OF)
    stored = spark.read.parquet(child(root, "gold", "daily_revenue_by_channel"))
    place = F.row_number().over(Window.orderBy(F.col("_metadata.file_name"), F.col("_metadata.row_index")))
    return stored.select("order_date", "channel", "total_revenue", place.alias("place"))


def gold_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All Gold tables by one call: rows and total revenue in cents of each."""
    root = scratch_dir(spark, "gold-all")
    written = gold.build(spark, _stored_silver(spark, sf_dir, root), child(root, "gold"), "all", as_of=AS_OF)
    found = None
    for table, rows in written.items():
        revenue = "lifetime_value_usd" if table == "customer_metrics" else "total_revenue"
        total = F.sum(F.round(F.col(revenue) * 100).cast("long")).alias("cents")
        stored = spark.read.parquet(child(root, "gold", table)).agg(F.count(F.lit(1)).alias("rows"), total)
        stored = stored.select(F.lit(table).alias("table_name"), "rows", F.lit(rows).cast("long").alias("reported"), "cents")
        found = stored if found is None else found.union(stored)
    return found


def command_line_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files through every layer by the command line; customer metrics at the end."""
    from stratalake.__main__ import main  # it imports the jobs that this module is part of

    lake = full_run.Lake(scratch_dir(spark, "command-line"))
    stages = {"orders": star.staged_orders, "customers": star.staged_customers, "products": star.staged_products}
    for table, stage in stages.items():
        star.write_csv_landing(stage(spark, sf_dir).drop(*METADATA), lake.path("landing", table))
    main(["run", "--root", lake.root, "--dead-letters", "--ingested-at", LANDED_AT.isoformat(), "--as-of", AS_OF.isoformat()])
    return spark.read.parquet(lake.path("gold", "customer_metrics"))


def word_count_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files to files of word counts, read back."""
    root = scratch_dir(spark, "word-count-job")
    texts = star.star_table(spark, sf_dir, "documents").select("text").where("text IS NOT NULL")
    write_lines(texts, child(root, "texts"))
    count_words(spark, child(root, "texts"), child(root, "counts"))
    return merge_counts(read_lines(spark, child(root, "counts")))


DAILY_QUERIES = {
    "bronze_header_order": bronze_header_order,
    "bronze_file_lineage": bronze_file_lineage,
    "bronze_json_dead_letter": bronze_json_dead_letter,
    "bronze_strict": bronze_strict,
    "bronze_arrivals": bronze_arrivals,
    "bronze_arrivals_dead_letter": bronze_arrivals_dead_letter,
    "silver_incremental": silver_incremental,
    "silver_codec": silver_codec,
    "gold_daily_order": gold_daily_order,
    "gold_all": gold_all,
    "full_run_incremental": full_run_incremental,
    "full_run_incremental_customers": full_run_incremental_customers,
    "full_run_incremental_products": full_run_incremental_products,
    "command_line_run": command_line_run,
    "word_count_job": word_count_job,
}
