"""Every operator as a query over the star-schema test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.labels import churn_risk, ltv_tier
from stratalake.functions.text import tokens
from stratalake.operators import rollups
from stratalake.operators.audit import with_audit
from stratalake.operators.cleaning import apply_rules
from stratalake.operators.dedup import latest_per_key
from stratalake.operators.wordcount import as_tsv, merge_counts, word_count
from stratalake.plans import bronze, full_run, gold, silver
from stratalake.plans.queries_daily import DAILY_QUERIES
from stratalake.session import scratch_dir
from stratalake.sources import star_landing as star
from stratalake.sources.landing import read_csv, read_json, read_lines
from stratalake.sources.layers import read_bronze, read_silver
from stratalake.sources.sinks import Target, child, write_lines, write_partitioned
from stratalake.streaming.incremental import ingest_new_files
from stratalake.tables import BATCH_DATE, CORRUPT, INGESTED_AT, ORDERS, PRODUCTS, SOURCE_FILE

AS_OF = date(2001, 8, 2)
LANDED_AT = datetime(2001, 8, 1, 6, tzinfo=timezone.utc)

Query = Callable[[SparkSession, str], DataFrame]

_METADATA = (INGESTED_AT, SOURCE_FILE, BATCH_DATE)


def _landing_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.staged_orders(spark, sf_dir).select(*ORDERS.landing.names)


def _silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.refined(star.staged_orders(spark, sf_dir), "orders")


def _silver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.refined(star.staged_customers(spark, sf_dir), "customers")


def _silver_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.refined(star.staged_products(spark, sf_dir), "products")


def _in_seconds(df: DataFrame) -> DataFrame:
    """The ingest time as whole seconds, which every SQL engine can state alike."""
    return df.withColumn(INGESTED_AT, F.unix_timestamp(INGESTED_AT))


def _raw_landing(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_dir(spark, "raw-landing")
    star.write_raw_landing(star.raw_order_lines(spark, sf_dir), path)
    return path


# Bronze


def bronze_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv-landing")
    star.write_csv_landing(_landing_orders(spark, sf_dir), path)
    return read_csv(spark, "orders", path, check_header=True)


def bronze_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_csv(spark, "orders", _raw_landing(spark, sf_dir))


def bronze_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "json-landing")
    write_lines(star.raw_order_json(spark, sf_dir), path)
    return read_json(spark, "orders", path)


def bronze_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    audited = with_audit(_landing_orders(spark, sf_dir), "landing/orders", LANDED_AT)
    return audited.select(
        "order_id",
        F.unix_timestamp(INGESTED_AT).alias("ingested_at_seconds"),
        F.col(SOURCE_FILE).alias("source_file"),
        F.col(BATCH_DATE).alias("batch_date"),
    )


def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines shipped before and from 1998 on as two batches, the second ingested twice."""
    root = scratch_dir(spark, "bronze-roundtrip")
    staged = star.staged_orders(spark, sf_dir)
    early = F.col(BATCH_DATE) < F.lit(date(1998, 1, 1))
    batches = [("early", early, datetime(1998, 1, 1)), ("late", ~early, datetime(2002, 1, 1))]
    for name, rows, _ in batches:
        landing = child(root, "landing", name)
        star.write_csv_landing(staged.where(rows).select(*ORDERS.landing.names), landing)
    for name, _, moment in [*batches, batches[-1]]:
        bronze.ingest(
            spark,
            "orders",
            child(root, "landing", name),
            child(root, "bronze"),
            source_name=f"landing/{name}",
            ingested_at=moment,
        )
    stored = read_bronze(spark, "orders", child(root, "bronze"))
    return _in_seconds(stored)


def _dead_letter_run(spark: SparkSession, sf_dir: str) -> tuple[str, str, bronze.IngestResult]:
    root = scratch_dir(spark, "dead-letter")
    stored, rejected = child(root, "bronze"), child(root, "dead_letter")
    result = bronze.ingest(
        spark,
        "orders",
        _raw_landing(spark, sf_dir),
        stored,
        dead_letter=rejected,
        source_name="landing/orders",
        ingested_at=LANDED_AT,
    )
    return stored, rejected, result


def bronze_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected, _ = _dead_letter_run(spark, sf_dir)
    letters = bronze.read_dead_letters(spark, "orders", rejected)
    return letters.select(
        F.col(CORRUPT).alias("raw_line"),
        F.col(SOURCE_FILE).alias("source_file"),
        F.col(BATCH_DATE).alias("batch_date"),
    )


def bronze_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, _, _ = _dead_letter_run(spark, sf_dir)
    return read_bronze(spark, "orders", stored).select(*ORDERS.landing.names)


def bronze_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, result = _dead_letter_run(spark, sf_dir)
    return spark.createDataFrame(
        [(result.table, result.batch, result.rows, result.rejected)],
        "table_name string, batch_date date, rows bigint, rejected bigint",
    )


def _incremental_run(spark: SparkSession, sf_dir: str, with_letters: bool) -> tuple[str, str]:
    """The damaged CSV landing consumed by the incremental ingest, then once more without new files."""
    root = scratch_dir(spark, "incremental")
    letters = child(root, "letters") if with_letters else None
    landing = _raw_landing(spark, sf_dir)
    for _ in range(2):
        ingest_new_files(
            spark,
            "orders",
            landing,
            child(root, "bronze"),
            child(root, "progress"),
            dead_letter=letters,
            lineage="landing",
            source_name="landing/orders",
            ingested_at=LANDED_AT,
        )
    return child(root, "bronze"), letters


def bronze_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, _ = _incremental_run(spark, sf_dir, with_letters=False)
    return read_bronze(spark, "orders", stored).select(*ORDERS.landing.names)


def bronze_incremental_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, letters = _incremental_run(spark, sf_dir, with_letters=True)
    return bronze.read_dead_letters(spark, "orders", letters).select(
        F.col(CORRUPT).alias("raw_line"),
        F.col(SOURCE_FILE).alias("source_file"),
        F.col(BATCH_DATE).alias("batch_date"),
    )


# Silver


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_seconds(_silver_orders(spark, sf_dir))


def silver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_seconds(_silver_customers(spark, sf_dir))


def silver_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_seconds(_silver_products(spark, sf_dir))


def silver_net_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = apply_rules(star.staged_orders(spark, sf_dir), ORDERS)
    return lines.select(
        "order_id", SOURCE_FILE, "quantity", "unit_price", "discount_pct", "net_revenue"
    )


def silver_margin_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(star.staged_products(spark, sf_dir), PRODUCTS).select(
        "product_id", "unit_price", "unit_cost", "margin_pct"
    )


def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest delivery per key on raw rows; all rows without a key are one group."""
    latest = latest_per_key(star.staged_orders(spark, sf_dir), "order_id")
    return _in_seconds(latest)


def silver_parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitioned Silver files, written and read back."""
    path = scratch_dir(spark, "silver-scan")
    write_partitioned(_silver_orders(spark, sf_dir), path)
    return _in_seconds(read_silver(spark, "orders", path))


# Gold


def gold_daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.daily_revenue(_silver_orders(spark, sf_dir))


def gold_customer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.customer_metrics(
        _silver_orders(spark, sf_dir), _silver_customers(spark, sf_dir), AS_OF
    )


def gold_product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    performance = rollups.product_performance(
        _silver_orders(spark, sf_dir), _silver_products(spark, sf_dir)
    )
    return _in_seconds(performance)


def gold_ltv_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = rollups.purchase_profile(_silver_orders(spark, sf_dir), AS_OF)
    value = F.col("lifetime_value_usd")
    return profile.select("customer_id", value, ltv_tier(value).alias("ltv_tier"))


def gold_churn_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = rollups.purchase_profile(_silver_orders(spark, sf_dir), AS_OF)
    days, frequency = F.col("recency_days"), F.col("purchase_frequency")
    return profile.select(
        "customer_id", days, frequency, churn_risk(days, frequency).alias("churn_risk")
    )


def gold_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer metrics built from stored Silver and read back from a second target."""
    root = scratch_dir(spark, "gold-roundtrip")
    write_partitioned(_silver_orders(spark, sf_dir), child(root, "silver", "orders"))
    write_partitioned(_silver_customers(spark, sf_dir), child(root, "silver", "customers"))
    copy = child(root, "copy")
    gold.build(
        spark,
        child(root, "silver"),
        child(root, "gold"),
        "customer_metrics",
        as_of=AS_OF,
        targets=lambda table: [Target("parquet", {"path": child(copy, table)})],
    )
    return spark.read.parquet(child(copy, "customer_metrics"))


def _full_run(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """CSV files of all three tables taken through every layer; one Gold table at the end."""
    lake = full_run.Lake(scratch_dir(spark, "full-run"))
    staged = {
        "orders": star.staged_orders,
        "customers": star.staged_customers,
        "products": star.staged_products,
    }
    for name, stage in staged.items():
        rows = stage(spark, sf_dir).drop(*_METADATA)
        star.write_csv_landing(rows, lake.path("landing", name))
    full_run.run(spark, lake, dead_letters=True, ingested_at=LANDED_AT, as_of=AS_OF)
    return spark.read.parquet(lake.path("gold", table))


def full_run_daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full_run(spark, sf_dir, "daily_revenue_by_channel")


def full_run_customer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full_run(spark, sf_dir, "customer_metrics")


def full_run_product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the files' paths, which differ from run to run."""
    return _in_seconds(_full_run(spark, sf_dir, "product_performance").drop(SOURCE_FILE))


# Text


def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(star.star_table(spark, sf_dir, "documents"), "text")


def word_count_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial counts, one set per document source, written as lines and merged."""
    documents = star.star_table(spark, sf_dir, "documents")
    words = documents.select("source", F.explode(tokens(F.col("text"))).alias("word"))
    partials = words.where("word <> ''").groupBy("source", "word").count()
    path = scratch_dir(spark, "partials")
    write_lines(as_tsv(partials), path)
    return merge_counts(read_lines(spark, path))


def word_count_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "tsv")
    write_lines(as_tsv(word_counts(spark, sf_dir)), path)
    return read_lines(spark, path)


QUERIES: dict[str, Query] = {
    "bronze_csv_scan": bronze_csv_scan,
    "bronze_permissive": bronze_permissive,
    "bronze_json_scan": bronze_json_scan,
    "bronze_audit": bronze_audit,
    "bronze_roundtrip": bronze_roundtrip,
    "bronze_dead_letter": bronze_dead_letter,
    "bronze_accepted": bronze_accepted,
    "bronze_metrics": bronze_metrics,
    "bronze_incremental": bronze_incremental,
    "bronze_incremental_dead_letter": bronze_incremental_dead_letter,
    "silver_orders": silver_orders,
    "silver_customers": silver_customers,
    "silver_products": silver_products,
    "silver_net_revenue": silver_net_revenue,
    "silver_margin_pct": silver_margin_pct,
    "silver_dedup": silver_dedup,
    "silver_parquet_scan": silver_parquet_scan,
    "gold_daily_revenue": gold_daily_revenue,
    "gold_customer_metrics": gold_customer_metrics,
    "gold_product_performance": gold_product_performance,
    "gold_ltv_tier": gold_ltv_tier,
    "gold_churn_risk": gold_churn_risk,
    "gold_roundtrip": gold_roundtrip,
    "full_run_daily_revenue": full_run_daily_revenue,
    "full_run_customer_metrics": full_run_customer_metrics,
    "full_run_product_performance": full_run_product_performance,
    "word_count": word_counts,
    "word_count_merge": word_count_merge,
    "word_count_tsv": word_count_tsv,
    **DAILY_QUERIES,
}
