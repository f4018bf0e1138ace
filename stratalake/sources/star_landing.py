"""Order, customer and product records derived from the star-schema test tables.

The mapping injects what the rules of the later layers look for: missing keys,
bad quantities, prices and dates, padded text, repeated deliveries, orphans.
Every expression is plain SQL, so an independent SQL engine can stage the same
rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.tables import BATCH_DATE, INGESTED_AT, SOURCE_FILE

ORDERS_FROM = (
    "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"
)
CUSTOMERS_FROM = "customer JOIN nation ON c_nationkey = n_nationkey"
PRODUCTS_FROM = "part"

# Landing field -> expression over the joined test tables.
ORDERS = {
    "order_id": "CASE WHEN (l_orderkey * 7 + l_linenumber) % 97 = 0 THEN NULL"
    " ELSE concat('O', l_orderkey, '-', l_linenumber) END",
    "customer_id": "concat('C', CASE WHEN o_custkey % 29 = 0 THEN o_custkey + 1000000"
    " ELSE o_custkey END)",
    "product_id": "concat('P', l_partkey)",
    "order_date": "CASE WHEN l_orderkey % 89 = 0 THEN '15/01/2024'"
    " ELSE cast(cast(o_orderdate AS date) AS string) END",
    "quantity": "CASE (l_orderkey + l_suppkey) % 83 WHEN 0 THEN -cast(l_quantity AS int)"
    " WHEN 1 THEN 0 WHEN 2 THEN NULL ELSE cast(l_quantity AS int) END",
    "unit_price": "CASE WHEN l_partkey % 67 = 0 THEN cast(0 AS double)"
    " ELSE cast(cast(p_retailprice AS decimal(10,2)) * 0.01 AS double) END",
    "discount_pct": "CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END",
    "channel": "CASE l_returnflag WHEN 'N' THEN ' online ' WHEN 'A' THEN 'Store'"
    " ELSE 'PARTNER' END",
    "status": "CASE WHEN o_orderkey % 71 = 0 THEN NULL WHEN o_orderkey % 71 = 1 THEN 'pending'"
    " WHEN o_orderstatus = 'F' THEN 'Completed' WHEN o_orderstatus = 'O' THEN ' shipped'"
    " ELSE 'CANCELLED ' END",
}
CUSTOMERS = {
    "customer_id": "concat('C', c_custkey)",
    "first_name": "' cUSTOMER '",
    "last_name": "c_name",
    "email": "CASE WHEN c_custkey % 53 = 0 THEN NULL"
    " ELSE concat(' ', upper(c_name), '@Example.COM ') END",
    "country": "lower(n_name)",
    "registration_date": "cast(date '2020-01-01' + cast(c_custkey % 3000 AS int) AS string)",
    "is_active": "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal > 0 END",
}
PRODUCTS = {
    "product_id": "concat('P', p_partkey)",
    "product_name": "concat('  ', p_name, ' ')",
    "category": "concat(' ', p_type, ' ', p_name, ' ')",
    "unit_price": "CASE WHEN p_partkey % 61 = 0 THEN cast(0 AS double)"
    " ELSE cast(cast(p_retailprice AS decimal(10,2)) * 0.01 AS double) END",
    "unit_cost": "cast(cast(p_retailprice AS decimal(10,2)) * 0.01 - p_size * 0.1 AS double)",
}

# Deliveries: order lines arrive on their ship date, in monthly batches, one
# file per supplier; master data arrives once.
ORDERS_AUDIT = {
    INGESTED_AT: "cast(l_shipdate AS timestamp)",
    SOURCE_FILE: "concat('landing/orders/', l_suppkey, '.csv')",
    BATCH_DATE: "cast(date_trunc('month', l_shipdate) AS date)",
}
MASTER_AUDIT = {
    INGESTED_AT: "cast('2001-08-01 00:00:00' AS timestamp)",
    SOURCE_FILE: "'landing/master'",
    BATCH_DATE: "date '2001-08-01'",
}


#: Order lines in one landing file, some 70 bytes each, where a query asks for several files.
LINES_PER_FILE = 3_000_000


def star_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def landing_files(spark: SparkSession, sf_dir: str, least: int) -> int:
    """How many files hold all order lines, none more than about ``LINES_PER_FILE``; counted from the footers."""
    return max(least, math.ceil(star_table(spark, sf_dir, "lineitem").count() / LINES_PER_FILE))


def _project(df: DataFrame, *mappings: dict[str, str]) -> DataFrame:
    return df.select(
        *(F.expr(rule).alias(name) for mapping in mappings for name, rule in mapping.items())
    )


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their part, which adds least to a row, then with their order."""
    lines = star_table(spark, sf_dir, "lineitem")
    orders = star_table(spark, sf_dir, "orders")
    parts = star_table(spark, sf_dir, "part")
    return lines.join(parts, F.expr("l_partkey = p_partkey")).join(
        orders, F.expr("l_orderkey = o_orderkey")
    )


def staged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All order lines in Bronze form."""
    return _project(_order_lines(spark, sf_dir), ORDERS, ORDERS_AUDIT)


def staged_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers in Bronze form."""
    customers = star_table(spark, sf_dir, "customer")
    nations = star_table(spark, sf_dir, "nation")
    return _project(
        customers.join(nations, F.expr("c_nationkey = n_nationkey")), CUSTOMERS, MASTER_AUDIT
    )


def staged_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All products in Bronze form."""
    return _project(star_table(spark, sf_dir, "part"), PRODUCTS, MASTER_AUDIT)


# Raw order lines: a share of them is damaged in one of several ways, told apart
# by this expression. The raw text of each kind is listed below.
DAMAGE = "(l_orderkey * 3 + l_linenumber) % 41"


def _csv_line(**replaced: str) -> str:
    texts = [replaced.get(name, f"cast(({rule}) AS string)") for name, rule in ORDERS.items()]
    fields = [f"coalesce({text}, '')" for text in texts]
    return f"concat_ws(',', {', '.join(fields)})"


RAW_ORDER_LINE = f"""CASE {DAMAGE}
 WHEN 0 THEN {_csv_line(quantity="'abc'")}
 WHEN 1 THEN concat_ws(',', coalesce({ORDERS['order_id']}, ''), {ORDERS['customer_id']},
  {ORDERS['product_id']})
 WHEN 2 THEN concat({_csv_line()}, ',surplus')
 WHEN 3 THEN {_csv_line(unit_price="'n/a'")}
 WHEN 4 THEN {_csv_line(quantity="'2.0'")}
 WHEN 5 THEN {_csv_line(quantity="'99999999999'")}
 ELSE {_csv_line()} END"""


def _raw_line(kind: Column, texts: dict[str, Column]) -> Column:
    """``RAW_ORDER_LINE`` over fields that are texts, or NULL, already."""
    found = {name: F.coalesce(text, F.lit("")) for name, text in texts.items()}

    quantity = F.when(kind == 0, "abc").when(kind == 4, "2.0").when(kind == 5, "99999999999")
    price = F.when(kind == 3, "n/a")
    damaged = {"quantity": quantity.otherwise(found["quantity"]), "unit_price": price.otherwise(found["unit_price"])}
    whole = F.concat_ws(",", *(damaged.get(name, text) for name, text in found.items()))
    short = F.concat_ws(",", found["order_id"], texts["customer_id"], texts["product_id"])  # leaves out what is NULL
    return F.when(kind == 1, short).when(kind == 2, F.concat(whole, F.lit(",surplus"))).otherwise(whole)


def raw_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as CSV text, some damaged, in a column named like the header.

    Each field is turned into text once and the line is put together from these: as one
    expression of ``RAW_ORDER_LINE`` the fields appear seven times over, in more code than
    a JVM compiles.
    """
    header = ",".join(ORDERS)
    rules = {name: f"cast(({rule}) AS string)" for name, rule in ORDERS.items()}
    fields = _project(_order_lines(spark, sf_dir), rules, {"damage": DAMAGE})
    return fields.select(_raw_line(F.col("damage"), {name: F.col(name) for name in ORDERS}).alias(header))


def raw_order_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as a JSON object; some have a bad quantity, some are cut off."""
    lines = _order_lines(spark, sf_dir)
    record = F.struct(*(F.expr(rule).alias(name) for name, rule in ORDERS.items()))
    text = F.to_json(record)
    bad_quantity = F.to_json(record.withField("quantity", F.lit("abc")))
    cut_off = F.expr("substring(line, 1, length(line) - 1)")
    return (
        lines.withColumns({"line": text, "bad": bad_quantity, "kind": F.expr(DAMAGE)})
        .select(
            F.when(F.col("kind") == 0, F.col("bad"))
            .when(F.col("kind") == 1, cut_off)
            .otherwise(F.col("line"))
            .alias("value")
        )
    )


def write_csv_landing(df: DataFrame, path: str, *, by: str | None = None, compression: str = "none") -> None:
    """Write parsed records as CSV landing files, padding kept; ``by`` names a column with a folder per value."""
    writer = (
        df.write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("compression", compression)
    )
    (writer.partitionBy(by) if by else writer).csv(path)


def write_raw_landing(lines: DataFrame, path: str) -> None:
    """Write ready-made lines, the column name as header line, without any quoting."""
    (
        lines.write.option("header", True)
        .option("sep", "\x01")
        .option("quote", "\u0000")
        .option("escapeQuotes", False)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
