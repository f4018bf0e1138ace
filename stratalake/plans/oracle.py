"""The registered queries as SQL for an independent engine over the same tables."""

from __future__ import annotations

from stratalake.sources import star_landing as star

AS_OF = "DATE '2001-08-02'"


def _columns(mapping: dict[str, str]) -> str:
    return ",\n  ".join(f"{rule} AS {name}" for name, rule in mapping.items())


def _cents(expression: str) -> str:
    """A double rounded half up on its shortest decimal form, as Spark rounds doubles."""
    return (
        f"cast(round(cast(cast({expression} AS varchar) AS decimal(38, 15)), 2) AS double)"
    )


def _title(expression: str) -> str:
    """First letter of every space-separated word upper, the rest lower."""
    return (
        f"array_to_string(list_transform(string_split(lower({expression}), ' '),"
        " lambda w: upper(w[1:1]) || w[2:]), ' ')"
    )


def _trim(column: str) -> str:
    return f"trim({column}, ' ')"


def _date(column: str) -> str:
    return f"cast(try_strptime({column}, '%Y-%m-%d') AS date)"


def _latest(relation: str, key: str, columns: list[str]) -> str:
    """Newest row per key; remaining columns, largest first, settle ties."""
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["_ingested_at", *columns])
    return (
        f"SELECT * EXCLUDE (version) FROM (SELECT *, row_number() OVER"
        f" (PARTITION BY {key} ORDER BY {order}) AS version FROM {relation}) WHERE version = 1"
    )


def _sum_money(column: str) -> str:
    return f"cast(sum(cast(round({column} * 100) AS bigint)) AS double) / 100"


def _avg_money(column: str) -> str:
    total = f"sum(cast(round({column} * 100) AS bigint))"
    return (
        f"cast(sign({total}) * ((2 * abs({total}) + count({column})) // (2 * count({column})))"
        " AS double) / 100"
    )


def _all_cents(column: str) -> str:
    return f"cast(sum(cast(round({column} * 100) AS bigint)) AS bigint) AS cents"


def _staged(orders_audit: dict[str, str], master_audit: dict[str, str]) -> str:
    return f"""staged_orders AS (
 SELECT {_columns({**star.ORDERS, **orders_audit})}
 FROM {star.ORDERS_FROM}),
staged_customers AS (
 SELECT {_columns({**star.CUSTOMERS, **master_audit})}
 FROM {star.CUSTOMERS_FROM}),
staged_products AS (
 SELECT {_columns({**star.PRODUCTS, **master_audit})}
 FROM {star.PRODUCTS_FROM})"""


STAGED = _staged(star.ORDERS_AUDIT, star.MASTER_AUDIT)


def _clean_orders(name: str, source: str) -> str:
    return f"""{name} AS (
 SELECT order_id, customer_id, product_id, {_date('order_date')} AS order_date, quantity,
  unit_price, coalesce(discount_pct, 0.0::double) AS discount_pct,
  upper({_trim('channel')}) AS channel, lower({_trim('status')}) AS status,
  _ingested_at, _source_file, _batch_date,
  {_cents('unit_price * quantity * (1 - coalesce(discount_pct, 0.0::double))')} AS net_revenue
 FROM {source}
 WHERE order_id IS NOT NULL AND quantity > 0 AND unit_price > 0)"""


# Column order of the tie-break: as in Bronze, then the derived column.
ORDER_TIES = [
    "customer_id", "product_id", "order_date", "quantity", "unit_price", "discount_pct",
    "channel", "status", "_source_file", "_batch_date",
]

SECONDS = "cast(epoch(_ingested_at) AS bigint) AS _ingested_at"


def _cleaned(staged: str) -> str:
    return f"""{staged},
{_clean_orders('clean_orders', 'staged_orders')},
silver_orders AS ({_latest('clean_orders', 'order_id', [*ORDER_TIES, 'net_revenue'])}),
silver_customers AS (
 SELECT customer_id, {_title(_trim('first_name'))} AS first_name,
  {_title(_trim('last_name'))} AS last_name, lower({_trim('email')}) AS email,
  {_title(_trim('country'))} AS country, {_date('registration_date')} AS registration_date,
  coalesce(is_active, true) AS is_active, _ingested_at, _source_file, _batch_date
 FROM staged_customers WHERE customer_id IS NOT NULL AND email IS NOT NULL),
silver_products AS (
 SELECT product_id, {_trim('product_name')} AS product_name,
  {_title(_trim('category'))} AS category, unit_price, unit_cost, _ingested_at, _source_file, _batch_date,
  {_cents('(unit_price - unit_cost) / unit_price * 100')} AS margin_pct
 FROM staged_products WHERE product_id IS NOT NULL AND unit_price > 0)"""


CLEAN = _cleaned(STAGED)

PROFILE = f"""profile AS (
 SELECT customer_id,
  cast(date_diff('day', max(order_date), {AS_OF}) AS integer) AS recency_days,
  count(DISTINCT order_date) AS purchase_frequency,
  {_sum_money('net_revenue')} AS lifetime_value_usd,
  {_avg_money('net_revenue')} AS avg_order_value_usd,
  count(order_id) AS total_orders,
  min(order_date) AS first_purchase_date, max(order_date) AS last_purchase_date
 FROM silver_orders WHERE status <> 'cancelled' GROUP BY customer_id)"""

TIER = """CASE WHEN lifetime_value_usd >= 5000 THEN 'platinum'
 WHEN lifetime_value_usd >= 2000 THEN 'gold'
 WHEN lifetime_value_usd >= 500 THEN 'silver' ELSE 'bronze' END AS ltv_tier"""
CHURN = """CASE WHEN recency_days > 90 AND purchase_frequency <= 2 THEN 'high'
 WHEN recency_days > 60 AND purchase_frequency <= 4 THEN 'medium' ELSE 'low' END AS churn_risk"""

DAILY = f"""SELECT order_date, channel, count(order_id) AS total_orders,
 {_sum_money('net_revenue')} AS total_revenue, {_avg_money('net_revenue')} AS avg_order_value,
 cast(sum(quantity) AS bigint) AS units_sold, count(DISTINCT customer_id) AS unique_customers
FROM silver_orders WHERE status IN ('completed', 'shipped') GROUP BY order_date, channel"""

CUSTOMER_METRICS = f"""SELECT p.*, {TIER}, {CHURN}, c.first_name, c.last_name, c.email, c.country
FROM profile p LEFT JOIN silver_customers c ON p.customer_id = c.customer_id"""

PRODUCT_PERFORMANCE = f"""sold AS (
 SELECT product_id, cast(sum(quantity) AS bigint) AS units_sold,
  {_sum_money('net_revenue')} AS total_revenue, count(order_id) AS total_orders,
  count(DISTINCT customer_id) AS unique_buyers
 FROM silver_orders WHERE status <> 'cancelled' GROUP BY product_id)
SELECT s.*, p.product_name, p.category, p.unit_price, p.unit_cost, p.margin_pct,
 {SECONDS}, _source_file, _batch_date,
 {_cents('s.total_revenue - p.unit_cost * s.units_sold')} AS gross_profit
FROM sold s LEFT JOIN silver_products p ON s.product_id = p.product_id"""

LANDING = ", ".join(star.ORDERS)

# What a permissive read makes of each kind of damaged line.
PERMISSIVE = {
    **star.ORDERS,
    "order_date": f"CASE WHEN {star.DAMAGE} = 1 THEN NULL ELSE {star.ORDERS['order_date']} END",
    "quantity": f"CASE WHEN {star.DAMAGE} IN (0, 1, 4, 5) THEN NULL"
    f" ELSE {star.ORDERS['quantity']} END",
    "unit_price": f"CASE WHEN {star.DAMAGE} IN (1, 3) THEN NULL"
    f" ELSE {star.ORDERS['unit_price']} END",
    "discount_pct": f"CASE WHEN {star.DAMAGE} = 1 THEN NULL ELSE {star.ORDERS['discount_pct']} END",
    "channel": f"CASE WHEN {star.DAMAGE} = 1 THEN NULL ELSE {star.ORDERS['channel']} END",
    "status": f"CASE WHEN {star.DAMAGE} = 1 THEN NULL ELSE {star.ORDERS['status']} END",
}
JSON = {
    name: f"CASE WHEN {star.DAMAGE} = 1 THEN NULL"
    + (f" WHEN {star.DAMAGE} = 0 THEN NULL" if name == "quantity" else "")
    + f" ELSE {rule} END"
    for name, rule in star.ORDERS.items()
}

# One batch of CSV files: all audit values are equal, the other columns settle ties.
ONE_BATCH = {
    "_ingested_at": "TIMESTAMP '2001-08-01 06:00:00'",
    "_source_file": "''",
    "_batch_date": "DATE '2001-08-01'",
}
FULL_RUN = _cleaned(_staged(ONE_BATCH, ONE_BATCH))

# Three daily deliveries: what a row looks like last, and when that version arrived.
def _arrived(day: str) -> dict[str, str]:
    return {
        "_ingested_at": f"TIMESTAMP '2001-08-01 06:00:00' + to_days(cast({day} AS integer))",
        "_source_file": "''",
        "_batch_date": f"cast(DATE '2001-08-01' + cast({day} AS integer) AS date)",
    }


_LATE_COUNTRY = {"country": f"CASE WHEN c_custkey % 5 = 0 THEN 'late land' ELSE {star.CUSTOMERS['country']} END"}
_CHEAPER = {
    "unit_cost": f"CASE WHEN p_partkey % 7 = 0 THEN ({star.PRODUCTS['unit_cost']}) * 0.5::double ELSE {star.PRODUCTS['unit_cost']} END"
}
THREE_DAYS = _cleaned(f"""staged_orders AS (
 SELECT {_columns({**star.ORDERS, **_arrived('l_suppkey % 3')})} FROM {star.ORDERS_FROM}),
staged_customers AS (
 SELECT {_columns({**star.CUSTOMERS, **_LATE_COUNTRY, **_arrived('CASE WHEN c_custkey % 5 = 0 THEN 2 ELSE 0 END')})}
 FROM {star.CUSTOMERS_FROM}),
staged_products AS (
 SELECT {_columns({**star.PRODUCTS, **_CHEAPER, **_arrived('CASE WHEN p_partkey % 7 = 0 THEN 2 WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END')})}
 FROM {star.PRODUCTS_FROM})""")

WORDS = """SELECT word, count(*) AS count
 FROM (SELECT unnest(string_split_regex(text, '\\s+')) AS word FROM documents)
 WHERE word <> '' GROUP BY word"""

ORACLE: dict[str, str] = {
    "bronze_csv_scan": f"SELECT {_columns(star.ORDERS)} FROM {star.ORDERS_FROM}",
    "bronze_permissive": f"SELECT {_columns(PERMISSIVE)} FROM {star.ORDERS_FROM}",
    "bronze_json_scan": f"SELECT {_columns(JSON)} FROM {star.ORDERS_FROM}",
    "bronze_audit": f"""SELECT {star.ORDERS['order_id']} AS order_id,
 cast(epoch(TIMESTAMP '2001-08-01 06:00:00') AS bigint) AS ingested_at_seconds,
 'landing/orders' AS source_file, DATE '2001-08-01' AS batch_date FROM {star.ORDERS_FROM}""",
    "bronze_roundtrip": f"""WITH {STAGED}
SELECT {LANDING},
 cast(epoch(CASE WHEN _batch_date < DATE '1998-01-01' THEN TIMESTAMP '1998-01-01 00:00:00'
  ELSE TIMESTAMP '2002-01-01 00:00:00' END) AS bigint) AS _ingested_at,
 CASE WHEN _batch_date < DATE '1998-01-01' THEN 'landing/early' ELSE 'landing/late' END
  AS _source_file,
 CASE WHEN _batch_date < DATE '1998-01-01' THEN DATE '1998-01-01' ELSE DATE '2002-01-01' END
  AS _batch_date
FROM staged_orders""",
    "bronze_dead_letter": f"""SELECT {star.RAW_ORDER_LINE} AS raw_line,
 'landing/orders' AS source_file, DATE '2001-08-01' AS batch_date
FROM {star.ORDERS_FROM} WHERE {star.DAMAGE} < 6""",
    "bronze_accepted": f"SELECT {_columns(star.ORDERS)} FROM {star.ORDERS_FROM}"
    f" WHERE {star.DAMAGE} >= 6",
    "bronze_metrics": f"""SELECT 'orders' AS table_name, DATE '2001-08-01' AS batch_date,
 count(*) AS rows, count(*) FILTER ({star.DAMAGE} < 6) AS rejected FROM {star.ORDERS_FROM}""",
    "bronze_incremental": f"SELECT {_columns(PERMISSIVE)} FROM {star.ORDERS_FROM}",
    "bronze_incremental_dead_letter": f"""SELECT {star.RAW_ORDER_LINE} AS raw_line,
 'landing/orders' AS source_file, DATE '2001-08-01' AS batch_date
FROM {star.ORDERS_FROM} WHERE {star.DAMAGE} < 6""",
    "silver_orders": f"""WITH {CLEAN}
SELECT * REPLACE ({SECONDS}) FROM silver_orders""",
    "silver_customers": f"WITH {CLEAN} SELECT * REPLACE ({SECONDS}) FROM silver_customers",
    "silver_products": f"WITH {CLEAN} SELECT * REPLACE ({SECONDS}) FROM silver_products",
    "silver_net_revenue": f"""WITH {CLEAN}
SELECT order_id, _source_file, quantity, unit_price, discount_pct, net_revenue
FROM clean_orders""",
    "silver_margin_pct": f"""WITH {CLEAN}
SELECT product_id, unit_price, unit_cost, margin_pct FROM silver_products""",
    "silver_dedup": f"""WITH {STAGED}
SELECT * REPLACE ({SECONDS})
FROM ({_latest('staged_orders', 'order_id', ORDER_TIES)})""",
    "silver_parquet_scan": f"""WITH {CLEAN}
SELECT * REPLACE ({SECONDS}) FROM silver_orders""",
    "gold_daily_revenue": f"WITH {CLEAN} {DAILY}",
    "gold_customer_metrics": f"WITH {CLEAN}, {PROFILE} {CUSTOMER_METRICS}",
    "gold_product_performance": f"WITH {CLEAN}, {PRODUCT_PERFORMANCE}",
    "gold_ltv_tier": f"WITH {CLEAN}, {PROFILE}"
    f" SELECT customer_id, lifetime_value_usd, {TIER} FROM profile",
    "gold_churn_risk": f"WITH {CLEAN}, {PROFILE}"
    f" SELECT customer_id, recency_days, purchase_frequency, {CHURN} FROM profile",
    "gold_roundtrip": f"WITH {CLEAN}, {PROFILE} {CUSTOMER_METRICS}",
    "full_run_daily_revenue": f"WITH {FULL_RUN} {DAILY}",
    "full_run_customer_metrics": f"WITH {FULL_RUN}, {PROFILE} {CUSTOMER_METRICS}",
    "full_run_product_performance": f"""SELECT * EXCLUDE (_source_file)
FROM (WITH {FULL_RUN}, {PRODUCT_PERFORMANCE})""",
    "word_count": WORDS,
    "word_count_merge": WORDS,
    "bronze_header_order": f"SELECT {_columns(star.ORDERS)} FROM {star.ORDERS_FROM}",
    "bronze_file_lineage": f"""WITH {STAGED} SELECT {LANDING},
 CASE WHEN _batch_date < DATE '1998-01-01' THEN 'early' ELSE 'late' END AS folder FROM staged_orders""",
    "bronze_json_dead_letter": f"""SELECT {_columns(JSON)}, {star.DAMAGE} = 0 AS complete
FROM {star.ORDERS_FROM} WHERE {star.DAMAGE} < 2""",
    "bronze_strict": f"""SELECT * FROM (SELECT {_columns(star.ORDERS)} FROM {star.ORDERS_FROM}
 WHERE {star.DAMAGE} >= 6) WHERE order_id IS NOT NULL""",
    "bronze_arrivals": f"SELECT {_columns(star.ORDERS)} FROM {star.ORDERS_FROM}"
    f" WHERE {star.DAMAGE} >= 6",
    "bronze_arrivals_dead_letter": f"""SELECT {star.RAW_ORDER_LINE} AS raw_line,
 'landing/orders' AS source_file, DATE '2001-08-01' AS batch_date
FROM {star.ORDERS_FROM} WHERE {star.DAMAGE} < 6""",
    "silver_incremental": f"""WITH {CLEAN}
SELECT * REPLACE ({SECONDS}) FROM silver_orders""",
    "silver_codec": f"WITH {CLEAN} SELECT 'snappy' AS codec, count(*) AS rows FROM silver_orders",
    "gold_daily_order": f"""SELECT order_date, channel, total_revenue,
 cast(row_number() OVER (ORDER BY order_date NULLS FIRST, channel NULLS FIRST) AS integer) AS place
FROM (WITH {CLEAN} {DAILY})""",
    "gold_all": f"""SELECT *, rows AS reported FROM (
SELECT 'daily_revenue_by_channel' AS table_name, count(*) AS rows, {_all_cents('total_revenue')} FROM (WITH {CLEAN} {DAILY})
UNION ALL SELECT 'customer_metrics', count(*), {_all_cents('lifetime_value_usd')} FROM (WITH {CLEAN}, {PROFILE} {CUSTOMER_METRICS})
UNION ALL SELECT 'product_performance', count(*), {_all_cents('total_revenue')} FROM (WITH {CLEAN}, {PRODUCT_PERFORMANCE}))""",
    "full_run_incremental": f"WITH {THREE_DAYS} {DAILY}",
    "full_run_incremental_customers": f"WITH {THREE_DAYS}, {PROFILE} {CUSTOMER_METRICS}",
    "full_run_incremental_products": f"""SELECT * EXCLUDE (_source_file)
FROM (WITH {THREE_DAYS}, {PRODUCT_PERFORMANCE})""",
    "command_line_run": f"WITH {FULL_RUN}, {PROFILE} {CUSTOMER_METRICS}",
    "word_count_job": WORDS,
    "word_count_tsv": f"SELECT word || chr(9) || count AS value FROM ({WORDS})",
}
