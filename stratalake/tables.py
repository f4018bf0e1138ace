"""One declaration per table: landing schema, validity rules, tidy-up, derived columns.

Rules are Spark SQL expressions, so a table is data that Bronze, Silver and the
readers all interpret, and importing it needs no running session.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from stratalake.functions.dates import iso_date

INGESTED_AT = "_ingested_at"
SOURCE_FILE = "_source_file"
BATCH_DATE = "_batch_date"
CORRUPT = "_corrupt_record"

AUDIT_FIELDS = (
    T.StructField(INGESTED_AT, T.TimestampType()),
    T.StructField(SOURCE_FILE, T.StringType()),
    T.StructField(BATCH_DATE, T.DateType()),
)
CORRUPT_FIELD = T.StructField(CORRUPT, T.StringType())


@dataclass(frozen=True)
class TableSpec:
    """What one table looks like when it lands and what Silver makes of it.

    ``valid`` conditions see landing values (a blank email is valid, a missing
    one is not). ``tidy`` replaces columns in place and ``derived`` then adds
    columns computed from the tidied ones. ``ranged`` is a date column whose range
    is noted per batch, so that readers of some of its values skip the other batches.
    """

    name: str
    key: str
    landing: T.StructType
    valid: tuple[str, ...]
    tidy: dict[str, str]
    derived: dict[str, str] = field(default_factory=dict)
    retyped: dict[str, T.DataType] = field(default_factory=dict)
    ranged: str | None = None

    @property
    def bronze(self) -> T.StructType:
        """Stored Bronze schema.

        The key is declared non-null but landing files may lack it, so stored
        fields are all nullable. Files without the reject marker read it as NULL.
        """
        own = [T.StructField(f.name, f.dataType) for f in self.landing.fields]
        return T.StructType([*own, *AUDIT_FIELDS[:-1], CORRUPT_FIELD, AUDIT_FIELDS[-1]])

    @property
    def silver(self) -> T.StructType:
        """Stored Silver schema, with the partition column last."""
        own = [
            T.StructField(f.name, self.retyped.get(f.name, f.dataType))
            for f in self.landing.fields
        ]
        added = [T.StructField(name, T.DoubleType()) for name in self.derived]
        return T.StructType([*own, *AUDIT_FIELDS[:-1], *added, AUDIT_FIELDS[-1]])


def _landing(key: str, **columns: str) -> T.StructType:
    """Landing schema from column name -> type name; the key is declared non-null."""
    schema = T.StructType()
    for name, kind in columns.items():
        schema = schema.add(name, kind, nullable=name != key)
    return schema


# Column names, types and order of the landing files.
ORDERS_LANDING = _landing(
    "order_id",
    order_id="string",
    customer_id="string",
    product_id="string",
    order_date="string",
    quantity="integer",
    unit_price="double",
    discount_pct="double",
    channel="string",
    status="string",
)
CUSTOMERS_LANDING = _landing(
    "customer_id",
    customer_id="string",
    first_name="string",
    last_name="string",
    email="string",
    country="string",
    registration_date="string",
    is_active="boolean",
)
PRODUCTS_LANDING = _landing(
    "product_id",
    product_id="string",
    product_name="string",
    category="string",
    unit_price="double",
    unit_cost="double",
)

ORDERS = TableSpec(
    name="orders",
    key="order_id",
    landing=ORDERS_LANDING,
    valid=("order_id IS NOT NULL", "quantity > 0", "unit_price > 0"),
    tidy={
        "channel": "upper(trim(channel))",
        "status": "lower(trim(status))",
        "order_date": iso_date("order_date"),
        "discount_pct": "coalesce(discount_pct, 0D)",
    },
    derived={"net_revenue": "round(unit_price * quantity * (1 - discount_pct), 2)"},
    retyped={"order_date": T.DateType()},
    ranged="order_date",
)

CUSTOMERS = TableSpec(
    name="customers",
    key="customer_id",
    landing=CUSTOMERS_LANDING,
    valid=("customer_id IS NOT NULL", "email IS NOT NULL"),
    tidy={
        "first_name": "initcap(trim(first_name))",
        "last_name": "initcap(trim(last_name))",
        "country": "initcap(trim(country))",
        "email": "lower(trim(email))",
        "registration_date": iso_date("registration_date"),
        "is_active": "coalesce(is_active, true)",
    },
    retyped={"registration_date": T.DateType()},
)

PRODUCTS = TableSpec(
    name="products",
    key="product_id",
    landing=PRODUCTS_LANDING,
    valid=("product_id IS NOT NULL", "unit_price > 0"),
    tidy={
        "product_name": "trim(product_name)",
        "category": "initcap(trim(category))",
    },
    derived={"margin_pct": "round((unit_price - unit_cost) / unit_price * 100, 2)"},
)

TABLES: dict[str, TableSpec] = {spec.name: spec for spec in (ORDERS, CUSTOMERS, PRODUCTS)}


def spec_for(table: str | TableSpec) -> TableSpec:
    """Look a table up by name; a ready spec passes through."""
    if isinstance(table, TableSpec):
        return table
    try:
        return TABLES[table]
    except KeyError:
        raise ValueError(f"unknown table {table!r}; known: {', '.join(TABLES)}") from None
