"""Cleaned tables: typing, flattening, deduplication, stamps.

``conform_*`` are row-level and run on batch and streaming frames alike;
``silver_*`` add deduplication and stamps for a batch input.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from larder.functions.scalar import (ISO_DATE, US_DATE, full_name, parse_date, title_case,
                                     trimmed, upper_case, whole_number)
from larder.operators.dedup import keep_first

# Payload schemas of the two topics and the two document feeds.
ORDER_PAYLOAD = """
    order_id STRING, product_id INT, customer_id INT, store_id INT, quantity INT,
    order_date STRING, payment_type STRING, order_channel STRING
"""
INVENTORY_PAYLOAD = """
    inventory_id STRING, event_timestamp STRING, product_id INT, store_id INT,
    quantity_added INT, quantity_remaining INT
"""
CUSTOMER_DOCUMENT = """
    customer_id INT, customer_acct_num BIGINT, first_name STRING, last_name STRING,
    customer_address STRING, customer_city STRING, customer_state_province STRING,
    customer_postal_code INT, customer_country STRING, birthdate STRING,
    marital_status STRING, yearly_income STRING, gender STRING, total_children INT,
    num_children_at_home INT, education STRING, acct_open_date STRING,
    member_card STRING, occupation STRING, homeowner STRING
"""
PRODUCT_DOCUMENT = """
    product_id INT, product_brand STRING, product_name STRING, product_sku BIGINT,
    product_retail_price DOUBLE, product_cost DOUBLE, product_weight DOUBLE,
    recyclable INT, low_fat INT
"""

# Deduplication keys.
KEYS: Mapping[str, Sequence[str]] = {
    "transactions": ("product_id", "customer_id", "store_id", "transaction_date"),
    "returns": ("product_id", "store_id", "return_date"),
    "stores": ("store_id",),
    "regions": ("region_id",),
    "orders": ("order_id", "event_timestamp"),
    "inventory": ("inventory_id",),
    "customers": ("customer_id",),
    "products": ("product_id",),
}

# Columns whose change opens a new version in the history tables.
TRACKED: Mapping[str, Sequence[str]] = {
    "stores": ("store_name", "region_id"),
    "customers": ("customer_name", "customer_city", "customer_state_province",
                  "customer_country", "marital_status", "yearly_income", "gender",
                  "education", "occupation", "homeowner"),
    "products": ("product_name", "product_brand", "product_retail_price", "product_cost",
                 "product_weight", "recyclable", "low_fat"),
}

# Stock bands, upper bounds exclusive.
OUT_OF_STOCK = "OUT_OF_STOCK"
STOCK_BANDS = ((20, "LOW_STOCK"), (50, "MEDIUM"))
PLENTY = "HEALTHY"

# What happens to each CSV column that does not stay as it landed.
CSV_CONVERSIONS: Mapping[str, Mapping[str, Callable[[str], Column]]] = {
    "transactions": {"transaction_date": parse_date, "quantity": whole_number},
    "returns": {"return_date": parse_date, "quantity": whole_number},
    "stores": {
        "store_id": whole_number,
        "region_id": whole_number,
        "store_name": trimmed,
        "store_city": title_case,
        "store_state": upper_case,
        "first_opened_date": lambda c: parse_date(c, ISO_DATE, US_DATE),
        "last_remodel_date": lambda c: parse_date(c, ISO_DATE, US_DATE),
    },
    "regions": {
        "region_id": whole_number,
        "sales_region": title_case,
        "sales_district": title_case,
    },
    "calendar": {"date": lambda c: parse_date(c, ISO_DATE, US_DATE)},
}


def quantity_status(name: str = "quantity") -> Column:
    """'invalid' for a known quantity of zero or less; unknown counts as cleaned."""
    return F.when(F.col(name) <= 0, "invalid").otherwise("cleaned")


def stock_status(name: str = "quantity_remaining") -> Column:
    """Stock band of a quantity; a negative one is low, an unknown one healthy."""
    level = F.col(name)
    band = F.when(level == 0, OUT_OF_STOCK)
    for below, label in STOCK_BANDS:
        band = band.when(level < below, label)
    return band.otherwise(PLENTY)


def restocked(name: str = "quantity_added") -> Column:
    return F.coalesce(F.col(name) > 0, F.lit(False))


def stamp(df: DataFrame, clock: Column | None = None, **constants: Column | str) -> DataFrame:
    """Run and processing time plus the table's constant columns."""
    now = F.current_timestamp() if clock is None else clock
    values = {k: v if isinstance(v, Column) else F.lit(v) for k, v in constants.items()}
    return df.withColumns({"pipeline_run_id": now, "processing_timestamp": now, **values})


def mark_valid(df: DataFrame, clock: Column | None = None) -> DataFrame:
    return stamp(df, clock, record_status="valid")


# -- CSV feeds ---------------------------------------------------------------------

def conform_csv(bronze: DataFrame, table: str) -> DataFrame:
    return bronze.withColumns({c: f(c) for c, f in CSV_CONVERSIONS[table].items()})


def _status(table: str) -> Column | str:
    return quantity_status() if table in ("transactions", "returns") else "cleaned"


def stamp_csv(df: DataFrame, table: str, clock: Column | None = None) -> DataFrame:
    return stamp(df, clock, source_table=table, record_status=_status(table))


def silver_csv(bronze: DataFrame, table: str, order_by: Sequence[str | Column] = (),
               clock: Column | None = None) -> DataFrame:
    """Clean one CSV feed; ``order_by`` says which copy of a key survives.

    Without an order any copy may survive.  The calendar keeps all its rows.
    """
    rows = conform_csv(bronze, table)
    if table in KEYS:
        keys = list(KEYS[table])
        rows = keep_first(rows, keys, order_by) if order_by else rows.dropDuplicates(keys)
    return stamp_csv(rows, table, clock)


# -- topics ------------------------------------------------------------------------

#: A record's place in its topic: the total order of its partition.
POSITION = ("_partition", "_offset")


def _parse_payload(bronze: DataFrame, schema: str, position: bool) -> DataFrame:
    """Payload fields and broker time; an unreadable payload gives NULL fields.

    The parsed struct is unpacked by a generator on purpose: a filter on a field stays
    above it.  Below a plain projection it would parse every payload a second time.
    """
    parsed = F.array(F.from_json("raw_payload", schema))
    place = [F.col(c[1:]).alias(c) for c in POSITION if position and c[1:] in bronze.columns]
    return bronze.select(F.inline(parsed), "timestamp", *place)


def flatten_orders(bronze: DataFrame, position: bool = False) -> DataFrame:
    """Payload fields as columns next to the broker time."""
    return _parse_payload(bronze, ORDER_PAYLOAD, position).withColumns({
        "order_date": parse_date("order_date"),
        "event_timestamp": F.col("timestamp"),
    })


def flatten_inventory(bronze: DataFrame, position: bool = False) -> DataFrame:
    """Payload fields as columns; here the event time comes from the payload."""
    return _parse_payload(bronze, INVENTORY_PAYLOAD, position).withColumns({
        "event_timestamp": F.try_to_timestamp(F.col("event_timestamp")),
        "processing_time": F.col("timestamp"),
    })


def enrich_inventory(flat: DataFrame, clock: Column | None = None) -> DataFrame:
    rows = flat.withColumns({"stock_status": stock_status(), "is_restock": restocked()})
    return stamp(rows, clock, ingestion_source="kafka", record_status="cleaned")


def silver_orders(bronze: DataFrame, order_by: Sequence[str | Column] = (),
                  clock: Column | None = None) -> DataFrame:
    """Of the records of one key the first under ``order_by``, then by partition and offset."""
    return stamp(_first_record(flatten_orders(bronze, True), "orders", order_by), clock)


def silver_inventory(bronze: DataFrame, order_by: Sequence[str | Column] = (),
                     clock: Column | None = None) -> DataFrame:
    return enrich_inventory(
        _first_record(flatten_inventory(bronze, True), "inventory", order_by), clock)


def _first_record(rows: DataFrame, table: str, order_by: Sequence[str | Column]) -> DataFrame:
    place = [c for c in POSITION if c in rows.columns]
    return _first(rows, table, [*order_by, *place]).drop(*place)


def _first(rows: DataFrame, table: str, order_by: Sequence[str | Column]) -> DataFrame:
    keys = list(KEYS[table])
    return keep_first(rows, keys, order_by) if order_by else rows.dropDuplicates(keys)


# -- documents ---------------------------------------------------------------------

LINEAGE = ("ingestion_timestamp", "_source_system")


def flatten_documents(bronze: DataFrame, schema: str, key: str,
                      keep: Sequence[str] = LINEAGE) -> DataFrame:
    """Document fields as columns; the document ``_id`` is the key, as text.

    The payload's own copy of the key is ignored.
    """
    parsed = bronze.select(
        F.col("_id").cast("string").alias(key),
        F.from_json("data", schema).alias("doc"),
        *(c for c in keep if c in bronze.columns),
    )
    fields = [f"doc.{f}" for f in parsed.schema["doc"].dataType.names if f != key]
    return parsed.select(key, *fields, *(c for c in parsed.columns if c not in (key, "doc")))


def conform_customers(bronze: DataFrame, keep: Sequence[str] = LINEAGE) -> DataFrame:
    rows = flatten_documents(bronze, CUSTOMER_DOCUMENT, "customer_id", keep)
    return rows.withColumns({
        "customer_name": full_name("first_name", "last_name"),
        "birthdate": parse_date("birthdate"),
        "acct_open_date": parse_date("acct_open_date"),
    })


def conform_products(bronze: DataFrame, keep: Sequence[str] = LINEAGE) -> DataFrame:
    rows = flatten_documents(bronze, PRODUCT_DOCUMENT, "product_id", keep)
    return rows.withColumn("product_name", trimmed("product_name"))


def silver_customers(bronze: DataFrame, order_by: Sequence[str | Column] = (),
                     clock: Column | None = None) -> DataFrame:
    return stamp(_first(conform_customers(bronze), "customers", order_by), clock)


def silver_products(bronze: DataFrame, order_by: Sequence[str | Column] = (),
                    clock: Column | None = None) -> DataFrame:
    return stamp(_first(conform_products(bronze), "products", order_by), clock)
