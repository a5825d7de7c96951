"""One triggered update of the lakehouse, table by table.

Every function processes what has arrived since its last run and stops.  They keep no
state but their checkpoints, so any scheduler can call them in layer order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.operators import quality, scd2
from larder.operators.audit import RunLog
from larder.plans import silver
from larder.plans.refresh import refresh_gold
from larder.sources import evolving, lineage, tables, topics
from larder.streaming import facts, jobs, scd2_apply
from larder.streaming.watch import Watch

SPLIT_RULES = {
    "transactions": quality.TRANSACTION_RULES,
    "orders": quality.ORDER_RULES,
    "inventory": quality.INVENTORY_RULES,
}
CSV_TABLES = ("transactions", "returns", "stores", "regions", "calendar")
# Rows of one landing batch follow each other by their place in the landed files.
PLACE = ("_landed_file", "_landed_row")
HISTORIES = {
    "stores": scd2.Spec(["store_id"], "ingestion_timestamp", silver.TRACKED["stores"],
                        ignore_nulls=False, tie_break=PLACE),
    "customers": scd2.Spec(["customer_id"], "ingestion_timestamp", silver.TRACKED["customers"],
                           tie_break=PLACE),
    "products": scd2.Spec(["product_id"], "ingestion_timestamp", silver.TRACKED["products"],
                          tie_break=PLACE),
}


@dataclass(frozen=True)
class Layout:
    """Where tables and checkpoints are, and who logs the streams that fill them."""

    root: str
    watch: Watch | None = None

    def table(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def checkpoint(self, layer: str, name: str) -> str:
        return f"{self.root}/_checkpoints/{layer}/{name}"

    def append(self, stream: DataFrame, layer: str, name: str) -> None:
        if self.watch is not None:
            stream = self.watch.observed(stream, layer, name, None if layer == "silver" else {})
        jobs.run_append(stream, self.table(layer, name), self.checkpoint(layer, name))


# -- bronze ------------------------------------------------------------------------

def land_csv(spark: SparkSession, layout: Layout, table: str, folder: str,
             columns: Sequence[str], evolve: bool = True) -> None:
    """New files under their own headers; new columns are added, surplus fields rescued."""
    evolving.run_landing(spark, folder, layout.table("bronze", table),
                         layout.checkpoint("bronze", table), columns, evolve)


def land_topic(layout: Layout, table: str, records: DataFrame) -> None:
    """``records`` is a stream of Kafka records, see ``topics.kafka_stream``."""
    layout.append(topics.raw_payloads(records), "bronze", table)


def land_documents(layout: Layout, table: str, documents: DataFrame) -> None:
    """``documents`` is a stream of (_id, data) rows."""
    layout.append(lineage.landed(documents, lineage.REPLICATED), "bronze", table)


# -- silver ------------------------------------------------------------------------

def _upstream(spark: SparkSession, layout: Layout, layer: str, table: str) -> DataFrame:
    if layer == "silver" and table in facts.DATES:
        return facts.stream(spark, layout.table(layer, table))
    if layer == "bronze" and table in CSV_TABLES:
        return evolving.stream(spark, layout.table(layer, table)).drop(evolving.RESCUED)
    return tables.parquet_stream(spark, layout.table(layer, table))


def clean(spark: SparkSession, layout: Layout, table: str, strict: bool = False) -> None:
    """The cleaned, deduplicated table.

    ``strict`` applies to inventory: a row without product stops the update and rows
    without store are dropped.  Otherwise such rows go on to the quarantine.
    """
    bronze = _upstream(spark, layout, "bronze", table)
    if table in facts.DATES:
        facts.run_facts(bronze, table, layout.table("silver", table),
                        layout.checkpoint("silver", table), watch=layout.watch)
        return
    if table == "orders":
        rows = jobs.orders(bronze)
    elif table == "inventory":
        rows = jobs.inventory(bronze)
        if strict:
            rows = quality.drop_unless(
                quality.fail_unless(rows, quality.INVENTORY_MUST_HOLD),
                quality.INVENTORY_DROP_UNLESS)
    elif table in ("customers", "products"):
        rows = jobs.documents(bronze, table)
    else:
        rows = jobs.csv_table(bronze, table)
    layout.append(rows, "silver", table)


def split(spark: SparkSession, layout: Layout, table: str) -> None:
    jobs.run_split(_upstream(spark, layout, "silver", table), SPLIT_RULES[table],
                   layout.table("silver", f"{table}_split"),
                   layout.checkpoint("silver", f"{table}_split"))


def read_split(spark: SparkSession, layout: Layout, table: str) -> tuple[DataFrame, DataFrame]:
    """Valid rows with the stamps of their split, and quarantined rows."""
    return jobs.read_split(spark, layout.table("silver", f"{table}_split"))


def track(spark: SparkSession, layout: Layout, table: str) -> None:
    """Apply new rows to the table's history.

    Changes come from the landed rows: the cleaned table holds the first row per key
    only and would never show a second version.
    """
    bronze = _upstream(spark, layout, "bronze", table).select(
        "*", F.col("_metadata.file_name").alias(PLACE[0]),
        F.col("_metadata.row_index").alias(PLACE[1]))
    kept = ["ingestion_timestamp", *PLACE]
    changes = {
        "stores": lambda: silver.conform_csv(bronze, "stores").drop(
            "source_file_path", "source_file_name", "_source_system"),
        "customers": lambda: silver.conform_customers(bronze, kept),
        "products": lambda: silver.conform_products(bronze, kept),
    }[table]()
    scd2_apply.run_history(changes, HISTORIES[table],
                           layout.table("silver", f"scd_{table}"),
                           layout.checkpoint("silver", f"scd_{table}"))


def read_current(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    path = layout.table("silver", f"scd_{table}")
    return scd2.current(scd2_apply.read_history(spark, path, HISTORIES[table]))


# -- gold --------------------------------------------------------------------------

def publish(spark: SparkSession, layout: Layout, log: RunLog | None = None
            ) -> dict[str, DataFrame]:
    def cleaned(table: str) -> DataFrame:
        if table in facts.DATES:
            return facts.read(spark, layout.table("silver", table))
        return spark.read.parquet(layout.table("silver", table))

    return refresh_gold(
        spark, f"{layout.root}/gold", log=log,
        transactions=read_split(spark, layout, "transactions")[0],
        orders=read_split(spark, layout, "orders")[0],
        returns=cleaned("returns"), regions=cleaned("regions"),
        **{t: read_current(spark, layout, t) for t in HISTORIES})
