"""Queries that land data first: file, table and topic streams, the log table.

Each writes its input below a fresh work folder, runs the job to its end and returns
what came out.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, functions as F

from acceptance.feeds import Lake, plain
from larder.operators import audit, checks, quality, scd2
from larder.plans import incremental
from larder.session import work_dir
from larder.sources import evolving, files, lineage, tables, topics
from larder.streaming import facts, jobs, scd2_apply
from larder.streaming.watch import Watch

_TEXT = {
    "transactions": ("product_id", "customer_id", "store_id", "transaction_date", "quantity"),
    "returns": ("product_id", "store_id", "return_date", "quantity"),
    "stores": ("store_id", "region_id", "store_name", "store_city", "store_state",
               "first_opened_date", "last_remodel_date"),
    "regions": ("region_id", "sales_region", "sales_district"),
    "calendar": ("date",),
}


def text_columns(table: str) -> tuple[str, ...]:
    return _TEXT[table]


def _csv_folder(lake: Lake, table: str) -> str:
    folder = f"{work_dir(lake.spark, table)}/in"
    rows = getattr(lake, table).select(*_TEXT[table])
    rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(folder)
    return folder


def _parquet_folder(lake: Lake, df: DataFrame, label: str) -> str:
    folder = f"{work_dir(lake.spark, label)}/in"
    df.write.parquet(folder)
    return folder


def _append(lake: Lake, stream: DataFrame, label: str) -> DataFrame:
    out = work_dir(lake.spark, f"{label}-out")
    jobs.run_append(stream, f"{out}/table", f"{out}/checkpoint")
    return lake.spark.read.schema(stream.schema).parquet(f"{out}/table")


def _landed_files(lake: Lake, table: str, max_files: int | None = None) -> DataFrame:
    folder = _csv_folder(lake, table)
    stream = files.csv_stream(lake.spark, folder, _TEXT[table], max_files)
    return _append(lake, stream, table)


def bronze_files(lake: Lake, table: str, max_files: int | None = None) -> DataFrame:
    return _landed_files(lake, table, max_files).select(*_TEXT[table], "_source_system")


def landed_lineage(lake: Lake) -> DataFrame:
    named = F.col("source_file_path").endswith(F.concat(F.lit("/"), F.col("source_file_name")))
    return _landed_files(lake, "transactions").groupBy("_source_system").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(named).alias("with_file_name"),
        F.count("ingestion_timestamp").alias("with_load_time"))


def evolving_folder(lake: Lake) -> DataFrame:
    """Two generations of files: the second has a new column and another order."""
    folder = work_dir(lake.spark, "evolving")
    rows = lake.table("supplier").selectExpr(
        "CAST(s_suppkey AS STRING) AS store_id", "s_name AS store_name",
        "CAST(s_nationkey AS STRING) AS nation")
    rows.select("store_id", "store_name").write.option("header", True).csv(f"{folder}/first")
    rows.select("nation", "store_name", "store_id").write.option("header", True).csv(
        f"{folder}/second")
    return files.csv_evolving(lake.spark, folder)


def _land(lake: Lake, base: str, columns: tuple[str, ...] = (), evolve: bool = True) -> DataFrame:
    evolving.run_landing(lake.spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", columns, evolve)
    return evolving.read(lake.spark, f"{base}/out")


def _orders_text(lake: Lake) -> DataFrame:
    return lake.table("orders").select(*(F.col(c).cast("string").alias(n) for c, n in (
        ("o_orderkey", "order_id"), ("o_custkey", "customer_id"), ("o_orderpriority", "priority"))))


def streamed_evolution(lake: Lake) -> DataFrame:
    """The stream's second run meets a new column in front of the others, in another order."""
    base, rows = work_dir(lake.spark, "evolution"), _orders_text(lake)
    for columns in (("order_id", "customer_id"), ("priority", "customer_id", "order_id")):
        rows.select(*columns).write.mode("append").option("header", True).csv(f"{base}/in")
        landed = _land(lake, base)
    return landed.select("order_id", "customer_id", "priority", evolving.RESCUED, "_source_system")


def streamed_rescue(lake: Lake) -> DataFrame:
    """A fixed table: a column it does not have and a field beyond the header are kept as JSON."""
    base = work_dir(lake.spark, "rescue")
    rows = lake.table("events").selectExpr(
        "event_id", "user_id", "IF(event_id % 83 = 0, concat(event_type, ',surplus'), event_type) AS event_type")
    for columns in (("event_id", "event_type"), ("user_id", "event_id", "event_type")):
        # as plain lines, so that the comma inside makes a field of its own
        lines = rows.select(F.concat_ws(",", *columns).alias("line"), (F.monotonically_increasing_id().bitwiseAND(
            F.lit((1 << 33) - 1)) == 0).alias("first"))
        lines.select(F.explode(F.when(F.col("first"), F.array(F.lit(",".join(columns)), "line")).otherwise(
            F.array("line"))).alias("value")).write.mode("append").text(f"{base}/in")
        landed = _land(lake, base, ("event_id", "event_type"), False)
    return landed.select("event_id", "event_type", evolving.RESCUED)


def reconciled_files(lake: Lake) -> DataFrame:
    """Source files against landed rows; one folder arrived after the landing and is missed."""
    spark, base = lake.spark, work_dir(lake.spark, "reconcile")
    part = F.pmod(F.coalesce(F.col("store_id").try_cast("int"), F.lit(0)), F.lit(8))
    rows = lake.transactions.select(*_TEXT["transactions"]).withColumn("part", part)
    writer = lambda df: df.write.mode("append").option("header", True).partitionBy("part").csv(
        f"{base}/in")
    writer(rows.where("part <> 3"))
    landed = _land(lake, base, _TEXT["transactions"])
    writer(rows.where("part = 3"))
    source = files.csv_inferred(spark, f"{base}/in")
    found = checks.files_agree(
        source, landed, F.col("_metadata.file_path"), F.col("source_file_path"),
        F.col("quantity").try_cast("int"), F.col("quantity").try_cast("int"))
    return found.groupBy(F.regexp_extract("file", "part=([0-9]+)", 1).cast("int").alias("part")).agg(
        *(F.sum(c).alias(c) for c in ("source_rows", "landed_rows", "source_sum", "landed_sum")),
        F.every("reconciles").alias("reconciles"))


def corrupt_lines(lake: Lake) -> DataFrame:
    """Lines with one field too many keep their text in the corrupt column."""
    folder = f"{work_dir(lake.spark, 'corrupt')}/in"
    lake.table("events").selectExpr(
        "concat_ws(',', event_id, event_type, IF(event_id % 83 = 0, 'surplus', NULL)) AS value"
    ).write.text(folder)
    reader = lake.spark.read.schema(files.text_schema(["event_id", "event_type"], corrupt=True))
    return reader.option("columnNameOfCorruptRecord", files.CORRUPT).csv(folder)


def bronze_table(lake: Lake, df: DataFrame, label: str,
                 max_files: int | None = None) -> DataFrame:
    """The rows as a stream over a landed table."""
    return tables.parquet_stream(lake.spark, _parquet_folder(lake, df, label), max_files)


def streamed_documents(lake: Lake, table: str) -> DataFrame:
    documents = getattr(lake, table).select("_id", "data")
    stream = lineage.landed(bronze_table(lake, documents, table), lineage.REPLICATED)
    shown = {"products": ("product_name", "product_sku"),
             "customers": ("customer_acct_num", "yearly_income", "total_children")}[table]
    return _append(lake, stream, table).select(
        "_id", *(F.trim(F.get_json_object("data", f"$.{c}")).alias(c) for c in shown),
        "_source_system")


def streamed_topic(lake: Lake, topic: str, max_files: int | None = None) -> DataFrame:
    records = {"orders": lake.order_records, "inventory": lake.inventory_records}[topic]
    stream = topics.raw_payloads(bronze_table(lake, records, topic, max_files))
    return plain(_append(lake, stream, topic).select(
        "topic", "partition", "offset", "timestamp", "_source_system"))


def streamed_orders(lake: Lake) -> DataFrame:
    stream = bronze_table(lake, lake.bronze_orders, "orders-bronze")
    return plain(_append(lake, jobs.orders(stream, lake.clock), "orders"))


def streamed_facts(lake: Lake, table: str) -> DataFrame:
    """Three runs of one stream, by order number; the last one brings all rows once more."""
    spark, base = lake.spark, work_dir(lake.spark, f"facts-{table}")
    rows = getattr(lake, table)
    third = lake.table("orders").agg(F.max("o_orderkey")).first()[0] // 3 + 1
    for n in range(4):
        part = rows if n == 3 else rows.where(F.floor(F.col("l_orderkey") / third) == n)
        part.write.mode("append").parquet(f"{base}/in")
        stream = tables.parquet_stream(spark, f"{base}/in")
        order = ["l_orderkey", "l_linenumber", "quantity"] if table == "transactions" else [
            "l_orderkey", "quantity"]
        facts.run_facts(stream, table, f"{base}/out", f"{base}/checkpoint", order, lake.clock,
                        "month")
    return plain(facts.read(spark, f"{base}/out").drop("l_orderkey", "l_linenumber"))


#: Sale lines to a landed file, about.
FILE_ROWS = 500_000


def watched(lake: Lake) -> DataFrame:
    """The log of a stream over three micro-batches, started again for two more.

    Each micro-batch has as many files as it takes to keep them, and the tasks that read them, small.
    """
    spark, base = lake.spark, work_dir(lake.spark, "watched")
    files = max(1, lake.table("lineitem").count() // (2 * FILE_ROWS))
    rows = lake.silver_transactions.drop("l_orderkey", "l_linenumber")
    with Watch(spark, f"{base}/log") as watch:
        for n in range(2):
            rows.repartition((3 - n) * files).write.mode("append").parquet(f"{base}/in")
            stream = watch.observed(tables.parquet_stream(spark, f"{base}/in", files), "silver", "transactions")
            jobs.run_append(stream, f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/log")


def streamed_row_counts(lake: Lake) -> DataFrame:
    return watched(lake).where("event_type = 'ROW_COUNT'").groupBy("layer", "table_name", "log_level").agg(
        F.count_distinct("batch").alias("n_batches"), F.count(F.lit(1)).alias("n_events"),
        F.sum("row_count_input").alias("rows_in"), F.sum("row_count_output").alias("rows_out"))


def streamed_expectations(lake: Lake) -> DataFrame:
    checked = watched(lake).where("event_type = 'DQ_CHECK'")
    said = lambda key: F.get_json_object("extra_metrics", f"$.{key}")
    return checked.groupBy("table_name", said("check").alias("rule")).agg(
        F.sum(said("rows").cast("bigint") - said("failed").cast("bigint")).alias("passed"),
        F.sum(said("failed").cast("bigint")).alias("failed"))


def streamed_inventory(lake: Lake) -> DataFrame:
    """Without the broker times: which of two equal payloads comes first is open."""
    stream = bronze_table(lake, lake.bronze_inventory, "inventory-bronze")
    rows = _append(lake, jobs.inventory(stream, lake.clock), "inventory")
    return plain(rows.drop("timestamp", "processing_time"))


def late_orders(lake: Lake) -> DataFrame:
    """All orders, then one new order at the time of every event again.

    The second run starts with the watermark of the first: only orders less than ten
    minutes behind the last event still get in.
    """
    spark = lake.spark
    base = work_dir(spark, "late")
    folder, table, checkpoint = f"{base}/in", f"{base}/out", f"{base}/checkpoint"
    rows = lake.silver_orders.select("order_id", "event_timestamp")

    def run() -> None:
        source = tables.parquet_stream(spark, folder)
        kept = jobs.keep_first_seen(source, ["order_id", "event_timestamp"],
                                    "event_timestamp", jobs.WATERMARK)
        jobs.run_append(kept, table, checkpoint)

    rows.write.parquet(folder)
    run()
    lake.table("events").selectExpr(
        "concat('LATE-', event_id) AS order_id", "CAST(ts AS TIMESTAMP) AS event_timestamp"
    ).write.mode("append").parquet(folder)
    run()
    return plain(spark.read.schema(rows.schema).parquet(table).withColumnRenamed(
        "event_timestamp", "timestamp"))


def streamed_split(lake: Lake) -> DataFrame:
    base = work_dir(lake.spark, "split")
    stream = bronze_table(lake, lake.silver_orders, "orders-silver", 2)
    jobs.run_split(stream, quality.ORDER_RULES, f"{base}/out", f"{base}/checkpoint", lake.clock)
    good, bad = jobs.read_split(lake.spark, f"{base}/out")
    return plain(good.withColumn("is_valid", F.lit(True)).unionByName(
        bad.withColumn("is_valid", F.lit(False)), allowMissingColumns=True))


def streamed_history(lake: Lake, rows: DataFrame, spec: scd2.Spec) -> DataFrame:
    """Changes in shuffled micro-batches give the same history as one batch."""
    base = work_dir(lake.spark, "history")
    folder = f"{base}/in"
    dealt = [c for c in (spec.sequence_by, *spec.tie_break) if c in rows.columns]
    rows.repartition(3, F.xxhash64(*dealt)).write.parquet(folder)
    stream = tables.parquet_stream(lake.spark, folder, 1)
    scd2_apply.run_history(stream, spec, f"{base}/out", f"{base}/checkpoint")
    return plain(scd2_apply.read_history(lake.spark, f"{base}/out", spec))


def logged(lake: Lake, *batches: DataFrame) -> DataFrame:
    """Appends the log rows one batch after the other and reads the table back."""
    folder = f"{work_dir(lake.spark, 'log')}/log"
    for rows in batches:
        audit.append(rows, path=folder)
    return lake.spark.read.parquet(folder)


@cache
def refreshed(lake: Lake) -> str:
    """The folder of aggregates refreshed twice: first without one row in seven of every third
    month, then again for these late rows' months alone."""
    spark, path = lake.spark, f"{work_dir(lake.spark, 'refreshed')}/gold"

    def late(rows: DataFrame, day: str) -> Column:
        there = F.pmod(F.xxhash64(*rows.columns), F.lit(7)) == 0
        return there & F.coalesce(F.month(day) % 3 == 0, F.lit(True))

    def run(sales: DataFrame, returns: DataFrame, sold: DataFrame, back: DataFrame) -> None:
        incremental.refresh(spark, path, sales=sales, returns=returns, products=lake.dim_product,
                            sale_days=sold.select("transaction_date"),
                            return_days=back.select("return_date"), by="month")

    sold_late, back_late = late(lake.sales, "transaction_date"), late(lake.returned, "return_date")
    early, early_back = lake.sales.where(~sold_late), lake.returned.where(~back_late)
    run(early, early_back, early, early_back)
    run(lake.sales, lake.returned, lake.sales.where(sold_late), lake.returned.where(back_late))
    return path
