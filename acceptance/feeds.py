"""The test tables in the shapes of the retail feeds.

Defects (missing and unknown ids, bad dates, wrong quantities, repeated deliveries,
revisions) are derived from row values, so that the SQL oracle can derive the same ones.  Every feed
covers its whole tables.
"""

from __future__ import annotations

from dataclasses import replace
from functools import cache, cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from larder.operators import quality, scd2
from larder.plans import gold, ops, silver
from larder.session import FREEING, using, work_dir
from larder.sources import lineage, topics

CLOCK = "2024-02-01 00:00:00"       # stands in for the current time
AS_OF = "2024-01-23 00:00:00"       # operations queries look back from here ...
LOOKBACK_DAYS = 15                  # ... so that events on both ends are left out
LOOKBACK = f"{LOOKBACK_DAYS} days"
DEALT = 50_000                      # rows of a table that one task widens into documents
REGION = "Asia"                     # the region with its own managers

# The tables' schemas, stated so that opening one needs no job.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": """c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE,
        c_mktsegment STRING""",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": """p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,
        p_retailprice DOUBLE""",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING,
        o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,
        l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,
        l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ""",
    "events": """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,
        value DOUBLE, props STRING""",
}


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def us_date(name: str) -> str:
    return f"date_format({name}, 'M/d/yyyy')"


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, the form the oracle has."""
    zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


class Lake:
    """All layers over one data folder; nothing runs until a result is asked for."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self.clock = moment(CLOCK)
        self.window = ops.Window(moment(AS_OF), LOOKBACK)

    @cache
    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def dealt(self, name: str) -> DataFrame:
        """The table over so many tasks that each has ``DEALT`` rows or so.

        For feeds whose rows are far wider than the table's: one split of a compressed file may
        hold a million rows, whose documents one task would then build and sort.
        """
        rows = self.table(name)
        tasks = -(-rows.count() // DEALT)
        # by all columns: dealt round robin they would be sorted first, in the tasks that read them
        return rows.repartition(tasks, *rows.columns) if tasks > 1 else rows

    # -- feeds ---------------------------------------------------------------------

    @cached_property
    def transactions(self) -> DataFrame:
        lines = self.table("lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            F.expr("CAST(l_quantity AS INT) AS qty"))
        heads = self.table("orders").selectExpr(
            "o_orderkey", "o_custkey", f"{us_date('o_orderdate')} AS ds")
        # Both sides grow alike, so neither is ever meant to be broadcast.
        joined = lines.join(heads.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        return joined.selectExpr(
            "l_orderkey", "l_linenumber",
            """CASE WHEN (l_orderkey * 7 + l_linenumber) % 101 = 0 THEN NULL
                    WHEN l_orderkey % 127 = 0 THEN concat('X', l_partkey)
                    ELSE CAST(l_partkey AS STRING) END AS product_id""",
            """CASE WHEN (l_orderkey + l_partkey) % 103 = 0 THEN NULL
                    WHEN (l_orderkey + l_suppkey) % 131 = 0 THEN concat('X', o_custkey)
                    ELSE CAST(o_custkey AS STRING) END AS customer_id""",
            """CASE WHEN (l_orderkey * 3 + l_suppkey) % 107 = 0 THEN NULL
                    WHEN (l_orderkey * 5 + l_partkey) % 137 = 0
                    THEN CAST(l_suppkey + 1000000 AS STRING)
                    ELSE CAST(l_suppkey AS STRING) END AS store_id""",
            """CASE WHEN (l_partkey + l_suppkey) % 109 = 0
                    THEN 'not-a-date' ELSE ds END AS transaction_date""",
            """CASE WHEN (l_orderkey + l_linenumber) % 113 = 0 THEN NULL
                    WHEN (l_orderkey + l_linenumber) % 97 = 0 THEN CAST(-qty AS STRING)
                    ELSE CAST(qty AS STRING) END AS quantity""",
            "explode(sequence(1, IF(l_orderkey % 50 = 0, 2, 1))) AS delivery",
        ).drop("delivery")

    @cached_property
    def returns(self) -> DataFrame:
        return self.table("lineitem").where("l_returnflag = 'R'").selectExpr(
            "l_orderkey", "CAST(l_partkey AS STRING) AS product_id",
            "CAST(l_suppkey AS STRING) AS store_id",
            f"{us_date('l_shipdate')} AS return_date",
            """CASE WHEN l_orderkey % 89 = 0 THEN '0'
                    ELSE CAST(CAST(l_quantity AS INT) % 5 + 1 AS STRING) END AS quantity""")

    @cached_property
    def stores(self) -> DataFrame:
        """Store rows, one to four revisions each."""
        nations = self.table("nation").select("n_nationkey", "n_name")
        revised = self.table("supplier").selectExpr(
            "*", "explode(sequence(1, 1 + CAST(s_suppkey % 4 AS INT))) AS rev")
        return revised.join(F.broadcast(nations), F.col("s_nationkey") == F.col("n_nationkey")).selectExpr(
            "rev", "CAST(s_suppkey AS STRING) AS store_id",
            "CAST((s_nationkey + rev div 3) % 25 AS STRING) AS region_id",
            "concat('  ', s_name, IF(rev > 3, ' II', ''), ' ') AS store_name",
            "concat('city ', lower(n_name), ' ', rev) AS store_city",
            "lower(n_name) AS store_state",
            """concat(s_nationkey % 12 + 1, '/', s_suppkey % 28 + 1, '/2001')
               AS first_opened_date""",
            """CASE WHEN s_suppkey % 7 <> 0 THEN concat('6/', s_suppkey % 28 + 1, '/2010') END
               AS last_remodel_date""")

    @cached_property
    def regions(self) -> DataFrame:
        names = self.table("region")
        return self.table("nation").join(
            names, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
            "CAST(n_nationkey AS STRING) AS region_id", "lower(r_name) AS sales_region",
            "lower(n_name) AS sales_district",
            "explode(sequence(1, IF(n_nationkey % 5 = 0, 2, 1))) AS rev")

    @cached_property
    def calendar(self) -> DataFrame:
        return self.table("orders").selectExpr(
            f"IF(o_orderkey % 500 = 0, 'bad', {us_date('o_orderdate')}) AS date").distinct()

    def _documents(self, rows: DataFrame) -> DataFrame:
        """(_id, data) with lineage; revision r was landed r days after a fixed start."""
        fields = [c for c in rows.columns if c not in ("_id", "rev")]
        packed = rows.select("_id", "rev", F.to_json(F.struct(*fields)).alias("data"))
        at = F.timestamp_add("DAY", F.col("rev"), moment("2024-01-01 00:00:00"))
        return lineage.landed(packed, lineage.REPLICATED, at)

    @cached_property
    def products(self) -> DataFrame:
        return self._documents(self.dealt("part").selectExpr(
            "*", "explode(sequence(1, 1 + CAST(p_partkey % 3 AS INT))) AS rev").selectExpr(
            "rev", "CAST(p_partkey AS STRING) AS _id",
            "CASE WHEN rev = 1 OR (p_partkey + rev) % 5 <> 0 THEN p_brand END AS product_brand",
            "concat('  ', p_name, ' ') AS product_name",
            "p_partkey * 7 + rev AS product_sku",
            """round(p_retailprice + IF((p_partkey + rev) % 4 = 0, 10.0, 0.0)
                + p_partkey % 8 * 0.000123, 6) AS product_retail_price""",
            "p_retailprice - 250.0 AS product_cost",
            "CAST(p_size AS DOUBLE) AS product_weight",
            "p_size % 2 AS recyclable", "CAST(p_partkey % 2 AS INT) AS low_fat"))

    @cached_property
    def customers(self) -> DataFrame:
        nations, regions = self.table("nation"), self.table("region")
        places = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
            "n_nationkey", "n_name", "r_name")
        revised = self.dealt("customer").selectExpr(
            "*", "explode(sequence(1, 1 + CAST(c_custkey % 4 AS INT))) AS rev")
        # the hint: by the size of their file the customers may pass for the smaller side
        joined = revised.join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
        return self._documents(joined.selectExpr(
            "rev", "CAST(c_custkey AS STRING) AS _id",
            "c_custkey * 1000 AS customer_acct_num", "c_mktsegment AS first_name",
            "CASE WHEN c_custkey % 11 <> 0 THEN c_name END AS last_name",
            "n_name AS customer_city", "n_name AS customer_state_province",
            "r_name AS customer_country",
            "concat(c_custkey % 12 + 1, '/15/1980') AS birthdate",
            "IF((c_custkey + rev div 2) % 2 = 0, 'M', 'S') AS marital_status",
            """CASE WHEN c_acctbal + 2000 * rev < 2000 THEN '$10K - $30K'
                    WHEN c_acctbal + 2000 * rev < 8000 THEN '$30K - $50K'
                    ELSE '$50K - $70K' END AS yearly_income""",
            "IF(c_custkey % 3 = 0, 'F', 'M') AS gender",
            "CAST((c_custkey + rev) % 5 AS INT) AS total_children",
            "concat('6/', c_custkey % 28 + 1, '/2005') AS acct_open_date",
            "CASE WHEN (c_custkey + rev) % 6 <> 0 THEN c_mktsegment END AS occupation",
            "IF(c_custkey % 4 = 0, 'N', 'Y') AS homeowner"))

    @cached_property
    def order_records(self) -> DataFrame:
        """Topic records; some arrive twice, some again a minute later, some are broken."""
        payload = self.table("events").selectExpr(
            "event_id", "ts",
            """to_json(struct(
                CASE WHEN event_id % 83 <> 0 THEN concat('ORD-', event_id) END AS order_id,
                CAST(event_id % 200 AS INT) AS product_id,
                CAST(user_id AS INT) AS customer_id,
                CAST(event_id % 10 AS INT) AS store_id,
                CAST(floor(value) AS INT) % 12 - 1 AS quantity,
                date_format(ts, 'M/d/yyyy') AS order_date,
                IF(event_id % 2 = 0, 'card', 'cash') AS payment_type,
                event_type AS order_channel)) AS body""",
            """explode(concat(array(0), IF(event_id % 40 = 0, array(0), array()),
                              IF(event_id % 61 = 0, array(1), array()))) AS late""")
        return payload.selectExpr(
            "CAST(CAST(event_id AS STRING) AS BINARY) AS key",
            "CAST(IF(event_id % 199 = 0, left(body, 9), body) AS BINARY) AS value",
            "'orders' AS topic", "CAST(event_id % 4 AS INT) AS partition",
            "event_id AS offset",
            "CAST(ts + make_dt_interval(0, 0, late) AS TIMESTAMP) AS timestamp")

    @cached_property
    def inventory_records(self) -> DataFrame:
        payload = self.table("events").selectExpr(
            "event_id", "ts", "CAST(get_json_object(props, '$.k') AS INT) AS k",
            "CAST(floor(value) AS INT) - 5 AS remaining",
            "explode(IF(event_id % 45 = 0, array(0, 1), array(0))) AS late")
        return payload.selectExpr(
            "CAST(CAST(event_id AS STRING) AS BINARY) AS key",
            """CAST(to_json(struct(
                concat('INV-', event_id) AS inventory_id,
                CAST(ts AS STRING) AS event_timestamp, k AS product_id,
                CASE WHEN event_id % 71 <> 0 THEN CAST(event_id % 10 AS INT) END AS store_id,
                k % 3 AS quantity_added, remaining AS quantity_remaining)) AS BINARY) AS value""",
            "'inventory' AS topic", "CAST(event_id % 4 AS INT) AS partition",
            "event_id AS offset",
            "CAST(ts + make_dt_interval(0, 0, late) AS TIMESTAMP) AS timestamp")

    @cached_property
    def changes(self) -> DataFrame:
        """A change feed by user with values that are not always mentioned."""
        return self.table("events").selectExpr(
            "user_id", "ts",
            "CASE WHEN event_id % 7 <> 0 THEN event_type END AS event_type",
            "CASE WHEN event_id % 5 <> 0 THEN value END AS value")

    # -- cleaned tables ------------------------------------------------------------

    @cached_property
    def silver_transactions(self) -> DataFrame:
        return silver.silver_csv(self.transactions, "transactions",
                                 ["l_orderkey", "l_linenumber", "quantity"], self.clock)

    @cached_property
    def silver_returns(self) -> DataFrame:
        return silver.silver_csv(self.returns, "returns", ["l_orderkey", "quantity"],
                                 self.clock)

    @cached_property
    def silver_stores(self) -> DataFrame:
        return silver.silver_csv(self.stores, "stores", ["rev"], self.clock)

    @cached_property
    def silver_regions(self) -> DataFrame:
        return silver.silver_csv(self.regions, "regions", ["rev"], self.clock)

    @cached_property
    def silver_calendar(self) -> DataFrame:
        return silver.silver_csv(self.calendar, "calendar", clock=self.clock)

    @cached_property
    def bronze_orders(self) -> DataFrame:
        return topics.raw_payloads(self.order_records, self.clock)

    @cached_property
    def bronze_inventory(self) -> DataFrame:
        return topics.raw_payloads(self.inventory_records, self.clock)

    @cached_property
    def silver_orders(self) -> DataFrame:
        return silver.silver_orders(self.bronze_orders, ["timestamp"], self.clock)

    @cached_property
    def silver_inventory(self) -> DataFrame:
        return silver.silver_inventory(self.bronze_inventory, ["timestamp"], self.clock)

    @cached_property
    def silver_customers(self) -> DataFrame:
        return silver.silver_customers(self.customers, ["ingestion_timestamp"], self.clock)

    @cached_property
    def silver_products(self) -> DataFrame:
        return silver.silver_products(self.products, ["ingestion_timestamp"], self.clock)

    @cache
    def valid(self, table: str) -> DataFrame:
        rows, rules = self._ruled(table)
        return silver.mark_valid(quality.valid(rows, rules), self.clock)

    @cache
    def quarantine(self, table: str) -> DataFrame:
        rows, rules = self._ruled(table)
        return quality.quarantined(rows, rules, clock=self.clock)

    def _ruled(self, table: str) -> tuple[DataFrame, quality.Rules]:
        return {
            "transactions": (self.silver_transactions, quality.TRANSACTION_RULES),
            "orders": (self.silver_orders, quality.ORDER_RULES),
            "inventory": (self.silver_inventory, quality.INVENTORY_RULES),
        }[table]

    # -- change feeds of the dimensions, not deduplicated by key --------------------

    @cached_property
    def product_changes(self) -> DataFrame:
        return silver.conform_products(self.products, ["ingestion_timestamp"])

    @cached_property
    def customer_changes(self) -> DataFrame:
        return silver.conform_customers(self.customers, ["ingestion_timestamp"])

    @cached_property
    def store_changes(self) -> DataFrame:
        at = F.timestamp_add("DAY", F.col("rev"), moment("2024-01-01 00:00:00"))
        return silver.conform_csv(self.stores, "stores").withColumn(
            "ingestion_timestamp", at).drop("rev")

    @cached_property
    def spec(self) -> dict[str, scd2.Spec]:
        def spec(key: str, table: str, ignore_nulls: bool) -> scd2.Spec:
            return scd2.Spec([key], "ingestion_timestamp", silver.TRACKED[table], ignore_nulls)

        return {
            "products": spec("product_id", "products", True),
            "customers": spec("customer_id", "customers", True),
            "stores": spec("store_id", "stores", False),
            "changes": scd2.Spec(["user_id"], "ts", ["event_type"]),
        }

    @cache
    def same_batch(self, table: str) -> DataFrame:
        """The change feed with every two revisions landed at one time; ``rev`` is their place."""
        at = F.timestamp_add("DAY", F.expr("(rev + 1) div 2"), moment("2024-01-01 00:00:00"))
        rows = getattr(self, table).withColumn("ingestion_timestamp", at)
        kept = ["ingestion_timestamp", "rev"]
        return {"products": lambda: silver.conform_products(rows, kept),
                "customers": lambda: silver.conform_customers(rows, kept),
                "stores": lambda: silver.conform_csv(rows, "stores")}[table]()

    def placed_spec(self, table: str) -> scd2.Spec:
        return replace(self.spec[table], tie_break=("rev",))

    def feed(self, table: str) -> DataFrame:
        return {"products": self.product_changes, "customers": self.customer_changes,
                "stores": self.store_changes, "changes": self.changes}[table]

    @cache
    def versions(self, table: str) -> DataFrame:
        return scd2.history(self.feed(table), self.spec[table])

    @cache
    def latest(self, table: str) -> DataFrame:
        return scd2.latest_state(self.feed(table), self.spec[table])

    # -- star schema ---------------------------------------------------------------
    #
    # Facts join stored dimensions and reports read stored facts, as they do in a
    # lakehouse: nothing is computed once per reader, sizes are known when a join is
    # planned, and a hot key's partition sits right below the join that may split it.

    def _stored(self, name: str, df: DataFrame) -> DataFrame:
        path = work_dir(self.spark, name)
        with using(self.spark, FREEING):
            df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cache
    def current(self, table: str) -> DataFrame:
        return self._stored(f"current-{table}", self.latest(table))

    @cached_property
    def dim_customer(self) -> DataFrame:
        return gold.dim_customer(self.current("customers"))

    @cached_property
    def dim_product(self) -> DataFrame:
        return gold.dim_product(self.current("products"))

    @cached_property
    def dim_store(self) -> DataFrame:
        return self._stored("dim-store", gold.dim_store(
            self.latest("stores"), self.silver_regions))

    @cached_property
    def fact_sales(self) -> DataFrame:
        return gold.fact_sales(self.valid("transactions"), self.valid("orders"),
                               self.current("products"))

    @cached_property
    def fact_returns(self) -> DataFrame:
        return gold.fact_returns(self.silver_returns, self.current("products"))

    @cached_property
    def sales(self) -> DataFrame:
        return self._stored("fact-sales", self.fact_sales)

    @cached_property
    def returned(self) -> DataFrame:
        return self._stored("fact-returns", self.fact_returns)

    def gold_tables(self, *read: str) -> dict[str, DataFrame]:
        """Facts and dimensions by name: stored those that are ``read``, of others the plan."""
        stored = {
            "fact_sales": lambda: self.sales, "fact_returns": lambda: self.returned,
            "dim_store": lambda: self.dim_store, "dim_customer": lambda: self.dim_customer,
            "dim_product": lambda: self.dim_product}
        plans = {
            "fact_sales": lambda: gold.fact_sales(self.valid("transactions"), self.valid("orders"),
                                                  self.latest("products")),
            "fact_returns": lambda: gold.fact_returns(self.silver_returns, self.latest("products")),
            "dim_store": lambda: gold.dim_store(self.latest("stores"), self.silver_regions),
            "dim_customer": lambda: gold.dim_customer(self.latest("customers")),
            "dim_product": lambda: gold.dim_product(self.latest("products"))}
        return {name: (stored if name in read else plans)[name]() for name in plans}
