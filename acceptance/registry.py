"""Every query by name: how Spark answers it and what the oracle runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from acceptance.feeds import CLOCK, REGION, Lake, moment, plain
from acceptance.landing import (bronze_files, corrupt_lines, reconciled_files,
                                streamed_evolution, streamed_expectations, streamed_facts,
                                streamed_rescue, streamed_row_counts, evolving_folder, landed_lineage,
                                late_orders, logged, refreshed, streamed_documents, streamed_history,
                                streamed_inventory, streamed_orders, streamed_split,
                                streamed_topic, text_columns)
from acceptance.oracle import _CLOCK, _NOW, _RULES, _n, _reason, _round2, _total, _verdict, query
from larder.functions.money import exact_sum
from larder.functions.scalar import full_name, minute_of, parse_date, upper_case
from larder.operators import audit, checks, quality, scd2
from larder.plans import gold, incremental, ops, secure, silver
from larder.sources import lineage

Answer = Callable[[Lake], DataFrame]
QUERIES: dict[str, Answer] = {}
ORACLE: dict[str, str] = {}


def add(name: str, answer: Answer, sql: str | None = None) -> None:
    QUERIES[name] = answer
    if sql:
        ORACLE[name] = query(sql)


def _run() -> audit.Run:
    return audit.Run("retail", "run-1", "test", "lake", moment(CLOCK))


# -- bronze ------------------------------------------------------------------------

for _table in ("transactions", "returns", "stores", "regions", "calendar"):
    _columns = ", ".join(text_columns(_table))
    add(f"bronze_{_table}", lambda lake, t=_table: bronze_files(lake, t),
        f"SELECT {_columns}, 'adls' AS _source_system FROM f_{_table}")

add("stream_bronze_transactions", lambda lake: bronze_files(lake, "transactions", 2),
    f"""SELECT {", ".join(text_columns("transactions"))}, 'adls' AS _source_system
        FROM f_transactions""")
add("bronze_lineage", landed_lineage,
    """SELECT COUNT(*) AS n_rows, COUNT(*) AS with_file_name, COUNT(*) AS with_load_time,
       'adls' AS _source_system FROM f_transactions""")
add("csv_schema_evolution", evolving_folder,
    """SELECT CAST(s_suppkey AS VARCHAR) AS store_id, s_name AS store_name,
       CAST(NULL AS VARCHAR) AS nation FROM supplier
       UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR)
       FROM supplier""")
_GENERATION = """CAST(o_orderkey AS VARCHAR) AS order_id,
    CAST(o_custkey AS VARCHAR) AS customer_id, {} AS priority,
    CAST(NULL AS VARCHAR) AS _rescued_data, 'adls' AS _source_system FROM orders"""
add("stream_csv_evolution", streamed_evolution,
    f"""SELECT {_GENERATION.format("CAST(NULL AS VARCHAR)")}
        UNION ALL SELECT {_GENERATION.format("o_orderpriority")}""")
_SURPLUS = "event_id % 83 = 0"
add("stream_rescued", streamed_rescue,
    f"""SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
        CASE WHEN {_SURPLUS} THEN '{{"_c2":"surplus"}}' END AS _rescued_data FROM events
        UNION ALL SELECT CAST(event_id AS VARCHAR), event_type, '{{"user_id":"' || user_id || '"'
        || CASE WHEN {_SURPLUS} THEN ',"_c3":"surplus"' ELSE '' END || '}}' FROM events""")
add("source_files", reconciled_files,
    f"""SELECT part, COUNT(*) AS source_rows,
        CAST(CASE WHEN part = 3 THEN 0 ELSE COUNT(*) END AS BIGINT) AS landed_rows,
        coalesce(CAST(SUM(TRY_CAST(quantity AS INT)) AS DOUBLE), 0.0) AS source_sum,
        CASE WHEN part = 3 THEN 0.0 ELSE coalesce(CAST(SUM(TRY_CAST(quantity AS INT)) AS DOUBLE), 0.0)
            END AS landed_sum, part <> 3 AS reconciles
        FROM (SELECT *, CAST(coalesce(TRY_CAST(store_id AS INT), 0) % 8 AS INT) AS part
              FROM f_transactions) GROUP BY part""")
add("bronze_corrupt_records", corrupt_lines,
    """SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
       CASE WHEN event_id % 83 = 0 THEN event_id || ',' || event_type || ',surplus' END
           AS _corrupt_record FROM events""")

_DOCS = {
    "products": ("product_id", "product_name, product_sku, product_retail_price"),
    "customers": ("customer_id", "customer_acct_num, yearly_income, total_children"),
}
for _table, (_key, _some) in _DOCS.items():
    _casts = ", ".join(f"CAST({c.strip()} AS VARCHAR) AS {c.strip()}"
                       for c in _some.split(",") if "price" not in c)
    add(f"bronze_{_table}", lambda lake, t=_table: streamed_documents(lake, t),
        f"""SELECT {_key} AS _id, {_casts}, 'fivetran' AS _source_system
            FROM c_{_table}""")

for _table in ("orders", "inventory"):
    add(f"bronze_{_table}", lambda lake, t=_table: streamed_topic(lake, t),
        f"""SELECT '{_table}' AS topic, CAST(event_id % 4 AS INT) AS "partition",
            event_id AS "offset", "timestamp", 'kafka' AS _source_system FROM f_{_table}""")
add("stream_bronze_orders", lambda lake: streamed_topic(lake, "orders", 2),
    """SELECT 'orders' AS topic, CAST(event_id % 4 AS INT) AS "partition",
       event_id AS "offset", "timestamp", 'kafka' AS _source_system FROM f_orders""")


# -- silver ------------------------------------------------------------------------

def _without_order(df: DataFrame, *extra: str) -> DataFrame:
    return plain(df.drop("l_orderkey", "l_linenumber", "rev", *extra))


for _table in ("transactions", "returns", "stores", "regions", "calendar"):
    add(f"silver_{_table}",
        lambda lake, t=_table: _without_order(getattr(lake, f"silver_{t}")),
        f"SELECT * FROM s_{_table}")
for _table in ("orders", "inventory"):
    add(f"silver_{_table}", lambda lake, t=_table: plain(getattr(lake, f"silver_{t}")),
        f"SELECT * FROM s_{_table}")
for _table in ("customers", "products"):
    add(f"silver_{_table}", lambda lake, t=_table: plain(getattr(lake, f"silver_{t}")),
        f"SELECT * FROM s_{_table}")

add("orders_flatten",
    lambda lake: plain(silver.flatten_orders(lake.bronze_orders)),
    """SELECT * EXCLUDE (event_id), "timestamp" AS event_timestamp FROM f_orders""")
add("inventory_flatten",
    lambda lake: plain(silver.flatten_inventory(lake.bronze_inventory)),
    """SELECT * EXCLUDE (event_id), "timestamp" AS processing_time FROM f_inventory""")
add("record_status",
    lambda lake: lake.silver_transactions.groupBy("record_status").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("quantity").alias("n_quantities")),
    """SELECT record_status, COUNT(*) AS n_rows, COUNT(quantity) AS n_quantities
       FROM s_transactions GROUP BY record_status""")
add("inventory_stock_status",
    lambda lake: lake.silver_inventory.groupBy("stock_status").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("quantity_remaining").alias("lowest"),
        F.max("quantity_remaining").alias("highest")),
    """SELECT stock_status, COUNT(*) AS n_rows, MIN(quantity_remaining) AS lowest,
       MAX(quantity_remaining) AS highest FROM s_inventory GROUP BY stock_status""")
add("inventory_restock",
    lambda lake: lake.silver_inventory.groupBy("is_restock").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("quantity_added").alias("added")),
    f"""SELECT is_restock, COUNT(*) AS n_rows, {_n("SUM(quantity_added)")} AS added
        FROM s_inventory GROUP BY is_restock""")


def _scalar_cleaning(lake: Lake) -> DataFrame:
    """The text and date functions over suppliers, nations and orders."""
    shown = lake.table("orders").selectExpr(
        "o_orderkey", "o_custkey", "concat('  ', o_orderpriority, ' ') AS priority",
        "date_format(o_orderdate, 'M/d/yyyy') AS us",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS iso",
        "IF(o_orderkey % 9 = 0, 'soon', date_format(o_orderdate, 'M/d/yyyy')) AS mixed",
        "CAST(o_totalprice AS STRING) AS price", "o_orderstatus", "o_orderdate")
    us, either = parse_date("us"), parse_date("mixed", "yyyy-MM-dd", "M/d/yyyy")
    return shown.select(
        "o_orderkey", F.trim("priority").alias("trimmed"),
        upper_case("o_orderstatus").alias("upper_status"),
        F.initcap(F.lower(F.trim("priority"))).alias("titled"),
        full_name("o_orderstatus", "us").alias("joined"),
        F.concat("o_orderstatus", "mixed").alias("glued"),
        us.alias("us_date"), either.alias("either_date"),
        parse_date("iso", "yyyy-MM-dd").alias("iso_date"),
        F.year(us).alias("year"), F.month(us).alias("month"),
        F.col("mixed").try_cast("int").alias("not_a_number"),
        F.regexp_extract(F.concat_ws("/", "o_orderstatus", "us", F.lit("part.csv")),
                         "([^/]+$)", 1).alias("file_name"),
        minute_of("o_orderdate").cast("timestamp_ntz").alias("minute"))


add("scalar_cleaning", _scalar_cleaning,
    """SELECT o_orderkey, trim(o_orderpriority) AS trimmed,
       upper(o_orderstatus) AS upper_status,
       array_to_string(list_transform(string_split(lower(o_orderpriority), ' '),
           lambda z: upper(z[1]) || lower(z[2:])), ' ') AS titled,
       o_orderstatus || ' ' || strftime(o_orderdate, '%-m/%-d/%Y') AS joined,
       o_orderstatus || CASE WHEN o_orderkey % 9 = 0 THEN 'soon'
           ELSE strftime(o_orderdate, '%-m/%-d/%Y') END AS glued,
       CAST(o_orderdate AS DATE) AS us_date,
       CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) END AS either_date,
       CAST(o_orderdate AS DATE) AS iso_date, CAST(year(o_orderdate) AS INT) AS year,
       CAST(month(o_orderdate) AS INT) AS month, CAST(NULL AS INT) AS not_a_number,
       'part.csv' AS file_name, date_trunc('minute', o_orderdate) AS minute FROM orders""")


# -- deduplication: keys and surplus rows before and after --------------------------

for _table in ("transactions", "stores", "returns", "orders", "inventory", "customers",
               "products", "regions"):
    _keys = [f'"{k}"' for k in silver.KEYS[_table]]
    add(f"dedup_{_table}",
        lambda lake, t=_table: plain(
            getattr(lake, f"silver_{t}").groupBy(*silver.KEYS[t]).agg(
                F.count(F.lit(1)).alias("copies"))),
        f"SELECT {', '.join(_keys)}, COUNT(*) AS copies FROM s_{_table} GROUP BY ALL")


# -- quality -----------------------------------------------------------------------

for _table in ("transactions", "orders", "inventory"):
    add(f"silver_{_table}_valid",
        lambda lake, t=_table: _without_order(lake.valid(t)), f"SELECT * FROM v_{_table}")
    add(f"quarantine_{_table}",
        lambda lake, t=_table: _without_order(lake.quarantine(t)), f"SELECT * FROM q_{_table}")


def _both_sides(lake: Lake) -> DataFrame:
    good, bad = quality.split(lake.silver_transactions, quality.TRANSACTION_RULES,
                              clock=lake.clock)
    literal = quality.quarantined(lake.silver_transactions, quality.TRANSACTION_RULES,
                                  null_safe=False, clock=lake.clock)
    parts = {"valid": good, "quarantined": bad, "quarantined_literal": literal}
    counted = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("side"), "n_rows")
               for n, df in parts.items()]
    return counted[0].union(counted[1]).union(counted[2])


_T_RULES = _RULES["transactions"]
_LITERAL = " AND ".join(f"({p})" for p in _T_RULES.values())
add("quarantine_split", _both_sides,
    f"""SELECT 'valid' AS side, COUNT(*) AS n_rows FROM v_transactions
        UNION ALL SELECT 'quarantined', COUNT(*) FROM q_transactions
        UNION ALL SELECT 'quarantined_literal', COUNT(*) FROM s_transactions
        WHERE NOT ({_LITERAL})""")
add("quarantine_reason",
    lambda lake: quality.judge(lake.silver_transactions, quality.TRANSACTION_RULES).groupBy(
        quality.VERDICT, quality.REASON).agg(F.count(F.lit(1)).alias("n_rows")),
    f"""SELECT {_verdict(_T_RULES)} AS _is_valid, {_reason(_T_RULES)} AS _quarantine_reason,
        COUNT(*) AS n_rows FROM s_transactions GROUP BY ALL""")


def _counts_sql(source: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{n}' AS rule, COUNT(*) FILTER (WHERE coalesce({p}, false)) AS passed,
            COUNT(*) FILTER (WHERE NOT coalesce({p}, false)) AS failed FROM {source}"""
        for n, p in rules.items())


def _all_expectations(lake: Lake) -> DataFrame:
    tables = [
        quality.rule_counts(getattr(lake, f"silver_{t}"), rules).withColumn(
            "table_name", F.lit(t))
        for t, rules in quality.WARNINGS.items()
    ]
    out = tables[0]
    for one in tables[1:]:
        out = out.unionByName(one)
    return out


add("expectation_metrics", _all_expectations, " UNION ALL ".join(
    f"SELECT *, '{t}' AS table_name FROM ({_counts_sql(f's_{t}', dict(rules))})"
    for t, rules in quality.WARNINGS.items()))
add("expect_or_drop_inventory",
    lambda lake: plain(quality.drop_unless(
        lake.silver_inventory, quality.INVENTORY_DROP_UNLESS)),
    "SELECT * FROM s_inventory WHERE store_id IS NOT NULL")
add("expect_or_fail_inventory",
    lambda lake: plain(quality.fail_unless(
        lake.silver_inventory, quality.INVENTORY_MUST_HOLD)),
    "SELECT * FROM s_inventory")


# -- history -----------------------------------------------------------------------

for _table in ("products", "customers", "stores"):
    add(f"scd2_{_table}", lambda lake, t=_table: plain(lake.versions(t)),
        f"SELECT * FROM h_{_table}")
    add(f"scd2_same_batch_{_table}",
        lambda lake, t=_table: plain(scd2.history(lake.same_batch(t), lake.placed_spec(t))),
        f"SELECT * FROM k_{_table}")
add("scd2_tracked_only", lambda lake: plain(lake.versions("changes")),
    "SELECT * FROM h_changes")
add("scd2_ignore_nulls",
    lambda lake: plain(lake.versions("changes").select(
        "user_id", "event_type", scd2.START, scd2.END)),
    """SELECT user_id, event_type, "__START_AT", "__END_AT" FROM h_changes""")
add("scd2_current", lambda lake: plain(scd2.current(lake.versions("changes"))),
    """SELECT * FROM h_changes WHERE "__END_AT" IS NULL""")
add("scd2_single_current",
    lambda lake: scd2.current(lake.versions("changes")).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("open_versions")),
    """SELECT user_id, COUNT(*) AS open_versions FROM h_changes
       WHERE "__END_AT" IS NULL GROUP BY user_id""")
add("scd2_reversed",
    lambda lake: plain(checks.reversed_intervals(lake.versions("changes").withColumn(
        scd2.END, F.col(scd2.END) - F.when(F.length("event_type") == 5, F.expr("INTERVAL 3 DAY"))
        .otherwise(F.expr("INTERVAL 0 DAY"))))),
    """SELECT * FROM (SELECT * REPLACE ("__END_AT" - CASE WHEN length(event_type) = 5
           THEN INTERVAL 3 DAY ELSE INTERVAL 0 DAY END AS "__END_AT") FROM h_changes)
       WHERE "__START_AT" > "__END_AT" """)
add("scd2_not_one_open",
    lambda lake: checks.not_one_open_version(
        lake.versions("changes").unionByName(scd2.current(lake.versions("changes")).where(
            "user_id % 3 = 0")), ["user_id"]),
    """SELECT user_id, COUNT(*) + 1 AS open_versions FROM h_changes
       WHERE "__END_AT" IS NULL AND user_id % 3 = 0 GROUP BY user_id""")
add("scd2_version_unique",
    lambda lake: checks.unique_key(lake.versions("changes"), ["user_id", scd2.START]),
    """SELECT COUNT(*) AS n_rows, COUNT(DISTINCT (user_id, "__START_AT")) AS n_keys,
       COUNT(*) = COUNT(DISTINCT (user_id, "__START_AT")) AS is_unique FROM h_changes""")


def _stretched(lake: Lake) -> DataFrame:
    """Versions of which some were made to end a day too late."""
    late = F.when(F.length("event_type") == 5, F.expr("INTERVAL 1 DAY")).otherwise(
        F.expr("INTERVAL 0 DAY"))
    return lake.versions("changes").withColumn(scd2.END, F.col(scd2.END) + late)


add("scd2_overlaps",
    lambda lake: plain(checks.overlapping_versions(_stretched(lake), ["user_id"])),
    """SELECT b.user_id, b."__START_AT", MAX(a.e) AS runs_until
       FROM (SELECT *, "__END_AT" + CASE WHEN length(event_type) = 5 THEN INTERVAL 1 DAY
                 ELSE INTERVAL 0 DAY END AS e FROM h_changes) a
       JOIN (SELECT *, "__END_AT" + CASE WHEN length(event_type) = 5 THEN INTERVAL 1 DAY
                 ELSE INTERVAL 0 DAY END AS e FROM h_changes) b
       ON a.user_id = b.user_id AND a."__START_AT" < b.e AND b."__START_AT" < a.e
          AND a."__START_AT" < b."__START_AT"
       GROUP BY b.user_id, b."__START_AT" """)


# -- gold --------------------------------------------------------------------------

add("dim_customer", lambda lake: gold.dim_customer(lake.latest("customers")),
    "SELECT * FROM d_customer")
add("dim_product", lambda lake: gold.dim_product(lake.latest("products")),
    "SELECT * FROM d_product")
add("dim_store", lambda lake: gold.dim_store(lake.latest("stores"), lake.silver_regions),
    "SELECT * FROM d_store")
add("sales_union",
    lambda lake: gold.sales_union(lake.valid("transactions"), lake.valid("orders")),
    "SELECT * FROM g_union")
add("fact_sales", lambda lake: lake.fact_sales, "SELECT * FROM g_sales")
add("fact_returns", lambda lake: lake.fact_returns, "SELECT * FROM g_returns")
add("agg_daily_sales", lambda lake: gold.agg_daily_sales(lake.fact_sales, lake.dim_store),
    "SELECT * FROM a_daily")
add("agg_monthly_sales",
    lambda lake: gold.agg_monthly_sales(lake.sales, lake.dim_product),
    "SELECT * FROM a_monthly")
add("agg_store_performance",
    lambda lake: gold.agg_store_performance(lake.sales, lake.returned),
    "SELECT * FROM a_stores")
add("agg_return_kpi", lambda lake: gold.agg_return_kpi(lake.sales, lake.returned),
    "SELECT * FROM a_returns")
add("refresh_incremental_fact_sales",
    lambda lake: incremental.table(lake.spark, refreshed(lake), "fact_sales"),
    "SELECT * FROM g_sales")
add("refresh_incremental_daily",
    lambda lake: incremental.agg_daily_sales(lake.spark, refreshed(lake), lake.dim_store),
    "SELECT * FROM a_daily")
add("refresh_incremental_monthly",
    lambda lake: incremental.agg_monthly_sales(lake.spark, refreshed(lake)),
    "SELECT * FROM a_monthly")
add("refresh_incremental_stores",
    lambda lake: incremental.agg_store_performance(lake.spark, refreshed(lake)),
    "SELECT * FROM a_stores")
add("refresh_incremental_returns",
    lambda lake: incremental.agg_return_kpi(lake.spark, refreshed(lake)),
    "SELECT * FROM a_returns")


# -- secured views -----------------------------------------------------------------

_CALLERS = {
    "admin": {secure.ADMINS}, "engineer": {secure.ENGINEERS}, "analyst": {secure.ANALYSTS},
    "central": {secure.REGION_MANAGERS}, "other": {secure.OTHER_MANAGERS}, "none": set(),
}
_ROWS = {"admin": "true", "engineer": "true", "analyst": "true",
         "central": f"sales_region = '{REGION}'", "other": f"sales_region <> '{REGION}'",
         "none": "false"}
for _who, _groups in _CALLERS.items():
    _sees_money, _sees_names = _who in ("admin", "engineer"), _who == "admin"
    _masked = ", ".join(
        f"{c if _sees_money else 'CAST(NULL AS DOUBLE)'} AS {c}"
        for c in ("total_revenue", "total_cost", "total_profit"))
    add(f"secure_fact_sales_{_who}",
        lambda lake, g=_groups: secure.secure_fact_sales(
            lake.sales, lake.dim_store, g, REGION),
        f"""SELECT transaction_date, store_id, product_id, sales_region, quantity, {_masked}
            FROM g_sales LEFT JOIN (SELECT store_id, sales_region FROM d_store)
            USING (store_id) WHERE {_ROWS[_who]}""")
    add(f"secure_fact_returns_{_who}",
        lambda lake, g=_groups: secure.secure_fact_returns(
            lake.returned, lake.dim_store, g, REGION),
        f"""SELECT g_returns.*, sales_region FROM g_returns
            LEFT JOIN (SELECT store_id AS s, sales_region FROM d_store) ON store_id = s
            WHERE {_ROWS[_who]}""")
    _name = "customer_name" if _sees_names else "'REDACTED'"
    _income = "yearly_income" if _sees_money else "'RESTRICTED'"
    add(f"secure_dim_customer_{_who}",
        lambda lake, g=_groups: secure.secure_dim_customer(lake.dim_customer, g),
        f"""SELECT * REPLACE ({_name} AS customer_name, {_income} AS yearly_income)
            FROM d_customer""")
    _cost = "product_cost" if _sees_money else "CAST(NULL AS DOUBLE)"
    add(f"secure_dim_product_{_who}",
        lambda lake, g=_groups: secure.secure_dim_product(lake.dim_product, g),
        f"SELECT * REPLACE ({_cost} AS product_cost) FROM d_product")


def _sql_view(view: str, groups: set[str]) -> Answer:
    def answer(lake: Lake) -> DataFrame:
        read = (view, "dim_store") if view.startswith("fact_") else (view,)
        secure.create_sql_views(lake.spark, lake.gold_tables(*read), REGION)
        secure.act_as(lake.spark, groups)
        return lake.spark.sql(f"SELECT * FROM v_secure_{view}")

    return answer


for _who, _groups in _CALLERS.items():
    for _view in ("fact_sales", "fact_returns", "dim_customer", "dim_product"):
        QUERIES[f"sql_secure_{_view}_{_who}"] = _sql_view(_view, _groups)
        ORACLE[f"sql_secure_{_view}_{_who}"] = ORACLE[f"secure_{_view}_{_who}"]


# -- operations --------------------------------------------------------------------

def _ops(name: str, sql: str, *inputs: str) -> None:
    def answer(lake: Lake) -> DataFrame:
        frames = [getattr(lake, f"silver_{i}") for i in inputs]
        return plain(getattr(ops, name)(*frames, lake.window))

    add(f"ops_{name}", answer, sql)


_T = '"timestamp"'
_MINUTE = f"date_trunc('minute', {_T})"
_BAND = """CASE WHEN quantity_remaining < 10 THEN 'Low'
    WHEN quantity_remaining < 50 THEN 'Medium' ELSE 'High' END"""
_LOW = "FROM o_inventory WHERE quantity_remaining < 10"
_ops("orders_per_minute", f"""SELECT {_round2(f'''COUNT(*) / GREATEST(
    date_sub('minute', MIN({_T}), MAX({_T})), 1)''')} AS orders_per_minute FROM o_orders""",
    "orders")
_ops("total_orders", "SELECT COUNT(*) AS total_orders FROM o_orders", "orders")
_ops("latest_event", f"SELECT MAX({_T}) AS latest_event_time FROM o_orders", "orders")
_ops("streaming_lag", f"""SELECT {_round2(f'''(epoch({_NOW}) -
    floor(epoch(MAX({_T})))) / 60''')} AS lag_minutes FROM o_orders""", "orders")
_ops("low_stock_alerts", f"SELECT COUNT(*) AS low_stock_alerts {_LOW}", "inventory")
_ops("orders_per_minute_trend", f"""SELECT {_MINUTE} AS minute_bucket,
    COUNT(*) AS order_count FROM o_orders GROUP BY 1""", "orders")
for _ops_name, _key, _as in (("events_per_minute", _MINUTE, "minute_bucket"),
                             ("store_distribution", "store_id", "store_id")):
    _ops(_ops_name, f"""SELECT {_key} AS {_as}, 'Orders' AS event_type,
        COUNT(*) AS event_count FROM o_orders GROUP BY 1 UNION ALL
        SELECT {_key}, 'Inventory', COUNT(*) FROM o_inventory GROUP BY 1""",
        "orders", "inventory")
for _key in ("store", "product"):
    _ops(f"low_stock_by_{_key}", f"""SELECT {_key}_id, COUNT(*) AS low_stock_count {_LOW}
        GROUP BY 1 ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 20""", "inventory")
_ops("stock_level_distribution", f"""SELECT {_BAND} AS stock_bucket, COUNT(*) AS count
    FROM o_inventory GROUP BY 1""", "inventory")
_ops("latency_trend", f"""SELECT {_MINUTE} AS minute_bucket, {_round2(f'''
    AVG(floor(epoch(processing_timestamp)) - floor(epoch(event_timestamp)))''')}
    AS avg_delay_seconds FROM o_orders GROUP BY 1""", "orders")
_ops("duplicate_orders", f"""SELECT {_n('SUM(n - 1)')} AS duplicate_count FROM (
    SELECT order_id, COUNT(*) AS n FROM o_orders GROUP BY order_id HAVING COUNT(*) > 1)""",
    "orders")
_ops("null_critical_fields", f"""SELECT {_n('''SUM(CAST(order_id IS NULL AS INT)
    + CAST(product_id IS NULL AS INT) + CAST(store_id IS NULL AS INT))''')} AS null_count
    FROM o_orders""", "orders")
_ops("recent_orders", f"""SELECT order_id, product_id, store_id, quantity, order_channel, {_T}
    FROM o_orders ORDER BY {_T} DESC, order_id NULLS FIRST LIMIT 50""", "orders")
_ops("recent_inventory", f"""SELECT inventory_id, product_id, store_id, quantity_remaining,
    stock_status, {_T} FROM o_inventory ORDER BY {_T} DESC, inventory_id LIMIT 50""",
    "inventory")


# -- checks ------------------------------------------------------------------------

def _fk(fact: str, parent: str, key: str, rows: Answer, keys: Answer, left: str,
        right: str) -> None:
    add(f"fk_orphans_{fact}_{parent}",
        lambda lake: checks.orphan_keys(rows(lake), keys(lake), key),
        f"""SELECT {key}, COUNT(*) AS n_rows FROM {left} f
            WHERE NOT EXISTS (SELECT 1 FROM {right} p WHERE p.{key} = f.{key})
            GROUP BY {key}""")


for _parent, _key in (("customer", "customer_id"), ("product", "product_id"),
                      ("store", "store_id")):
    _fk("sales", _parent, _key, lambda lake: lake.sales,
        lambda lake, p=_parent: getattr(lake, f"dim_{p}"), "g_sales", f"d_{_parent}")
for _parent, _key in (("product", "product_id"), ("store", "store_id")):
    _fk("returns", _parent, _key, lambda lake: lake.returned,
        lambda lake, p=_parent: getattr(lake, f"dim_{p}"), "g_returns", f"d_{_parent}")
add("fk_orphans_stores_region",
    lambda lake: checks.orphan_keys(lake.latest("stores"), lake.silver_regions, "region_id"),
    """SELECT region_id, COUNT(*) AS n_rows FROM l_stores f WHERE NOT EXISTS
       (SELECT 1 FROM s_regions p WHERE p.region_id = f.region_id) GROUP BY region_id""")
add("fk_orphans_orders_customer",
    lambda lake: checks.orphan_keys(
        lake.valid("orders").withColumn("customer_id", F.col("customer_id").cast("string")),
        lake.dim_customer, "customer_id"),
    """SELECT CAST(customer_id AS VARCHAR) AS customer_id, COUNT(*) AS n_rows
       FROM v_orders f WHERE NOT EXISTS (SELECT 1 FROM d_customer p
       WHERE p.customer_id = CAST(f.customer_id AS VARCHAR)) GROUP BY 1""")
add("fk_orphans_inventory_product",
    lambda lake: checks.orphan_keys(
        lake.valid("inventory").withColumn("product_id", F.col("product_id").cast("string")),
        lake.dim_product, "product_id"),
    """SELECT CAST(product_id AS VARCHAR) AS product_id, COUNT(*) AS n_rows
       FROM v_inventory f WHERE NOT EXISTS (SELECT 1 FROM d_product p
       WHERE p.product_id = CAST(f.product_id AS VARCHAR)) GROUP BY 1""")
add("fk_orphan_rows_transactions_store",
    lambda lake: plain(checks.orphan_rows(
        lake.silver_transactions.withColumn("store_id", F.col("store_id").try_cast("int")),
        lake.dim_store, "store_id").drop("l_orderkey", "l_linenumber")),
    """SELECT * REPLACE (CAST(store_id AS INT) AS store_id) FROM s_transactions f
       WHERE NOT EXISTS (SELECT 1 FROM d_store p WHERE p.store_id = CAST(f.store_id AS INT))""")

for _key, _parent in (("product_id", "product"), ("store_id", "store"),
                      ("customer_id", "customer")):
    add(f"missing_dim_keys_{_parent}",
        lambda lake, k=_key, p=_parent: checks.missing_keys(
            lake.sales, getattr(lake, f"dim_{p}"), [k]),
        f"SELECT {_key} FROM g_sales EXCEPT SELECT {_key} FROM d_{_parent}")
add("unused_products",
    lambda lake: checks.missing_keys(
        lake.dim_product, lake.sales.where("quantity = 50"), ["product_id"]),
    """SELECT product_id FROM d_product EXCEPT
       SELECT product_id FROM g_sales WHERE quantity = 50""")
add("unused_customers",
    lambda lake: checks.missing_keys(
        lake.dim_customer, lake.sales.where("quantity = 50"), ["customer_id"]),
    """SELECT customer_id FROM d_customer EXCEPT
       SELECT customer_id FROM g_sales WHERE quantity = 50""")
add("key_coverage",
    lambda lake: checks.missing_keys(
        lake.transactions, lake.valid("transactions"),
        ["product_id", "customer_id", "store_id"]),
    """SELECT product_id, customer_id, store_id FROM f_transactions EXCEPT
       SELECT product_id, customer_id, store_id FROM v_transactions""")
add("unique_key_check",
    lambda lake: checks.unique_key(lake.silver_orders, ["order_id"]),
    """SELECT COUNT(*) AS n_rows, COUNT(DISTINCT order_id) + MAX(CAST(order_id IS NULL AS INT))
       AS n_keys, COUNT(*) = COUNT(DISTINCT order_id) + MAX(CAST(order_id IS NULL AS INT))
       AS is_unique FROM s_orders""")
add("fact_grain",
    lambda lake: checks.duplicate_groups(
        lake.sales, ["product_id", "customer_id", "store_id", "transaction_date"]),
    """SELECT product_id, customer_id, store_id, transaction_date, COUNT(*) AS n_rows
       FROM g_sales GROUP BY ALL HAVING COUNT(*) > 1""")
add("bronze_duplicate_ratio",
    lambda lake: checks.duplicate_ratio(lake.transactions, silver.KEYS["transactions"]),
    f"""SELECT {_n('SUM(n)')} AS n_rows, COUNT(*) FILTER (WHERE n > 1) AS duplicate_groups,
        COUNT(*) FILTER (WHERE n > 1) <= SUM(n) * 0.1 AS within_limit FROM (
        SELECT COUNT(*) AS n FROM f_transactions
        GROUP BY product_id, customer_id, store_id, transaction_date)""")
add("profile_checks",
    lambda lake: checks.profile(
        lake.silver_orders, "order_id", ["order_id", "product_id", "store_id"], ["quantity"]),
    """SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE order_id IS NULL) AS null_order_id,
       COUNT(*) FILTER (WHERE product_id IS NULL) AS null_product_id,
       COUNT(*) FILTER (WHERE store_id IS NULL) AS null_store_id,
       COUNT(*) FILTER (WHERE quantity <= 0) AS not_positive_quantity,
       COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT order_id FROM s_orders))
       AS surplus_keys FROM s_orders""")
add("layer_reconciliation",
    lambda lake: checks.count_at_most(lake.transactions, lake.silver_transactions),
    """SELECT l AS lower_rows, u AS upper_rows, u <= l AS reconciles FROM
       (SELECT (SELECT COUNT(*) FROM f_transactions) AS l,
               (SELECT COUNT(*) FROM s_transactions) AS u)""")
add("split_completeness",
    lambda lake: checks.split_is_complete(
        lake.silver_transactions, lake.valid("transactions"),
        lake.quarantine("transactions")),
    """SELECT r AS raw_rows, v AS valid_rows, q AS quarantined_rows, r = v + q AS complete FROM
       (SELECT (SELECT COUNT(*) FROM s_transactions) AS r,
               (SELECT COUNT(*) FROM v_transactions) AS v,
               (SELECT COUNT(*) FROM q_transactions) AS q)""")
add("sum_reconciliation",
    lambda lake: checks.sums_agree(
        lake.sales, gold.agg_daily_sales(lake.sales, lake.dim_store),
        exact_sum("total_revenue")),
    f"""SELECT l AS lower_sum, u AS upper_sum, abs(l - u) <= 1 AS reconciles FROM
       (SELECT (SELECT {_total('total_revenue')} FROM g_sales) AS l,
               (SELECT {_total('total_revenue')} FROM a_daily) AS u)""")
add("source_quantity_sum",
    lambda lake: checks.sums_agree(
        lake.transactions, lake.silver_transactions,
        F.sum(F.col("quantity").try_cast("int")).cast("double"), 1.0, 0.01),
    """SELECT l AS lower_sum, u AS upper_sum,
       abs(l - u) <= greatest(1.0, abs(l) * 0.01) AS reconciles FROM
       (SELECT (SELECT CAST(SUM(TRY_CAST(quantity AS INT)) AS DOUBLE) FROM f_transactions) AS l,
               (SELECT CAST(SUM(quantity) AS DOUBLE) FROM s_transactions) AS u)""")
add("source_bronze_count",
    lambda lake: checks.count_at_least(lake.table("lineitem"), lake.transactions),
    """SELECT s AS source_rows, l AS landed_rows, l >= s AS reconciles FROM
       (SELECT (SELECT COUNT(*) FROM lineitem) AS s,
               (SELECT COUNT(*) FROM f_transactions) AS l)""")
add("schema_drift",
    lambda lake: checks.schema_drift(
        lake.silver_transactions.select("product_id", "customer_id", "store_id", "quantity",
                                        "transaction_date", "record_status"),
        {"product_id": "string", "customer_id": "string", "store_id": "int",
         "quantity": "int", "transaction_date": "date", "channel": "string"}),
    """SELECT 'product_id' AS column_name, 'string' AS expected_type,
       'string' AS actual_type, 'ok' AS status, COUNT(product_id) AS n_values
       FROM s_transactions
       UNION ALL SELECT 'customer_id', 'string', 'string', 'ok', COUNT(customer_id)
       FROM s_transactions
       UNION ALL SELECT 'store_id', 'int', 'string', 'retyped', COUNT(store_id)
       FROM s_transactions
       UNION ALL SELECT 'quantity', 'int', 'int', 'ok', COUNT(quantity) FROM s_transactions
       UNION ALL SELECT 'transaction_date', 'date', 'date', 'ok', COUNT(transaction_date)
       FROM s_transactions
       UNION ALL SELECT 'channel', 'string', NULL, 'missing', 0
       UNION ALL SELECT 'record_status', NULL, 'string', 'added', COUNT(record_status)
       FROM s_transactions""")
add("source_tag_check",
    lambda lake: checks.unexpected_tags(lake.products, "_source_system", lineage.KNOWN_TAGS),
    "SELECT 'fivetran' AS _source_system, COUNT(*) AS n_rows FROM c_products")
add("measure_recheck",
    lambda lake: checks.wrong_sales_measures(
        lake.sales,
        lake.dim_product.withColumn(
            "product_cost", F.when(F.col("low_fat") == 1, F.col("product_cost") + 5)
            .otherwise(F.col("product_cost")))),
    """SELECT g_sales.*, 'cost' AS wrong_measures FROM g_sales
       JOIN d_product USING (product_id) WHERE low_fat = 1 AND quantity <> 0""")
add("return_amount_recheck",
    lambda lake: checks.wrong_return_amounts(
        lake.returned.withColumn(
            "return_amount", F.when(F.col("return_quantity") == 5, F.lit(1.0))
            .otherwise(F.col("return_amount"))), lake.dim_product),
    """SELECT * REPLACE (1.0::DOUBLE AS return_amount) FROM g_returns
       WHERE return_quantity = 5""")
add("average_recheck",
    lambda lake: checks.wrong_averages(
        gold.agg_daily_sales(lake.sales, lake.dim_store).withColumn(
            "avg_transaction_value", F.col("avg_transaction_value")
            + F.when(F.col("store_id") % 3 == 0, 1.0).otherwise(0.0))),
    """SELECT * REPLACE (avg_transaction_value + 1.0::DOUBLE AS avg_transaction_value)
       FROM a_daily WHERE store_id % 3 = 0 AND total_revenue IS NOT NULL""")
add("dim_join_gaps",
    lambda lake: checks.join_gaps(
        lake.silver_returns, lake.dim_product.withColumn(
            "product_name", F.when(F.col("low_fat") == 0, F.col("product_name"))),
        "product_id", "product_name"),
    """SELECT product_id, COUNT(*) AS n_rows FROM s_returns LEFT JOIN d_product
       USING (product_id) WHERE product_name IS NULL OR low_fat = 1 GROUP BY product_id""")
add("rate_ranges",
    lambda lake: checks.out_of_range(
        gold.agg_return_kpi(lake.sales, lake.returned), "return_rate", 0, 0.05),
    "SELECT * FROM a_returns WHERE return_rate < 0 OR return_rate > 0.05")


# -- run log -----------------------------------------------------------------------

def _row_counts(lake: Lake) -> DataFrame:
    judged = quality.judge(lake.silver_transactions, quality.TRANSACTION_RULES)
    counts = audit.split_counts(lake.transactions, judged)
    return audit.row_count_rows(counts, _run(), "silver", "transactions")


def _layer_counts(lake: Lake) -> DataFrame:
    counts = audit.table_counts(input=lake.order_records, output=lake.silver_orders)
    return audit.row_count_rows(counts, _run(), "silver", "orders").select(
        "message", "row_count_input", "row_count_output", "row_count_quarantined")


def _dq(lake: Lake) -> DataFrame:
    return audit.dq_rows(lake.silver_transactions, quality.TRANSACTION_RULES, _run(),
                         "silver", "transactions")


def _metrics(lake: Lake) -> DataFrame:
    per_channel = lake.silver_orders.groupBy("order_channel").agg(
        F.count(F.lit(1)).alias("value"))
    named = per_channel.select(
        F.concat(F.lit("orders_"), F.coalesce("order_channel", F.lit("unknown")))
        .alias("metric"), "value")
    return audit.metric_rows(named, _run(), "silver", "orders")


_LOG = ["pipeline_name", "pipeline_run_id", "layer", "table_name", "event_type", "log_level",
        "message", "row_count_input", "row_count_output", "row_count_quarantined",
        "extra_metrics", "env", "catalog"]
_RUN_SQL = """'retail' AS pipeline_name, 'run-1' AS pipeline_run_id, 'test' AS env,
    'lake' AS catalog, 'silver' AS layer"""
_NO_COUNTS = """CAST(NULL AS BIGINT) AS row_count_input, CAST(NULL AS BIGINT)
    AS row_count_output, CAST(NULL AS BIGINT) AS row_count_quarantined"""
_ROW_COUNT_SQL = f"""SELECT {_RUN_SQL}, 'transactions' AS table_name,
    'ROW_COUNT' AS event_type, 'INFO' AS log_level,
    'silver.transactions rows: ' || i || ' input, ' || o || ' output, ' || q ||
    ' quarantined' AS message, i AS row_count_input, o AS row_count_output,
    q AS row_count_quarantined, CAST(NULL AS VARCHAR) AS extra_metrics FROM
    (SELECT (SELECT COUNT(*) FROM f_transactions) AS i,
            (SELECT COUNT(*) FROM v_transactions) AS o,
            (SELECT COUNT(*) FROM q_transactions) AS q)"""
_DQ_SQL = f"""SELECT {_RUN_SQL}, 'transactions' AS table_name, 'DQ_CHECK' AS event_type,
    CASE WHEN failed = 0 THEN 'INFO' ELSE 'WARNING' END AS log_level,
    'silver.transactions rule ' || rule || ': ' || failed || ' in breach' AS message, {_NO_COUNTS},
    '{{"check":"' || rule || '","passed":' || (failed = 0) || ',"details":"' || failed ||
    ' in breach"}}' AS extra_metrics FROM ({_counts_sql("s_transactions", _T_RULES)})"""
add("row_count_audit", lambda lake: _row_counts(lake).select(*_LOG), _ROW_COUNT_SQL)
add("row_count_layers", _layer_counts,
    """SELECT 'silver.orders rows: ' || i || ' input, ' || o || ' output' AS message,
       i AS row_count_input, o AS row_count_output,
       CAST(NULL AS BIGINT) AS row_count_quarantined FROM
       (SELECT (SELECT COUNT(*) FROM f_orders) AS i, (SELECT COUNT(*) FROM s_orders) AS o)""")
add("dq_summary", lambda lake: _dq(lake).select(*_LOG), _DQ_SQL)
add("metric_log", lambda lake: _metrics(lake).select(*_LOG),
    f"""SELECT {_RUN_SQL}, 'orders' AS table_name, 'METRIC' AS event_type,
        'INFO' AS log_level, 'silver.orders ' || m || ' is ' || n AS message, {_NO_COUNTS},
        '{{"' || m || '":' || n || '}}' AS extra_metrics FROM (
        SELECT 'orders_' || coalesce(order_channel, 'unknown') AS m, COUNT(*) AS n
        FROM s_orders GROUP BY order_channel)""")
add("pipeline_log_schema",
    lambda lake: plain(_row_counts(lake).drop("log_id")),
    f"""SELECT *, {_CLOCK} AS "timestamp", CAST(NULL AS DOUBLE) AS duration_seconds,
        CAST(NULL AS VARCHAR) AS error_type, CAST(NULL AS VARCHAR) AS error_message,
        CAST(NULL AS VARCHAR) AS error_traceback FROM ({_ROW_COUNT_SQL})""")
add("log_summary",
    lambda lake: audit.summary(_row_counts(lake).unionByName(_dq(lake))),
    f"""SELECT pipeline_run_id, event_type, log_level, COUNT(*) AS n_events,
        {_n("SUM(row_count_output)")} AS rows_out,
        {_n("SUM(row_count_quarantined)")} AS rows_quarantined
        FROM (SELECT * FROM ({_ROW_COUNT_SQL}) UNION ALL BY NAME SELECT * FROM ({_DQ_SQL}))
        GROUP BY 1, 2, 3""")
add("pipeline_log_append",
    lambda lake: logged(lake, _row_counts(lake), _dq(lake)).select(*_LOG),
    f"SELECT * FROM ({_ROW_COUNT_SQL}) UNION ALL BY NAME SELECT * FROM ({_DQ_SQL})")


# -- streams against their batch equals --------------------------------------------

add("stream_dedup_orders", streamed_orders, "SELECT * FROM s_orders")
add("stream_dedup_inventory", streamed_inventory,
    """SELECT * EXCLUDE ("timestamp", processing_time) FROM s_inventory""")
for _table in ("transactions", "returns"):
    add(f"stream_dedup_{_table}", lambda lake, t=_table: streamed_facts(lake, t),
        f"SELECT * FROM s_{_table}")
add("stream_row_counts", streamed_row_counts,
    """SELECT 'silver' AS layer, 'transactions' AS table_name, 'INFO' AS log_level, CAST(5 AS BIGINT) AS n_batches,
       CAST(5 AS BIGINT) AS n_events, 2 * COUNT(*) AS rows_in, 2 * COUNT(*) AS rows_out FROM s_transactions""")
add("stream_expectations", streamed_expectations,
    f"""SELECT 'transactions' AS table_name, rule, 2 * passed AS passed, 2 * failed AS failed
        FROM ({_counts_sql("s_transactions", quality.WARNINGS["transactions"])})""")
add("stream_late_rows", late_orders,
    """SELECT order_id, "timestamp" FROM s_orders UNION ALL
       SELECT 'LATE-' || event_id, ts FROM events
       WHERE ts > (SELECT MAX("timestamp") FROM s_orders) - INTERVAL 10 MINUTE""")
add("stream_quarantine", streamed_split,
    f"""SELECT *, {_verdict(_RULES["orders"])} AS is_valid,
        CASE WHEN {_verdict(_RULES["orders"])} THEN 'valid' END AS record_status,
        CASE WHEN NOT ({_verdict(_RULES["orders"])}) THEN {_CLOCK} END AS _quarantine_timestamp,
        CASE WHEN NOT ({_verdict(_RULES["orders"])}) THEN {_reason(_RULES["orders"])} END
        AS _quarantine_reason FROM s_orders""")
add("stream_scd2",
    lambda lake: streamed_history(lake, lake.changes, lake.spec["changes"]),
    "SELECT * FROM h_changes")
add("stream_scd2_same_batch",
    lambda lake: streamed_history(lake, lake.same_batch("customers"),
                                  lake.placed_spec("customers")), "SELECT * FROM k_customers")
