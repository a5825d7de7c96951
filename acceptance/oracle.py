"""The same results as plain SQL for an independent engine."""

from __future__ import annotations

import re

from acceptance.feeds import AS_OF, CLOCK, LOOKBACK_DAYS


def _us(name: str) -> str:
    return f"strftime({name}, '%-m/%-d/%Y')"


def _date(name: str) -> str:
    return f"CAST(try_strptime({name}, '%m/%d/%Y') AS DATE)"


def _title(name: str) -> str:
    words = f"list_transform(string_split({name}, ' '), lambda z: upper(z[1]) || lower(z[2:]))"
    return f"array_to_string({words}, ' ')"


def _round2(value: str) -> str:
    """Half-up rounding of a DOUBLE by its shortest decimal form."""
    return f"CAST(ROUND(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 20)), 2) AS DOUBLE)"


def _n(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


def _money(value: str) -> str:
    return f"CAST({value} AS DECIMAL(20, 6))"


def _total(value: str) -> str:
    return f"CAST(SUM({_money(value)}) AS DOUBLE)"


_CLOCK = f"TIMESTAMP '{CLOCK}'"
_NOW = f"TIMESTAMP '{AS_OF}'"
_STAMPS = f"{_CLOCK} AS pipeline_run_id, {_CLOCK} AS processing_timestamp"


def _first(source: str, keys: str, order: str) -> str:
    return f"""SELECT * FROM {source}
        QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"""


def _history(source: str, key: str, seq: str, attrs: list[str], tracked: list[str],
             ignore_nulls: bool = True) -> str:
    """Versions by running fill, change flag, running count and one row per count."""
    over = f"(PARTITION BY {key} ORDER BY {seq} ROWS UNBOUNDED PRECEDING)"
    filled = [f"last_value({a} IGNORE NULLS) OVER {over} AS {a}" if ignore_nulls else a
              for a in attrs]
    moved = " OR ".join(f"{t} IS DISTINCT FROM lag({t}) OVER w" for t in tracked)
    last = ", ".join(f"arg_max_null({a}, {seq}) AS {a}" for a in attrs)
    return f"""SELECT *, lead("__START_AT") OVER (PARTITION BY {key} ORDER BY "__START_AT")
            AS "__END_AT" FROM (
        SELECT {key}, {last}, min({seq}) AS "__START_AT" FROM (
            SELECT *, sum(opens) OVER (PARTITION BY {key} ORDER BY {seq}) AS version FROM (
                SELECT *, CASE WHEN row_number() OVER w = 1 OR {moved} THEN 1 ELSE 0 END
                    AS opens
                FROM (SELECT {key}, {seq}, {", ".join(filled)} FROM {source})
                WINDOW w AS (PARTITION BY {key} ORDER BY {seq})))
        GROUP BY {key}, version)"""


def _latest(source: str, key: str, seq: str, attrs: list[str], ignore_nulls: bool = True) -> str:
    last = ", ".join(
        f"arg_max({a}, {seq}) FILTER (WHERE {a} IS NOT NULL) AS {a}" if ignore_nulls
        else f"arg_max_null({a}, {seq}) AS {a}" for a in attrs)
    return f"SELECT {key}, {last} FROM {source} GROUP BY {key}"


def _same_batch(table: str, key: str, attrs: list[str], tracked: list[str],
                ignore_nulls: bool) -> dict[str, str]:
    """History of a feed in which two revisions share a landing time: the later one's values,
    or the earlier one's where it has none."""
    last = ", ".join(
        f"arg_max({a}, rev) FILTER (WHERE {a} IS NOT NULL) AS {a}" if ignore_nulls
        else f"arg_max_null({a}, rev) AS {a}" for a in attrs)
    return {
        f"b_{table}": f"""SELECT {key}, landed AS {_SEQ}, {last} FROM (
            SELECT * EXCLUDE ({_SEQ}), day({_SEQ}) - 1 AS rev,
                TIMESTAMP '2024-01-01' + (day({_SEQ}) // 2) * INTERVAL 1 DAY AS landed
            FROM c_{table}) GROUP BY {key}, landed""",
        f"k_{table}": _history(f"b_{table}", key, _SEQ, attrs, tracked, ignore_nulls),
    }


_SEQ = "ingestion_timestamp"
_PRODUCT = ["product_brand", "product_name", "product_sku", "product_retail_price",
            "product_cost", "product_weight", "recyclable", "low_fat"]
_PRODUCT_TRACKED = ["product_name", "product_brand", "product_retail_price", "product_cost",
                    "product_weight", "recyclable", "low_fat"]
_CUSTOMER = ["customer_acct_num", "first_name", "last_name", "customer_address",
             "customer_city", "customer_state_province", "customer_postal_code",
             "customer_country", "birthdate", "marital_status", "yearly_income", "gender",
             "total_children", "num_children_at_home", "education", "acct_open_date",
             "member_card", "occupation", "homeowner", "customer_name"]
_CUSTOMER_TRACKED = ["customer_name", "customer_city", "customer_state_province",
                     "customer_country", "marital_status", "yearly_income", "gender",
                     "education", "occupation", "homeowner"]
_STORE = ["region_id", "store_name", "store_city", "store_state", "first_opened_date",
          "last_remodel_date"]


def _verdict(rules: dict[str, str]) -> str:
    return " AND ".join(f"coalesce({p}, false)" for p in rules.values())


def _reason(rules: dict[str, str]) -> str:
    names = ", ".join(
        f"CASE WHEN NOT coalesce({p}, false) THEN '{n}' END" for n, p in rules.items())
    return f"concat_ws(', ', {names})"


_NOT_NULL = {"valid_product": "product_id IS NOT NULL",
             "valid_customer": "customer_id IS NOT NULL",
             "valid_store": "store_id IS NOT NULL", "positive_qty": "quantity > 0"}
_RULES = {
    "transactions": {**_NOT_NULL, "valid_date": "transaction_date IS NOT NULL"},
    "orders": {"valid_order_id": "order_id IS NOT NULL", **_NOT_NULL},
    "inventory": {"valid_product": "product_id IS NOT NULL",
                  "valid_store": "store_id IS NOT NULL",
                  "valid_stock": "quantity_remaining >= 0"},
}


def _split_tables(table: str) -> dict[str, str]:
    rules = _RULES[table]
    return {
        f"v_{table}": f"""SELECT * REPLACE ('valid' AS record_status) FROM s_{table}
            WHERE {_verdict(rules)}""" if table != "orders" else
        f"SELECT *, 'valid' AS record_status FROM s_{table} WHERE {_verdict(rules)}",
        f"q_{table}": f"""SELECT *, {_CLOCK} AS _quarantine_timestamp,
            {_reason(rules)} AS _quarantine_reason FROM s_{table}
            WHERE NOT ({_verdict(rules)})""",
    }


_INCOME = """CASE WHEN c_acctbal + 2000 * rev < 2000 THEN '$10K - $30K'
    WHEN c_acctbal + 2000 * rev < 8000 THEN '$30K - $50K' ELSE '$50K - $70K' END"""

CTES: dict[str, str] = {
    # feeds
    "f_transactions": f"""SELECT l_orderkey, l_linenumber,
        CASE WHEN (l_orderkey * 7 + l_linenumber) % 101 = 0 THEN NULL
             WHEN l_orderkey % 127 = 0 THEN 'X' || l_partkey
             ELSE CAST(l_partkey AS VARCHAR) END AS product_id,
        CASE WHEN (l_orderkey + l_partkey) % 103 = 0 THEN NULL
             WHEN (l_orderkey + l_suppkey) % 131 = 0 THEN 'X' || o_custkey
             ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
        CASE WHEN (l_orderkey * 3 + l_suppkey) % 107 = 0 THEN NULL
             WHEN (l_orderkey * 5 + l_partkey) % 137 = 0
             THEN CAST(l_suppkey + 1000000 AS VARCHAR)
             ELSE CAST(l_suppkey AS VARCHAR) END AS store_id,
        CASE WHEN (l_partkey + l_suppkey) % 109 = 0 THEN 'not-a-date'
             ELSE {_us('o_orderdate')} END AS transaction_date,
        CASE WHEN (l_orderkey + l_linenumber) % 113 = 0 THEN NULL
             WHEN (l_orderkey + l_linenumber) % 97 = 0
             THEN CAST(-CAST(l_quantity AS INT) AS VARCHAR)
             ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS quantity,
        unnest(range(CASE WHEN l_orderkey % 50 = 0 THEN 2 ELSE 1 END)) AS delivery
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "f_returns": f"""SELECT l_orderkey, CAST(l_partkey AS VARCHAR) AS product_id,
        CAST(l_suppkey AS VARCHAR) AS store_id, {_us('l_shipdate')} AS return_date,
        CASE WHEN l_orderkey % 89 = 0 THEN '0'
             ELSE CAST(CAST(l_quantity AS INT) % 5 + 1 AS VARCHAR) END AS quantity
        FROM lineitem WHERE l_returnflag = 'R'""",
    "f_stores": """SELECT rev, CAST(s_suppkey AS VARCHAR) AS store_id,
        CAST((s_nationkey + rev // 3) % 25 AS VARCHAR) AS region_id,
        '  ' || s_name || CASE WHEN rev > 3 THEN ' II' ELSE '' END || ' ' AS store_name,
        'city ' || lower(n_name) || ' ' || rev AS store_city, lower(n_name) AS store_state,
        (s_nationkey % 12 + 1) || '/' || (s_suppkey % 28 + 1) || '/2001' AS first_opened_date,
        CASE WHEN s_suppkey % 7 <> 0 THEN '6/' || (s_suppkey % 28 + 1) || '/2010' END
            AS last_remodel_date
        FROM (SELECT *, unnest(range(1, 2 + s_suppkey % 4)) AS rev FROM supplier)
        JOIN nation ON s_nationkey = n_nationkey""",
    "f_regions": """SELECT CAST(n_nationkey AS VARCHAR) AS region_id,
        lower(r_name) AS sales_region, lower(n_name) AS sales_district,
        unnest(range(1, CASE WHEN n_nationkey % 5 = 0 THEN 3 ELSE 2 END)) AS rev
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "f_calendar": f"""SELECT DISTINCT CASE WHEN o_orderkey % 500 = 0 THEN 'bad'
        ELSE {_us('o_orderdate')} END AS date FROM orders""",
    "c_products": f"""SELECT CAST(p_partkey AS VARCHAR) AS product_id,
        CASE WHEN rev = 1 OR (p_partkey + rev) % 5 <> 0 THEN p_brand END AS product_brand,
        p_name AS product_name, p_partkey * 7 + rev AS product_sku,
        round(p_retailprice + CASE WHEN (p_partkey + rev) % 4 = 0 THEN 10.0::DOUBLE ELSE 0 END
            + p_partkey % 8 * 0.000123::DOUBLE, 6) AS product_retail_price,
        p_retailprice - 250.0::DOUBLE AS product_cost,
        CAST(p_size AS DOUBLE) AS product_weight, CAST(p_size % 2 AS INT) AS recyclable,
        CAST(p_partkey % 2 AS INT) AS low_fat,
        TIMESTAMP '2024-01-01' + rev * INTERVAL 1 DAY AS {_SEQ}
        FROM (SELECT *, unnest(range(1, 2 + p_partkey % 3)) AS rev FROM part)""",
    "c_customers": f"""SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
        c_custkey * 1000 AS customer_acct_num, c_mktsegment AS first_name,
        CASE WHEN c_custkey % 11 <> 0 THEN c_name END AS last_name,
        CAST(NULL AS VARCHAR) AS customer_address, n_name AS customer_city,
        n_name AS customer_state_province, CAST(NULL AS INT) AS customer_postal_code,
        r_name AS customer_country,
        make_date(1980, CAST(c_custkey % 12 + 1 AS INT), 15) AS birthdate,
        CASE WHEN (c_custkey + rev // 2) % 2 = 0 THEN 'M' ELSE 'S' END AS marital_status,
        {_INCOME} AS yearly_income,
        CASE WHEN c_custkey % 3 = 0 THEN 'F' ELSE 'M' END AS gender,
        CAST((c_custkey + rev) % 5 AS INT) AS total_children,
        CAST(NULL AS INT) AS num_children_at_home, CAST(NULL AS VARCHAR) AS education,
        make_date(2005, 6, CAST(c_custkey % 28 + 1 AS INT)) AS acct_open_date,
        CAST(NULL AS VARCHAR) AS member_card,
        CASE WHEN (c_custkey + rev) % 6 <> 0 THEN c_mktsegment END AS occupation,
        CASE WHEN c_custkey % 4 = 0 THEN 'N' ELSE 'Y' END AS homeowner,
        trim(concat_ws(' ', c_mktsegment, CASE WHEN c_custkey % 11 <> 0 THEN c_name END))
            AS customer_name,
        TIMESTAMP '2024-01-01' + rev * INTERVAL 1 DAY AS {_SEQ}
        FROM (SELECT *, unnest(range(1, 2 + c_custkey % 4)) AS rev FROM customer)
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "c_stores": f"""SELECT CAST(store_id AS INT) AS store_id,
        CAST(region_id AS INT) AS region_id, trim(store_name) AS store_name,
        {_title('store_city')} AS store_city, upper(store_state) AS store_state,
        {_date('first_opened_date')} AS first_opened_date,
        {_date('last_remodel_date')} AS last_remodel_date,
        TIMESTAMP '2024-01-01' + rev * INTERVAL 1 DAY AS {_SEQ} FROM f_stores""",
    "c_changes": """SELECT user_id, ts,
        CASE WHEN event_id % 7 <> 0 THEN event_type END AS event_type,
        CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM events""",
    "f_orders": f"""SELECT * EXCLUDE (ts, late, broken, event_id), event_id,
        ts + late * INTERVAL 1 MINUTE AS "timestamp" FROM (
        SELECT event_id, event_id % 199 = 0 AS broken, ts,
        CASE WHEN event_id % 83 <> 0 AND NOT broken THEN 'ORD-' || event_id END AS order_id,
        CASE WHEN NOT broken THEN CAST(event_id % 200 AS INT) END AS product_id,
        CASE WHEN NOT broken THEN CAST(user_id AS INT) END AS customer_id,
        CASE WHEN NOT broken THEN CAST(event_id % 10 AS INT) END AS store_id,
        CASE WHEN NOT broken THEN CAST(floor(value) AS INT) % 12 - 1 END AS quantity,
        CASE WHEN NOT broken THEN CAST(ts AS DATE) END AS order_date,
        CASE WHEN broken THEN NULL WHEN event_id % 2 = 0 THEN 'card' ELSE 'cash' END
            AS payment_type,
        CASE WHEN NOT broken THEN event_type END AS order_channel,
        unnest(list_concat([0], CASE WHEN event_id % 40 = 0 THEN [0] ELSE [] END,
            CASE WHEN event_id % 61 = 0 THEN [1] ELSE [] END)) AS late FROM events)""",
    "f_inventory": """SELECT 'INV-' || event_id AS inventory_id, ts AS event_timestamp,
        CAST(json_extract_string(props, '$.k') AS INT) AS product_id,
        CASE WHEN event_id % 71 <> 0 THEN CAST(event_id % 10 AS INT) END AS store_id,
        CAST(json_extract_string(props, '$.k') AS INT) % 3 AS quantity_added,
        CAST(floor(value) AS INT) - 5 AS quantity_remaining, event_id,
        ts + late * INTERVAL 1 MINUTE AS "timestamp"
        FROM (SELECT *, unnest(CASE WHEN event_id % 45 = 0 THEN [0, 1] ELSE [0] END) AS late
              FROM events)""",
    # cleaned tables
    "t_transactions": f"""SELECT l_orderkey, l_linenumber, product_id, customer_id, store_id,
        {_date('transaction_date')} AS transaction_date,
        TRY_CAST(quantity AS INT) AS quantity FROM f_transactions""",
    "s_transactions": f"""SELECT * EXCLUDE (l_orderkey, l_linenumber), {_STAMPS},
        'transactions' AS source_table,
        CASE WHEN quantity <= 0 THEN 'invalid' ELSE 'cleaned' END AS record_status FROM ({
        _first('t_transactions', 'product_id, customer_id, store_id, transaction_date',
               'l_orderkey, l_linenumber, quantity NULLS FIRST')})""",
    "s_returns": f"""SELECT * EXCLUDE (l_orderkey), {_STAMPS}, 'returns' AS source_table,
        CASE WHEN quantity <= 0 THEN 'invalid' ELSE 'cleaned' END AS record_status
        FROM (SELECT l_orderkey, product_id, store_id, {_date('return_date')} AS return_date,
                     CAST(quantity AS INT) AS quantity FROM f_returns
              QUALIFY row_number() OVER (PARTITION BY product_id, store_id,
                  {_date('return_date')} ORDER BY l_orderkey, CAST(quantity AS INT)) = 1)""",
    "s_stores": f"""SELECT * EXCLUDE ({_SEQ}), {_STAMPS}, 'stores' AS source_table,
        'cleaned' AS record_status FROM ({_first('c_stores', 'store_id', _SEQ)})""",
    "s_regions": f"""SELECT CAST(region_id AS INT) AS region_id,
        {_title('sales_region')} AS sales_region, {_title('sales_district')} AS sales_district,
        {_STAMPS}, 'regions' AS source_table, 'cleaned' AS record_status
        FROM ({_first('f_regions', 'region_id', 'rev')})""",
    "s_calendar": f"""SELECT {_date('date')} AS date, {_STAMPS}, 'calendar' AS source_table,
        'cleaned' AS record_status FROM f_calendar""",
    "s_orders": f"""SELECT * EXCLUDE (event_id), "timestamp" AS event_timestamp, {_STAMPS}
        FROM ({_first('f_orders', 'order_id, "timestamp"', 'event_id % 4, event_id')})""",
    "s_inventory": f"""SELECT * EXCLUDE (event_id), "timestamp" AS processing_time,
        CASE WHEN quantity_remaining = 0 THEN 'OUT_OF_STOCK'
             WHEN quantity_remaining < 20 THEN 'LOW_STOCK'
             WHEN quantity_remaining < 50 THEN 'MEDIUM' ELSE 'HEALTHY' END AS stock_status,
        coalesce(quantity_added > 0, false) AS is_restock, 'kafka' AS ingestion_source,
        'cleaned' AS record_status, {_STAMPS}
        FROM ({_first('f_inventory', 'inventory_id', '"timestamp", event_id % 4, event_id')})""",
    "s_customers": f"""SELECT *, 'fivetran' AS _source_system, {_STAMPS}
        FROM ({_first('c_customers', 'customer_id', _SEQ)})""",
    "s_products": f"""SELECT *, 'fivetran' AS _source_system, {_STAMPS}
        FROM ({_first('c_products', 'product_id', _SEQ)})""",
    **_split_tables("transactions"),
    **_split_tables("orders"),
    **_split_tables("inventory"),
    # history
    "h_products": _history("c_products", "product_id", _SEQ, _PRODUCT, _PRODUCT_TRACKED),
    "h_customers": _history("c_customers", "customer_id", _SEQ, _CUSTOMER, _CUSTOMER_TRACKED),
    "h_stores": _history("c_stores", "store_id", _SEQ, _STORE, ["store_name", "region_id"],
                         ignore_nulls=False),
    "h_changes": _history("c_changes", "user_id", "ts", ["event_type", "value"],
                          ["event_type"]),
    **{name: sql for table, key, attrs, tracked, nulls in (
        ("products", "product_id", _PRODUCT, _PRODUCT_TRACKED, True),
        ("customers", "customer_id", _CUSTOMER, _CUSTOMER_TRACKED, True),
        ("stores", "store_id", _STORE, ["store_name", "region_id"], False))
       for name, sql in _same_batch(table, key, attrs, tracked, nulls).items()},
    "l_products": _latest("c_products", "product_id", _SEQ, _PRODUCT),
    "l_customers": _latest("c_customers", "customer_id", _SEQ, _CUSTOMER),
    "l_stores": _latest("c_stores", "store_id", _SEQ, _STORE, ignore_nulls=False),
    # star schema
    "d_customer": """SELECT customer_id, customer_name, customer_city,
        customer_state_province, customer_country, gender, marital_status, yearly_income,
        education, occupation, homeowner FROM h_customers WHERE "__END_AT" IS NULL""",
    "d_product": """SELECT product_id, product_name, product_brand, product_retail_price,
        product_cost, product_weight, recyclable, low_fat
        FROM h_products WHERE "__END_AT" IS NULL""",
    "d_store": """SELECT store_id, store_name, store_city, store_state, region_id,
        sales_region, sales_district FROM h_stores
        LEFT JOIN (SELECT region_id, sales_region, sales_district FROM s_regions)
        USING (region_id) WHERE "__END_AT" IS NULL""",
    "g_union": """SELECT product_id, customer_id, CAST(store_id AS INT) AS store_id,
        transaction_date, quantity FROM v_transactions
        UNION ALL SELECT CAST(product_id AS VARCHAR), CAST(customer_id AS VARCHAR), store_id,
        order_date, quantity FROM v_orders""",
    "g_sales": f"""SELECT transaction_date, customer_id, product_id, store_id, quantity,
        CAST(quantity * {_money('product_retail_price')} AS DOUBLE) AS total_revenue,
        CAST(quantity * {_money('product_cost')} AS DOUBLE) AS total_cost,
        CAST(quantity * ({_money('product_retail_price')} - {_money('product_cost')})
             AS DOUBLE) AS total_profit
        FROM g_union LEFT JOIN d_product USING (product_id)""",
    "g_returns": f"""SELECT product_id, CAST(store_id AS INT) AS store_id, return_date,
        quantity AS return_quantity,
        CAST(quantity * {_money('product_retail_price')} AS DOUBLE) AS return_amount
        FROM s_returns LEFT JOIN d_product USING (product_id)""",
    "a_daily": f"""SELECT *, {_round2('total_revenue / total_transactions')}
            AS avg_transaction_value FROM (
        SELECT transaction_date, store_id, {_n('SUM(quantity)')} AS total_units,
        {_total('total_revenue')} AS total_revenue, {_total('total_cost')} AS total_cost,
        {_total('total_profit')} AS total_profit,
        COUNT(DISTINCT customer_id) AS unique_customers, COUNT(*) AS total_transactions
        FROM g_sales GROUP BY transaction_date, store_id)
        LEFT JOIN d_store USING (store_id)""",
    "a_monthly": f"""SELECT CAST(year(transaction_date) AS INT) AS year,
        CAST(month(transaction_date) AS INT) AS month, store_id, product_brand,
        {_n('SUM(quantity)')} AS total_units, {_total('total_revenue')} AS total_revenue,
        {_total('total_cost')} AS total_cost, {_total('total_profit')} AS total_profit,
        COUNT(DISTINCT customer_id) AS unique_customers, COUNT(*) AS total_transactions
        FROM g_sales LEFT JOIN (SELECT product_id, product_brand FROM d_product)
        USING (product_id) GROUP BY ALL""",
    "a_stores": f"""SELECT *, {_round2('total_units_returned / total_units_sold * 100')}
            AS return_rate FROM (
        SELECT store_id, {_n('SUM(quantity)')} AS total_units_sold,
        {_total('total_revenue')} AS total_revenue, {_total('total_profit')} AS total_profit
        FROM g_sales GROUP BY store_id)
        LEFT JOIN (SELECT store_id, {_n('SUM(return_quantity)')} AS total_units_returned
                   FROM g_returns GROUP BY store_id) USING (store_id)""",
    "a_returns": f"""SELECT *, returned_qty / sold_qty AS return_rate FROM (
        SELECT product_id, {_n('SUM(quantity)')} AS sold_qty FROM g_sales GROUP BY product_id)
        LEFT JOIN (SELECT product_id, {_n('SUM(return_quantity)')} AS returned_qty
                   FROM g_returns GROUP BY product_id) USING (product_id)""",
    # operations windows
    "o_orders": f"""SELECT * FROM s_orders
        WHERE "timestamp" >= {_NOW} - INTERVAL {LOOKBACK_DAYS} DAY AND "timestamp" <= {_NOW}""",
    "o_inventory": f"""SELECT * FROM s_inventory
        WHERE "timestamp" >= {_NOW} - INTERVAL {LOOKBACK_DAYS} DAY AND "timestamp" <= {_NOW}""",
}


def query(final: str) -> str:
    """The final SELECT behind the named parts it needs, directly or not."""
    needed: set[str] = set()
    todo = [final]
    while todo:
        for word in set(re.findall(r"\b[a-z]_[a-z]+\b", todo.pop())) & CTES.keys() - needed:
            needed.add(word)
            todo.append(CTES[word])
    parts = ",\n".join(f"{name} AS ({CTES[name]})" for name in CTES if name in needed)
    return f"WITH {parts}\n{final}" if parts else final
