import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from larder.plans import ops, secure

NOW = dt.datetime(2024, 1, 15, 12)


@pytest.fixture(scope="module")
def gold(spark):
    return {
        "fact_sales": spark.createDataFrame(
            [(None, "c", "p", s, 1, 9.0, 4.0, 5.0) for s in (1, 2, 3)],
            "transaction_date DATE, customer_id STRING, product_id STRING, store_id INT, "
            "quantity INT, total_revenue DOUBLE, total_cost DOUBLE, total_profit DOUBLE"),
        "fact_returns": spark.createDataFrame(
            [("p", s, None, 1, 2.0) for s in (1, 2, 3)],
            "product_id STRING, store_id INT, return_date DATE, return_quantity INT, "
            "return_amount DOUBLE"),
        "dim_store": spark.createDataFrame(
            [(1, "Central"), (2, "North"), (3, None)], "store_id INT, sales_region STRING"),
        "dim_customer": spark.createDataFrame(
            [("c", "Ann", "$1")], "customer_id STRING, customer_name STRING, yearly_income STRING"),
        "dim_product": spark.createDataFrame(
            [("p", 4.0)], "product_id STRING, product_cost DOUBLE"),
    }


@pytest.mark.parametrize("groups,stores,money", [
    ({"admins"}, [1, 2, 3], True), ({"data_engineers"}, [1, 2, 3], True),
    ({"data_analysts"}, [1, 2, 3], False), ({"business_users"}, [1, 2, 3], False),
    ({"central_managers"}, [1], False), ({"other_region_managers"}, [2], False),
    ({"central_managers", "other_region_managers"}, [1, 2], False), (set(), [], False),
    ({"central_managers", "data_engineers"}, [1, 2, 3], True),
])
def test_fact_rows_and_masks(spark, gold, groups, stores, money):
    secure.create_views(gold, groups)
    got = spark.table("v_secure_fact_sales")
    assert [r.store_id for r in got.orderBy("store_id").collect()] == stores
    assert {r.total_profit for r in got.collect()} <= ({5.0} if money else {None})
    assert "customer_id" not in got.columns
    back = spark.table("v_secure_fact_returns")
    assert [r.store_id for r in back.orderBy("store_id").collect()] == stores


def test_dimension_masks(spark, gold):
    def shown(groups):
        secure.create_views(gold, groups)
        person = rows(spark.table("v_secure_dim_customer"))
        return person, rows(spark.table("v_secure_dim_product"))

    assert shown({"admins"}) == ([("c", "Ann", "$1")], [("p", 4.0)])
    assert shown({"data_engineers"}) == ([("c", "REDACTED", "$1")], [("p", 4.0)])
    assert shown(set()) == ([("c", "REDACTED", "RESTRICTED")], [("p", None)])


def test_sql_views_answer_for_the_groups_of_the_moment(spark, gold):
    """One definition, every caller, equal to the function form; no groups see no rows."""
    secure.create_sql_views(spark, gold)
    views = ("fact_sales", "fact_returns", "dim_customer", "dim_product")
    assert spark.sql("SELECT * FROM v_secure_fact_sales").count() == 0
    for groups in ({"admins"}, {"data_engineers"}, {"data_analysts"}, {"central_managers"},
                   {"central_managers", "other_region_managers"}, {"it's \\ odd"}, set()):
        secure.act_as(spark, groups)
        got = {v: rows(spark.sql(f"SELECT * FROM v_secure_{v}")) for v in views}
        made = {
            "fact_sales": secure.secure_fact_sales(gold["fact_sales"], gold["dim_store"], groups),
            "fact_returns": secure.secure_fact_returns(gold["fact_returns"], gold["dim_store"], groups),
            "dim_customer": secure.secure_dim_customer(gold["dim_customer"], groups),
            "dim_product": secure.secure_dim_product(gold["dim_product"], groups)}
        assert got == {v: rows(made[v].select(*spark.table(f"v_secure_{v}").columns)) for v in views}
    plan = spark.sql("SELECT * FROM v_secure_fact_sales")._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation <empty>" in plan, "without groups nothing is read"


def test_masked_columns_are_not_read(spark, gold, tmp_path):
    gold["fact_sales"].write.parquet(f"{tmp_path}/f")
    sales = spark.read.parquet(f"{tmp_path}/f")
    view = secure.secure_fact_sales(sales, gold["dim_store"], {"data_analysts"})
    plan = view._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "total_revenue" not in scan.split("ReadSchema")[1]


@pytest.fixture(scope="module")
def orders(spark):
    times = [dt.timedelta(minutes=m) for m in (1, 0.5, 30, 119, 121)]
    made = [(f"o{i % 4}", i, 1, 1, "web", NOW - t, NOW - t, NOW) for i, t in enumerate(times)]
    return spark.createDataFrame(
        made, "order_id STRING, product_id INT, store_id INT, quantity INT, "
              "order_channel STRING, timestamp TIMESTAMP, event_timestamp TIMESTAMP, "
              "processing_timestamp TIMESTAMP")


def at(moment=NOW):
    return ops.Window(F.lit(moment))


def value(df):
    [row] = df.collect()
    return row[0]


def test_two_hours_back_from_a_moment(orders):
    assert value(ops.total_orders(orders, at())) == 4
    assert value(ops.orders_per_minute(orders, at())) == 0.03
    assert value(ops.latest_event(orders, at())) == NOW - dt.timedelta(minutes=0.5)
    assert value(ops.streaming_lag(orders, at())) == 0.5
    assert value(ops.total_orders(orders, at(NOW - dt.timedelta(minutes=20)))) == 3
    assert value(ops.duplicate_orders(orders, ops.Window(F.lit(NOW), "3 hours"))) == 1


def test_the_current_time_is_the_default(spark, orders):
    assert value(ops.total_orders(orders)) == 0
    fresh = orders.withColumn("timestamp", F.current_timestamp())
    assert value(ops.total_orders(fresh)) == 5


def test_empty_windows(orders):
    none = at(dt.datetime(2020, 1, 1))
    assert value(ops.orders_per_minute(orders, none)) == 0.0
    assert value(ops.duplicate_orders(orders, none)) is None
    assert value(ops.latest_event(orders, none)) is None
    assert value(ops.null_critical_fields(orders, none)) is None


def test_latency_and_minutes(orders):
    got = rows(ops.latency_trend(orders, at()))
    assert [r[1] for r in got] == [7140.0, 1800.0, 45.0]
    assert [r[1] for r in rows(ops.orders_per_minute_trend(orders, at()))] == [1, 1, 2]


def test_stock_reports(spark):
    stock = spark.createDataFrame(
        [(f"i{i}", i % 30, i % 25, q, "x", NOW)
         for i, q in enumerate([5] * 60 + [10, 49, 50, None])],
        "inventory_id STRING, product_id INT, store_id INT, quantity_remaining INT, "
        "stock_status STRING, timestamp TIMESTAMP")
    assert rows(ops.stock_level_distribution(stock, at())) == [
        ("High", 2), ("Low", 60), ("Medium", 2)]
    top = ops.low_stock_by_store(stock, at()).collect()
    assert len(top) == 20 and [r.low_stock_count for r in top[:11]] == [3] * 10 + [2]
    assert value(ops.low_stock_alerts(stock, at())) == 60
    latest = ops.recent_inventory(stock, at()).collect()
    assert len(latest) == 50 and latest[0].inventory_id == "i0"
