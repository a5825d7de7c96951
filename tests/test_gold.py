import datetime as dt

import pytest
from conftest import rows

from larder.plans import gold

D1, D2 = dt.date(2024, 1, 5), dt.date(2024, 2, 6)


@pytest.fixture(scope="module")
def star(spark):
    tx = spark.createDataFrame(
        [("1", "10", "100", D1, 3), ("1", "11", "100", D1, 2), ("A-7", "10", "200", D2, 1)],
        "product_id STRING, customer_id STRING, store_id STRING, transaction_date DATE, "
        "quantity INT")
    orders = spark.createDataFrame(
        [(1, 10, 100, D1, 5), (2, 12, 300, D2, 4)],
        "product_id INT, customer_id INT, store_id INT, order_date DATE, quantity INT")
    products = spark.createDataFrame(
        [("1", "Tea", "B1", 0.1, 0.07), ("2", "Cup", None, 2.5, 1.0)],
        "product_id STRING, product_name STRING, product_brand STRING, "
        "product_retail_price DOUBLE, product_cost DOUBLE")
    returns = spark.createDataFrame(
        [("1", "100", D1, 2), ("9", "300", D2, 1)],
        "product_id STRING, store_id STRING, return_date DATE, quantity INT")
    return {"sales": gold.fact_sales(tx, orders, products), "products": products,
            "returns": gold.fact_returns(returns, products)}


def test_fact_sales_unites_text_and_number_ids(star):
    got = rows(star["sales"].select("product_id", "store_id", "quantity", "total_revenue",
                                    "total_cost", "total_profit"))
    assert got == [("1", 100, 2, 0.2, 0.14, 0.06), ("1", 100, 3, 0.3, 0.21, 0.09),
                   ("1", 100, 5, 0.5, 0.35, 0.15), ("2", 300, 4, 10.0, 4.0, 6.0),
                   ("A-7", 200, 1, None, None, None)]


def test_fact_returns(star):
    assert rows(star["returns"].select("product_id", "return_quantity", "return_amount")) == [
        ("1", 2, 0.2), ("9", 1, None)]


def test_daily(spark, star):
    stores = spark.createDataFrame(
        [(100, "S", "C", "ST", 1, "Central", "D")],
        "store_id INT, store_name STRING, store_city STRING, store_state STRING, "
        "region_id INT, sales_region STRING, sales_district STRING")
    got = {r.store_id: r for r in gold.agg_daily_sales(star["sales"], stores).collect()}
    one = got[100]
    assert (one.total_units, one.total_revenue, one.unique_customers, one.total_transactions,
            one.avg_transaction_value, one.sales_region) == (10, 1.0, 2, 3, 0.33, "Central")
    assert got[200].total_revenue is None and got[300].store_name is None
    rough = gold.agg_daily_sales(star["sales"], stores, approximate=0.05)
    assert {r.store_id: r.unique_customers for r in rough.collect()} == {100: 2, 200: 1, 300: 1}


def test_monthly_groups_unknown_brands(star):
    got = gold.agg_monthly_sales(star["sales"], star["products"])
    assert rows(got.select("year", "month", "store_id", "product_brand", "total_units")) == [
        (2024, 1, 100, "B1", 10), (2024, 2, 200, None, 1), (2024, 2, 300, None, 4)]


def test_return_rates(star):
    stores = gold.agg_store_performance(star["sales"], star["returns"])
    assert rows(stores.select("store_id", "total_units_returned", "return_rate")) == [
        (100, 2, 20.0), (200, None, None), (300, 1, 25.0)]
    kpi = gold.agg_return_kpi(star["sales"], star["returns"])
    assert rows(kpi) == [("1", 10, 2, 0.2), ("2", 4, None, None), ("A-7", 1, None, None)]


def test_store_without_region_stays(spark):
    stores = spark.createDataFrame(
        [(1, "a", "b", "c", 7), (2, "d", "e", "f", None)],
        "store_id INT, store_name STRING, store_city STRING, store_state STRING, region_id INT")
    regions = spark.createDataFrame([(7, "Central", "North")],
                                    "region_id INT, sales_region STRING, sales_district STRING")
    got = gold.dim_store(stores, regions)
    assert tuple(got.columns) == gold.STORE_COLUMNS
    assert rows(got.select("store_id", "sales_region")) == [(1, "Central"), (2, None)]
