"""Aggregates that follow late rows, price changes and vanished days."""

import datetime as dt
import os
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from acceptance.feeds import Lake
from larder.plans import gold, incremental
from larder.session import FREEING, using, work_dir

D1, D2, D3 = dt.date(2024, 1, 5), dt.date(2024, 1, 6), dt.date(2024, 2, 6)
STORES = """store_id INT, store_name STRING, store_city STRING, store_state STRING,
    region_id INT, sales_region STRING, sales_district STRING"""
SALE = "product_id STRING, customer_id STRING, store_id STRING, transaction_date DATE, quantity INT"
RETURN = "product_id STRING, store_id STRING, return_date DATE, quantity INT"
SOLD = [("1", "10", "100", D1, 3), ("1", "11", "100", D1, 2), ("2", "10", "100", D2, 4),
        ("1", "10", "200", D3, 1), ("9", None, None, None, 5), ("1", "12", "100", None, None)]
BACK = [("1", "100", D1, 1), ("2", "100", D3, 2), ("7", "300", None, 1)]


class Shop:
    def __init__(self, spark):
        self.spark, self.path = spark, work_dir(spark, "gold")
        self.stores = spark.createDataFrame([(100, "S", "C", "T", 1, "R", "D")], STORES)
        self.prices([("1", "B1", 0.1, 0.07), ("2", None, 2.5, 1.0)])
        self.sold, self.back = list(SOLD), list(BACK)

    def prices(self, products):
        self.products = self.spark.createDataFrame(
            products, "product_id STRING, product_brand STRING, product_retail_price DOUBLE, "
            "product_cost DOUBLE")

    def facts(self):
        none = self.spark.createDataFrame([], SALE.replace("transaction_date", "order_date"))
        return (gold.fact_sales(self.spark.createDataFrame(self.sold, SALE), none, self.products),
                gold.fact_returns(self.spark.createDataFrame(self.back, RETURN), self.products))

    def refresh(self, sale_days=None, return_days=None, by="day"):
        sales, returns = self.facts()
        days = lambda values: self.spark.createDataFrame([(v,) for v in values], "d DATE")
        incremental.refresh(
            self.spark, self.path, sales=sales, returns=returns, products=self.products,
            sale_days=sales.select("transaction_date") if sale_days is None else days(sale_days),
            return_days=returns.select("return_date") if return_days is None else days(return_days), by=by)

    def check(self):
        """Every table equals the one computed from all rows."""
        sales, returns = self.facts()
        for got, want in (
            (incremental.table(self.spark, self.path, "fact_sales"), sales),
            (incremental.table(self.spark, self.path, "fact_returns"), returns),
            (incremental.agg_daily_sales(self.spark, self.path, self.stores),
             gold.agg_daily_sales(sales, self.stores)),
            (incremental.agg_monthly_sales(self.spark, self.path),
             gold.agg_monthly_sales(sales, self.products)),
            (incremental.agg_store_performance(self.spark, self.path),
             gold.agg_store_performance(sales, returns)),
            (incremental.agg_return_kpi(self.spark, self.path),
             gold.agg_return_kpi(sales, returns)),
        ):
            assert sorted(got.columns) == sorted(want.columns)
            assert dict(got.dtypes) == dict(want.dtypes)
            assert rows(got.select(want.columns)) == rows(want)

    def files(self):
        return {os.path.relpath(os.path.join(at, name), self.path): os.stat(f"{at}/{name}").st_mtime_ns
                for at, _, names in os.walk(self.path) for name in names if name.endswith(".parquet")}


@pytest.fixture
def shop(spark):
    return Shop(spark)


def test_late_rows_touch_their_days_only(shop, spark):
    shop.refresh()
    before = shop.files()
    shop.sold += [("1", "13", "100", D2, 7), ("2", "10", "300", D2, 1)]
    shop.refresh([D2, D2], [])
    shop.check()
    after = shop.files()
    moved = {name for name in before if after.get(name) != before[name]}
    assert moved and {name.split("/")[1] for name in moved} == {
        "_part=2024-01-06", "_part=2024-01-01"}
    for kept in ("daily/_part=2024-01-05", "daily/_part=2024-02-06", "monthly/_part=2024-02-01",
                 "returns_parts/_part=2024-01-05"):
        assert any(kept in name and after.get(name) == before[name] for name in before)
    # days and groups that lost all their rows
    shop.sold = [s for s in shop.sold if s[3] not in (D1, D3, None)]
    shop.back = [b for b in shop.back if b[2] is not None]
    shop.refresh([D1, D3, None], [None])
    shop.check()
    # the named days prune a source that is partitioned by day
    facts = incremental._stored(spark, shop.path, "fact_sales")
    days = incremental._kept(spark, spark.createDataFrame([(D2,)], "d DATE"), F.col)
    chosen = incremental._on_days(facts, F.col("_part"), days)
    assert "dynamicpruning" in chosen._jdf.queryExecution().toString()


def test_a_changed_price_or_brand_touches_the_days_that_sold_it(shop, spark):
    shop.refresh()
    before = shop.products
    shop.prices([("1", "B2", 0.2, 0.07), ("2", None, 2.5, 1.0), ("9", "B9", 1.0, 1.0)])
    changed = incremental.changed_products(before, shop.products)
    assert rows(changed) == [("1",), ("9",)]
    sold, back = incremental.days_selling(spark, shop.path, changed)
    assert set(rows(sold)) == {(D1,), (D3,), (None,)} and rows(back) == [(D1,)]
    shop.refresh([d for d, in rows(sold)], [d for d, in rows(back)])
    shop.check()


def test_months_as_the_unit(shop):
    shop.refresh(by="month")
    shop.sold += [("2", "13", "200", D1, 2)]
    shop.refresh([D1], [], by="month")
    shop.check()


def test_nothing_to_refresh(shop):
    shop.sold, shop.back = [], []
    shop.refresh()
    shop.check()



def test_tables_of_a_refresh_share_one_shuffle(shop, spark):
    sales, _ = shop.facts()
    days = incremental._kept(spark, sales.select("transaction_date"), F.col)
    dealt = incremental._dealt(incremental._branded(sales, shop.products), days, F.col("transaction_date"))
    assert dealt.where("not _filler").count() == len(SOLD)
    for made in (incremental._totals(dealt, "transaction_date", "store_id"),
                 incremental._totals(dealt, "store_id", "product_brand"),
                 dealt.select(*incremental._SLICED, "store_id", "customer_id").distinct()):
        made.collect()
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "InMemoryRelation" in plan and "Exchange" not in plan.split("InMemoryRelation")[0]
    dealt.unpersist()


def test_a_product_that_is_there_twice_makes_no_more_facts(shop, spark):
    sales, returns = shop.facts()
    twice = shop.products.unionByName(shop.products.where("product_id = '1'").withColumn("product_brand", F.lit("B0")))
    incremental.refresh(spark, shop.path, sales=sales, returns=returns, products=twice, by="month",
                        sale_days=sales.select("transaction_date"), return_days=returns.select("return_date"))
    assert rows(incremental.table(spark, shop.path, "fact_sales").select(sales.columns)) == rows(sales)
    sold = incremental.agg_monthly_sales(spark, shop.path).where("store_id = 100 and month = 1")
    assert set(rows(sold.select("product_brand", "total_units", "unique_customers"))) == {
        (None, 4, 1), ("B0", 5, 2), ("B1", 5, 2)}


def _shuffle_files(spark, known=()):
    """Files of shuffles on disk that are not ``known``; their removal takes a moment."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    for _ in range(50):
        found = {name for top in folders for _, _, names in os.walk(top) for name in names
                 if name.startswith("shuffle_")} - set(known)
        if not found:
            break
        time.sleep(0.2)
    return found


def test_a_refresh_leaves_no_shuffle_files(shop, spark):
    sales, returns = ((f.write.parquet(f"{shop.path}-{n}"), spark.read.schema(f.schema).parquet(f"{shop.path}-{n}"))[1]
                      for n, f in enumerate(shop.facts()))
    known = _shuffle_files(spark)
    incremental.refresh(spark, shop.path, sales=sales, returns=returns, products=shop.products, by="month",
                        sale_days=sales.select("transaction_date"), return_days=returns.select("return_date"))
    assert not _shuffle_files(spark, known)
    Lake(spark, "")._stored("facts", sales.groupBy("store_id").count())
    assert not _shuffle_files(spark, known)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_kept_rows_are_there_once(shop, spark):
    sales, _ = shop.facts()
    known = _shuffle_files(spark)
    with using(spark, FREEING):
        days = incremental._kept(spark, sales.select("transaction_date"), F.col)
        dealt = incremental._dealt(sales, days, F.col("transaction_date"))
        incremental._release(dealt)
    assert not _shuffle_files(spark, known)
    assert dealt.where("not _filler").count() == len(SOLD)
    dealt.unpersist()


@pytest.mark.parametrize("by", ["day", "month"])
def test_days_in_groups_give_the_same_tables(shop, spark, monkeypatch, by):
    monkeypatch.setattr(incremental, "GROUP_TASKS", 2)
    dealt, made = incremental._dealt, []
    monkeypatch.setattr(incremental, "_dealt", lambda *a: made.append(a[1].count()) or dealt(*a))
    with using(spark, {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "6"}):
        shop.refresh(by=by)
        shop.check()
        shop.sold += [("2", "13", "200", D1, 2)]
        shop.refresh([D1], [], by=by)
    shop.check()
    assert len(made) == 3 + 3 + 1 + 1 and sum(made[:3]) == (4 if by == "day" else 3)
