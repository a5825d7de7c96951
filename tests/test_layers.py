"""Two triggered updates from files, topics and documents to the aggregates."""

import datetime as dt
import json
import os

import pytest
from conftest import rows

from larder.operators import audit, scd2
from larder.sources import tables
from larder.streaming import layers, scd2_apply

NOW = dt.datetime(2024, 1, 1)


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(text)


def test_update_twice(spark, tmp_path):
    lay = layers.Layout(f"{tmp_path}/lake")
    headers = {
        "transactions": ["product_id", "customer_id", "store_id", "transaction_date", "quantity"],
        "returns": ["product_id", "store_id", "return_date", "quantity"],
        "stores": ["store_id", "region_id", "store_name", "store_city", "store_state",
                   "first_opened_date", "last_remodel_date"],
        "regions": ["region_id", "sales_region", "sales_district"],
    }

    def csv(table, name, *lines):
        put(f"{tmp_path}/in/{table}/{name}.csv",
            "\n".join([",".join(headers[table]), *lines]) + "\n")

    def documents(table, *docs):
        made = [(i, json.dumps(d)) for i, d in docs]
        spark.createDataFrame(made, "_id STRING, data STRING").coalesce(1).write.mode(
            "append").parquet(f"{tmp_path}/in/{table}")

    def order(i, quantity):
        body = json.dumps({"order_id": i, "product_id": 1, "customer_id": 9, "store_id": 5,
                           "quantity": quantity, "order_date": "1/5/2024"})
        spark.createDataFrame(
            [(bytearray(body, "utf8"), "orders", 0, 0, NOW)],
            "value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
        ).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/orders")

    def update():
        for table, columns in headers.items():
            layers.land_csv(spark, lay, table, f"{tmp_path}/in/{table}", columns)
        layers.land_topic(lay, "orders", tables.parquet_stream(spark, f"{tmp_path}/in/orders"))
        for table in ("customers", "products"):
            layers.land_documents(
                lay, table, tables.parquet_stream(spark, f"{tmp_path}/in/{table}"))
        for table in (*headers, "orders", "customers", "products"):
            layers.clean(spark, lay, table)
        for table in ("transactions", "orders"):
            layers.split(spark, lay, table)
        for table in layers.HISTORIES:
            layers.track(spark, lay, table)
        log = audit.RunLog(spark, "layers_log")
        made = layers.publish(spark, lay, log)
        log.finish()
        return made

    csv("regions", "a", "7,central,north")
    csv("stores", "a", "5,7, Corner ,rome,it,1/1/2001,")
    csv("transactions", "a", "1,9,5,1/5/2024,2", "1,9,5,1/5/2024,2", "1,,5,1/5/2024,3")
    csv("returns", "a", "1,5,1/9/2024,1")
    documents("customers", ("9", {"first_name": "Ann", "yearly_income": "$1"}))
    documents("products", ("1", {"product_name": "Tea", "product_retail_price": 2.0,
                                 "product_cost": 1.0}))
    order("O1", 4)
    order("O2", 0)
    first = update()
    assert rows(first["fact_sales"].select("quantity", "total_revenue")) == [(2, 4.0), (4, 8.0)]
    [day] = first["agg_daily_sales"].collect()
    assert (day.total_units, day.unique_customers, day.sales_region, day.store_name,
            day.avg_transaction_value) == (6, 1, "Central", "Corner", 6.0)
    assert first["agg_store_performance"].first().return_rate == 16.67

    csv("transactions", "b", "1,9,5,1/6/2024,1", "1,9,5,1/5/2024,2")
    documents("products", ("1", {"product_retail_price": 3.0}))
    order("O3", 1)
    second = update()
    assert rows(second["fact_sales"].select("quantity", "total_revenue", "total_cost")) == [
        (1, 3.0, 1.0), (1, 3.0, 1.0), (2, 6.0, 2.0), (4, 12.0, 4.0)]
    history = scd2_apply.read_history(
        spark, lay.table("silver", "scd_products"), layers.HISTORIES["products"])
    assert [r.product_retail_price for r in history.orderBy(scd2.START).collect()] == [2.0, 3.0]
    assert second["dim_product"].first().product_name == "Tea"
    _, bad = layers.read_split(spark, lay, "transactions")
    assert [r._quarantine_reason for r in bad.collect()] == ["valid_customer"]
    log = spark.table("layers_log").where("event_type = 'TABLE_SUCCESS'")
    assert log.count() == 18 and log.where("row_count_output IS NULL").count() == 0


@pytest.mark.parametrize("strict,kept", [(False, 2), (True, 1)])
def test_inventory_rules_that_act_on_rows(spark, tmp_path, strict, kept):
    lay = layers.Layout(f"{tmp_path}/lake")

    def land(i, product, store):
        body = json.dumps({"inventory_id": i, "event_timestamp": "2024-01-01 00:00:00",
                           "product_id": product, "store_id": store, "quantity_remaining": 1})
        spark.createDataFrame(
            [(bytearray(body, "utf8"), "inventory", 0, 0, NOW)],
            "value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
        ).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        layers.land_topic(lay, "inventory", tables.parquet_stream(spark, f"{tmp_path}/in"))

    land("a", 1, 1)
    land("b", 1, None)
    layers.clean(spark, lay, "inventory", strict)
    assert spark.read.parquet(lay.table("silver", "inventory")).count() == kept
    land("c", None, 1)
    if strict:
        with pytest.raises(Exception, match="valid_product"):
            layers.clean(spark, lay, "inventory", strict)
    else:
        layers.clean(spark, lay, "inventory")
        layers.split(spark, lay, "inventory")
        good, bad = layers.read_split(spark, lay, "inventory")
        assert (good.count(), bad.count()) == (1, 2)
