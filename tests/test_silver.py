import datetime as dt
import json

from conftest import rows
from pyspark.sql import functions as F

from larder.functions.scalar import parse_date
from larder.operators.dedup import keep_first
from larder.plans import silver

DAY = dt.date


def test_dates_with_one_or_two_digits_and_bad_text(spark):
    df = spark.createDataFrame([("1/5/2024",), ("12/31/2023",), ("01/02/2024",), ("nope",),
                                ("13/45/2024",), (None,)], "d STRING")
    got = [r[0] for r in df.select(parse_date("d")).collect()]
    assert got == [DAY(2024, 1, 5), DAY(2023, 12, 31), DAY(2024, 1, 2), None, None, None]


def test_transactions(spark):
    bronze = spark.createDataFrame([
        ("1", "10", "100", "1/5/2024", "5"), ("1", "10", "100", "1/5/2024", "9"),
        ("2", "20", "200", "bad", "x"), ("3", "30", "300", "1/6/2024", "0"),
    ], "product_id STRING, customer_id STRING, store_id STRING, transaction_date STRING, "
       "quantity STRING")
    got = silver.silver_csv(bronze, "transactions", ["quantity"])
    assert rows(got.select("product_id", "transaction_date", "quantity", "record_status")) == [
        ("1", DAY(2024, 1, 5), 5, "cleaned"), ("2", None, None, "cleaned"),
        ("3", DAY(2024, 1, 6), 0, "invalid")]
    assert {"pipeline_run_id", "processing_timestamp", "source_table"} <= set(got.columns)
    assert silver.silver_csv(bronze, "transactions").count() == 3


def test_stores_regions_and_calendar(spark):
    stores = spark.createDataFrame(
        [("1", "7", "  Corner ", "new york", "ny", "1/9/2001", "2010-06-01"),
         ("x", None, None, None, None, None, "soon")],
        "store_id STRING, region_id STRING, store_name STRING, store_city STRING, "
        "store_state STRING, first_opened_date STRING, last_remodel_date STRING")
    got = silver.silver_csv(stores, "stores", ["store_name"]).select(*stores.columns)
    assert rows(got) == [
        (1, 7, "Corner", "New York", "NY", DAY(2001, 1, 9), DAY(2010, 6, 1)),
        (None,) * 7]
    regions = spark.createDataFrame([("1", "north west", "area one")] * 2,
                                    "region_id STRING, sales_region STRING, sales_district STRING")
    got = silver.silver_csv(regions, "regions", ["sales_region"])
    assert rows(got.select("region_id", "sales_region", "sales_district")) == [
        (1, "North West", "Area One")]
    days = spark.createDataFrame([("1/1/2024",), ("1/1/2024",)], "date STRING")
    assert silver.silver_csv(days, "calendar").count() == 2


def payload(spark, *bodies):
    return spark.createDataFrame([(b, dt.datetime(2024, 1, 1, 12)) for b in bodies],
                                 "raw_payload STRING, timestamp TIMESTAMP")


def test_order_payload(spark):
    body = json.dumps({"order_id": "O1", "product_id": 1, "customer_id": 2, "store_id": 3,
                       "quantity": 4, "order_date": "1/5/2024", "payment_type": "card",
                       "order_channel": "web", "surplus": 1})
    wrong = json.dumps({"order_id": "O2", "quantity": "many"})
    got = silver.flatten_orders(payload(spark, body, "{broken", wrong, None))
    assert dict(got.dtypes)["order_date"] == "date"
    assert rows(got.select("order_id", "product_id", "quantity", "order_date",
                           "order_channel")) == [
        (None,) * 5, (None,) * 5, ("O1", 1, 4, DAY(2024, 1, 5), "web"),
        ("O2", None, None, None, None)]


def test_inventory_payload_and_bands(spark):
    bodies = [json.dumps({"inventory_id": f"I{q}", "event_timestamp": "2024-01-01 10:00:00",
                          "product_id": 1, "store_id": 1, "quantity_added": a,
                          "quantity_remaining": q})
              for q, a in ((0, 50), (15, 0), (35, None), (100, 1), (-3, -1), (None, 1))]
    got = silver.silver_inventory(payload(spark, *bodies, bodies[0]), ["timestamp"])
    assert {r.inventory_id: (r.stock_status, r.is_restock) for r in got.collect()} == {
        "I0": ("OUT_OF_STOCK", True), "I15": ("LOW_STOCK", False), "I35": ("MEDIUM", False),
        "I100": ("HEALTHY", True), "I-3": ("LOW_STOCK", False), "INone": ("HEALTHY", True)}
    [time] = {r.event_timestamp for r in got.collect()}
    assert time == dt.datetime(2024, 1, 1, 10)


def test_documents(spark):
    person = json.dumps({"customer_id": 999, "customer_acct_num": 87000000000,
                         "first_name": "Ann", "last_name": None, "birthdate": "8/26/1961",
                         "acct_open_date": "9/10/1991", "total_children": 4})
    thing = json.dumps({"product_id": 999, "product_name": "  Tea  ", "product_sku": 90748583674,
                        "product_retail_price": 2.85, "recyclable": 1})
    people = silver.conform_customers(spark.createDataFrame([(17, person)], "_id INT, data STRING"))
    [p] = people.collect()
    assert (p.customer_id, p.customer_name, p.birthdate, p.customer_acct_num) == (
        "17", "Ann", DAY(1961, 8, 26), 87000000000)
    assert len(people.columns) == 21
    [t] = silver.silver_products(
        spark.createDataFrame([("p1", thing)], "_id STRING, data STRING")).collect()
    assert (t.product_id, t.product_name, t.product_retail_price, t.product_cost,
            t.low_fat) == ("p1", "Tea", 2.85, None, None)


def test_keep_first_takes_null_keys_as_equal_and_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), (1, 3), (1, 4)], "k INT, v INT")
    kept = keep_first(df, ["k"], [F.col("v").desc()])
    assert rows(kept) == [(1, 4), (None, 2)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")
