"""Revisions and copies that only their place in the source sets apart; exact amounts."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from larder.functions import money
from larder.operators import audit, quality, scd2
from larder.plans import silver
from larder.sources import tables, topics
from larder.streaming import jobs

AT = datetime(2024, 1, 1)


def test_one_landing_keeps_the_last_revision_not_a_mixture(spark):
    feed = spark.createDataFrame(
        [("c", AT, 1, "Austin", "$50K"), ("c", AT, 2, "Boston", "$30K"),
         ("d", AT, 1, "Oslo", "$10K"), ("d", AT, 2, None, "$20K")],
        "k string, at timestamp, pos int, city string, income string")
    spec = scd2.Spec(["k"], "at", ["city", "income"], tie_break=["pos"])
    want = [("c", "Boston", "$30K"), ("d", "Oslo", "$20K")]
    assert rows(scd2.history(feed, spec).select("k", "city", "income")) == want
    assert rows(scd2.latest_state(feed, spec).select("k", "city", "income")) == want


def test_without_a_place_one_whole_row_is_kept(spark):
    feed = spark.createDataFrame(
        [("c", AT, "Austin", 9), ("c", AT, "Boston", 1)], "k string, at timestamp, a string, b int")
    spec = scd2.Spec(["k"], "at", ["a", "b"])
    assert rows(scd2.history(feed, spec).select("a", "b")) == [("Boston", 1)]
    assert rows(scd2.latest_state(feed, spec).select("a", "b")) == [("Boston", 1)]


def test_records_of_one_key_go_by_partition_and_offset(spark):
    body = '{{"order_id":"o","quantity":{}}}'
    records = spark.createDataFrame(
        [(bytearray(body.format(q), "utf8"), "orders", p, o, AT) for q, p, o in
         ((9, 1, 5), (1, 0, 7), (4, 0, 6))],
        "value binary, topic string, partition int, offset long, timestamp timestamp")
    for df in (records, records.orderBy("offset"), records.orderBy(F.desc("offset"))):
        kept = silver.silver_orders(topics.raw_payloads(df), ["timestamp"])
        assert [r.quantity for r in kept.collect()] == [4]
        assert not set(silver.POSITION) & set(kept.columns)


def test_small_prices_are_exact_and_finer_ones_stop(spark):
    prices = spark.createDataFrame([(0.00004, 1_000_000), (901.000123, 3), (1e9 + 0.25, 2), (None, 1)],
                                   "p double, q int")
    total = money.from_ticks(F.col("q") * money.to_ticks("p"))
    assert [r[0] for r in prices.select(total).collect()] == [40.0, 2703.000369, 2000000000.5, None]
    with pytest.raises(Exception, match="six decimals"):
        spark.createDataFrame([(0.1234567,)], "p double").select(money.to_ticks("p")).collect()


def test_a_split_is_stamped_once(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([("a", 1, 1), (None, 1, 1)], "order_id string, product_id int, quantity int") \
        .selectExpr("*", "1 AS customer_id", "1 AS store_id", "timestamp'2020-01-01' AS processing_timestamp",
                    "timestamp'2020-01-01' AS pipeline_run_id").write.parquet(source)
    out = str(tmp_path / "out")
    jobs.run_split(tables.parquet_stream(spark, source), quality.ORDER_RULES, out, f"{tmp_path}/c")
    good, bad = jobs.read_split(spark, out)
    first, again = good.first(), jobs.read_split(spark, out)[0].first()
    assert first.record_status == "valid" and first.processing_timestamp.year > 2020
    assert first.processing_timestamp == again.processing_timestamp
    late = bad.first()
    assert late[quality.SET_ASIDE_AT] is not None and late.processing_timestamp.year == 2020


def test_log_rows_go_to_a_folder_too(spark, tmp_path):
    run = audit.Run("p", "r")
    counted = audit.row_count_rows(audit.table_counts(input=spark.range(3)), run, "silver", "t")
    for _ in range(2):
        audit.append(counted, path=str(tmp_path / "log"))
    assert [r.message for r in spark.read.parquet(str(tmp_path / "log")).collect()] == \
        ["silver.t rows: 3 input"] * 2
