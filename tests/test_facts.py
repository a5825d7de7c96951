"""Fact streams without state, and the log of running streams."""

import json
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from larder.plans import silver
from larder.sources import tables
from larder.streaming import facts, jobs
from larder.streaming.watch import Watch

SCHEMA = "product_id STRING, customer_id STRING, store_id STRING, transaction_date STRING, quantity STRING"


def put(spark, tmp_path, made):
    spark.createDataFrame(made, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")


def run(spark, tmp_path, **options):
    stream = tables.parquet_stream(spark, f"{tmp_path}/in", 1)
    query = facts.run_facts(stream, "transactions", f"{tmp_path}/out", f"{tmp_path}/checkpoint", **options)
    return facts.read(spark, f"{tmp_path}/out"), query


def test_copies_are_dropped_however_late(spark, tmp_path):
    put(spark, tmp_path, [("1", "9", "5", "1/5/2024", "3"), ("1", "9", "5", "1/5/2024", "2"),
                          (None, "9", "5", "1/5/2024", "1"), ("1", "9", "5", "bad", "1")])
    put(spark, tmp_path, [("1", "9", "5", "1/5/2024", "1"), ("1", "9", "5", "1/6/2024", "1"),
                          (None, "9", "5", "1/5/2024", "8"), ("1", "9", "5", "also bad", "7")])
    got, query = run(spark, tmp_path)
    want = [("1", "2024-01-05", 2), ("1", "2024-01-06", 1), ("1", "None", 1), ("None", "2024-01-05", 1)]
    shown = lambda df: sorted((str(r[0]), str(r[1]), r[2]) for r in df.select(
        "product_id", "transaction_date", "quantity").collect())
    assert shown(got) == want
    put(spark, tmp_path, [("1", "9", "5", "1/5/2024", "1")])
    got, query = run(spark, tmp_path)
    assert shown(got) == want
    assert not [p for p in query.recentProgress if p["stateOperators"]]


def test_a_batch_reads_its_own_dates_and_can_be_repeated(spark, tmp_path):
    path, keys = f"{tmp_path}/out", list(silver.KEYS["transactions"])

    def batch(n, day):
        made = [(str(i), "9", "5", f"1/{day}/2024", "1") for i in range(5)]
        return silver.conform_csv(spark.createDataFrame(made, SCHEMA), "transactions")

    for n, day in enumerate([1, 2, 3, 2]):
        for _ in range(2):
            new = facts.unseen(batch(n, day), n, path, keys, "transaction_date")
            facts.land(new, n, path, "transaction_date")
    assert facts.read(spark, path).count() == 15
    rows_ = batch(4, 2)
    days = rows_.select(F.col("transaction_date").alias(facts.PERIOD)).distinct()
    seen = facts.landed_keys(spark, path, rows_.schema, keys, days, 4)
    plan = seen._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[([^]]*)\]", plan)[1]
    assert "_period" in filters and "2024-01-02" in filters and "_landed_batch" in filters
    assert seen.count() == 5


def test_a_batch_is_shuffled_once_to_find_its_new_keys(spark, tmp_path):
    path, keys = f"{tmp_path}/out", list(silver.KEYS["transactions"])

    def batch(*made):
        return silver.conform_csv(spark.createDataFrame(list(made), SCHEMA), "transactions")

    old = [("1", None, "5", "1/1/2024", "1"), (None, None, None, "bad", "2"), ("", "9", "5", "1/1/2024", "3")]
    facts.land(batch(*old), 0, path, "transaction_date")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = facts.unseen(batch(*old, ("1", "", "5", "1/1/2024", "4"), ("1", "", "5", "1/1/2024", "5"),
                                 (None, "9", "5", "1/1/2024", "6")), 1, path, keys, "transaction_date")
        assert sorted(r["quantity"] for r in new.collect()) == [4, 6]
        plan = new._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        assert plan.count("Exchange hashpartitioning") == 2  # the batch and the landed keys
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_watch_logs_each_batch_once(spark, tmp_path):
    rules = {"id": "order_id IS NOT NULL", "qty": "quantity > 0"}
    log = f"{tmp_path}/log"

    def add(made):
        spark.createDataFrame(made, "order_id STRING, quantity INT").coalesce(1).write.mode(
            "append").parquet(f"{tmp_path}/in")

    def update():
        with Watch(spark, log) as watch:
            stream = watch.observed(tables.parquet_stream(spark, f"{tmp_path}/in", 1), "silver", "t", rules)
            jobs.run_append(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint")

    add([("a", 1), (None, 0)])
    add([("b", 0)])
    update()
    update()
    add([("c", 2)])
    update()
    got = spark.read.parquet(log)
    counts = got.where("event_type = 'ROW_COUNT'")
    assert sorted((r.batch, r.row_count_output) for r in counts.collect())[2] == (2, 1)
    assert counts.agg(F.sum("row_count_output")).first()[0] == 4 and counts.count() == 3
    failed = {}
    for r in got.where("event_type = 'DQ_CHECK'").collect():
        m = json.loads(r.extra_metrics)
        failed[m["check"]] = failed.get(m["check"], 0) + m["failed"]
        assert r.log_level == ("INFO" if m["failed"] == 0 else "WARNING")
    assert failed == {"id": 1, "qty": 2}


def test_facts_are_logged_where_they_are_written(spark, tmp_path):
    put(spark, tmp_path, [("1", "9", "5", "1/5/2024", "0"), ("1", "9", "5", "1/5/2024", "0")])
    with Watch(spark, f"{tmp_path}/log") as watch:
        run(spark, tmp_path, watch=watch)
    got = spark.read.parquet(f"{tmp_path}/log")
    assert rows(got.where("event_type = 'ROW_COUNT'").select("table_name", "row_count_output")) == [
        ("transactions", 1)]
    [check] = [json.loads(r[0]) for r in got.where("event_type = 'DQ_CHECK'").select("extra_metrics").collect()
               if json.loads(r[0])["check"] == "valid_quantity"]
    assert check == {"check": "valid_quantity", "passed": False, "failed": 1, "rows": 1}


def test_a_failing_log_is_not_silent(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/in")
    (tmp_path / "log").write_text("in the way")
    with pytest.raises(Exception), Watch(spark, f"{tmp_path}/log") as watch:
        stream = watch.observed(tables.parquet_stream(spark, f"{tmp_path}/in"), "silver", "t", {})
        jobs.run_append(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
