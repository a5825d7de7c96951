import datetime as dt
import json
import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from larder.operators import quality, scd2
from larder.plans import silver
from larder.sources import tables
from larder.streaming import jobs, scd2_apply

T = dt.datetime(2024, 1, 1)


class Feed:
    """A landed table to which tests add files, and a job that runs over it."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, str(path), schema

    def add(self, made):
        self.spark.createDataFrame(made, self.schema).coalesce(1).write.mode("append").parquet(
            f"{self.path}/in")

    def stream(self, max_files=None):
        return tables.parquet_stream(self.spark, f"{self.path}/in", max_files)

    def append(self, build):
        out = build(self.stream(1))
        query = jobs.run_append(out, f"{self.path}/out", f"{self.path}/checkpoint")
        return self.spark.read.schema(out.schema).parquet(f"{self.path}/out"), query


def order(i, minute, quantity=1):
    at = T + dt.timedelta(minutes=minute)
    return (json.dumps({"order_id": f"O{i}", "product_id": 1, "customer_id": 1, "store_id": 1,
                        "quantity": quantity}), at)


def test_order_stream_drops_copies_and_late_rows(spark, tmp_path):
    feed = Feed(spark, tmp_path, "raw_payload STRING, timestamp TIMESTAMP")
    feed.add([order(1, 0), order(1, 0), order(1, 1)])
    got, _ = feed.append(jobs.orders)
    assert rows(got.select("order_id")) == [("O1",), ("O1",)]
    feed.add([order(1, 1), order(2, 60)])
    feed.append(jobs.orders)
    feed.add([order(3, 40), order(4, 55)])
    got, query = feed.append(jobs.orders)
    assert sorted(r.order_id for r in got.collect()) == ["O1", "O1", "O2", "O4"]
    assert sum(s["numRowsDroppedByWatermark"]
               for p in query.recentProgress for s in p["stateOperators"]) == 1


def stock(i, minute, left=5):
    at = T + dt.timedelta(minutes=minute)
    return (json.dumps({"inventory_id": f"I{i}", "event_timestamp": str(at), "product_id": 1,
                        "store_id": 1, "quantity_remaining": left}), at)


@pytest.mark.parametrize("bounded,left", [(True, 1), (False, 3)])
def test_inventory_state_is_bounded_unless_asked(spark, tmp_path, bounded, left):
    feed = Feed(spark, tmp_path, "raw_payload STRING, timestamp TIMESTAMP")
    for made in ([stock(1, 0), stock(1, 0)], [stock(2, 60)], [stock(3, 120)]):
        feed.add(made)
        got, query = feed.append(lambda s: jobs.inventory(s, bounded=bounded))
    assert rows(got.select("inventory_id")) == [("I1",), ("I2",), ("I3",)]
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == left


def test_csv_stream_equals_batch(spark, tmp_path):
    feed = Feed(spark, tmp_path, "product_id STRING, customer_id STRING, store_id STRING, "
                                 "transaction_date STRING, quantity STRING")
    rng = random.Random(5)
    for _ in range(3):
        made = [(str(rng.randrange(4)), "1", "1", f"1/{rng.randrange(1, 4)}/2024", "2")
                for _ in range(30)]
        feed.add(made)
    got, _ = feed.append(lambda s: jobs.csv_table(s, "transactions"))
    batch = silver.silver_csv(spark.read.parquet(f"{tmp_path}/in"), "transactions")
    columns = ["product_id", "transaction_date", "quantity", "record_status"]
    assert rows(got.select(*columns)) == rows(batch.select(*columns))


def test_split_is_complete_and_repeatable(spark, tmp_path):
    feed = Feed(spark, tmp_path, "order_id STRING, product_id INT, customer_id INT, "
                                 "store_id INT, quantity INT")
    for start in (0, 10, 20):
        feed.add([(f"o{i}", 1, 1, 1, i % 3 - 1 if i % 7 else None)
                  for i in range(start, start + 10)])
    out = f"{tmp_path}/split"
    jobs.run_split(feed.stream(1), quality.ORDER_RULES, out, f"{tmp_path}/c")
    batch = spark.read.parquet(f"{tmp_path}/in")

    def check():
        good, bad = jobs.read_split(spark, out)
        assert rows(good.select(*batch.columns)) == rows(quality.valid(batch, quality.ORDER_RULES))
        assert good.count() + bad.count() == 30
        assert bad.where(f"{quality.REASON} = ''").count() == 0

    check()
    jobs.run_split(feed.stream(1), quality.ORDER_RULES, out, f"{tmp_path}/c2")
    check()


@pytest.mark.parametrize("ignore_nulls", [True, False])
def test_streamed_history_equals_batch_history(spark, tmp_path, ignore_nulls):
    """Late, repeated and same-instant changes over several batches, each applied twice."""
    schema = "k STRING, at TIMESTAMP, pos INT, a STRING, b INT"
    rng = random.Random(11)
    batches = []
    for n in range(4):
        low = 0 if n == 2 else n * 100
        batches.append([
            (rng.choice(["x", "y", "z", None][: n + 1]),
             T + dt.timedelta(minutes=low + rng.randrange(120)), n * 100 + i,
             rng.choice(["p", "q", None]), rng.choice([1, 2, None]))
            for i in range(25)])
    spec = scd2.Spec(["k"], "at", ["a"], ignore_nulls, ["pos"])
    path = f"{tmp_path}/h"
    for n, made in enumerate(batches):
        df = spark.createDataFrame(made, schema)
        for _ in range(2):
            scd2_apply.apply_changes(df, n, spec, path)
    whole = spark.createDataFrame([c for made in batches for c in made], schema)
    want = rows(scd2.history(whole, spec))
    got = scd2_apply.read_history(spark, path, spec)
    assert rows(got.select("k", "a", "b", scd2.START, scd2.END)) == want
    cuts = spark.read.parquet(f"{path}/touched").where("__late").count()
    assert cuts > 0, "the feed should exercise late changes"


def test_history_of_many_batches_reads_a_bounded_part(spark, tmp_path, monkeypatch):
    """Files and bytes that a batch looks for open versions in do not grow with the batches."""
    monkeypatch.setattr(scd2_apply, "FANOUT", 2)
    spec, path, read = scd2.Spec(["k"], "at", ["a"], True, ["pos"]), f"{tmp_path}/h", {}
    rng, changes, schema = random.Random(3), [], "k STRING, at TIMESTAMP, pos INT, a STRING"
    for n in range(9):
        late = n % 4 == 3
        made = [(f"k{i}", T + dt.timedelta(minutes=10 * (n - 3 * late) + rng.randrange(9)), n * 10 + i,
                 rng.choice("pqr")) for i in range(6)]
        changes += made
        df = spark.createDataFrame(made, schema).coalesce(1)
        if n in (4, 8):
            known = scd2_apply.manifest(spark, path, n)
            found = scd2_apply.open_versions(spark, path, spec, known, df.withColumn("bucket", F.lit(0)))
            files = [f.removeprefix("file://") for f in found.inputFiles()]
            read[n] = len(known.state), len(files), sum(os.path.getsize(f) for f in files)
            assert found.count() == 6
        for _ in range(1 + (n == 5)):  # a repeated batch also merges again
            scd2_apply.apply_changes(df, n, spec, path)
    assert read[8][:2] == read[4][:2] and read[8][2] <= 1.2 * read[4][2]
    runs = scd2_apply.manifest(spark, path)
    assert runs.state == ((0, 7, 2), (8, 8, 0)) and runs.history == ((0, 7, 3), (8, 8, 0))
    # those of the manifest before stay for its readers
    assert all(len(os.listdir(f"{path}/{t}")) == 2 for t in ("changes", "touched", "versions", "state"))
    want = rows(scd2.history(spark.createDataFrame(changes, schema), spec))
    assert rows(scd2_apply.read_history(spark, path, spec).select("k", "a", scd2.START, scd2.END)) == want


def test_observed_rules_in_a_stream(spark, tmp_path):
    feed = Feed(spark, tmp_path, "order_id STRING, quantity INT")
    feed.add([("a", 1), (None, 0)])
    feed.add([("b", 0)])
    rules = {"id": "order_id IS NOT NULL", "qty": "quantity > 0"}
    _, query = feed.append(lambda s: quality.observe_rules(s, rules))
    seen = [p["observedMetrics"]["expectations"] for p in query.recentProgress
            if p["observedMetrics"]]
    assert sum(s["rows"] for s in seen) == 3
    assert (sum(s["id"] for s in seen), sum(s["qty"] for s in seen)) == (1, 2)
