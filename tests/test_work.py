"""What queries store, read and deal out, on tables of a few rows."""

import os
from datetime import datetime

import pytest

import __spark_entry__
from acceptance import feeds, landing
from acceptance.registry import QUERIES
from larder import session

AT = datetime(2001, 5, 6)


class SmallLake(feeds.Lake):
    """Own rows in place of a folder; notes what is stored."""

    def __init__(self, spark, **tables):
        super().__init__(spark, "")
        self.tables, self.kept = tables, []

    def table(self, name):
        return self.spark.createDataFrame(self.tables.get(name, []), feeds.SCHEMAS[name])

    def _stored(self, name, df):
        self.kept.append(name)
        return super()._stored(name, df)


@pytest.mark.parametrize("query, kept", [
    ("sql_secure_dim_customer_engineer", ["current-customers"]),
    ("sql_secure_fact_returns_none", ["current-products", "dim-store", "fact-returns"])])
def test_a_secured_view_stores_only_what_it_reads(spark, query, kept):
    lake = SmallLake(spark, customer=[(1, "c", 0, 1.0, "M")], nation=[(0, "N", 0)], region=[(0, "R")])
    assert QUERIES[query](lake).count() == int("customer" in query)
    assert sorted(lake.kept) == kept


def test_a_watched_micro_batch_has_several_files(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(landing, "FILE_ROWS", 10)
    monkeypatch.setattr(landing, "work_dir", lambda spark, label: f"{tmp_path}/{label}")
    lake = SmallLake(
        spark, lineitem=[(i, 7 + i, 3, 1, 5.0, 1.0, 0.0, 0.0, "N", "O", AT) for i in range(1, 81)],
        orders=[(i, i, "O", 1.0, AT, "1") for i in range(1, 81)])
    rows = lake.silver_transactions.count()
    found = landing.streamed_row_counts(lake).collect()
    assert [(r["n_batches"], r["n_events"], r["rows_out"]) for r in found] == [(5, 5, 2 * rows)]
    assert sum(f.endswith(".parquet") for f in os.listdir(tmp_path / "watched" / "in")) == 4 * 5


def test_a_table_to_be_widened_is_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(feeds, "DEALT", 10)
    rows = [(i % 9 or None, f"c{i}", 0, 1.0, "M") for i in range(95)]
    made = SmallLake(spark, customer=rows).dealt("customer")
    assert sorted(map(str, map(tuple, made.collect()))) == sorted(map(str, rows))
    assert made.rdd.getNumPartitions() == 10


def test_first_shuffle_partitions_grow_with_the_stored_input(spark, monkeypatch, tmp_path):
    stated = "spark.sql.files.maxPartitionBytes"
    set_here = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = {name: spark.conf.get(name, None) for name in (*set_here, stated)}
    monkeypatch.setattr(session, "PARTITION_BYTES", 1000)
    spark.conf.set(stated, "7m")
    try:
        for name, size, partitions in (("a", 900, 4), ("b", 12_000, 13), ("c", 0, 25)):
            if size:
                (tmp_path / name).write_bytes(b"x" * size)
            else:  # a link counts as what it points to
                (tmp_path / name).symlink_to(tmp_path / "b")
            monkeypatch.setattr(__spark_entry__, "_open", [])
            __spark_entry__._lake(spark, str(tmp_path))
            shown = [int(spark.conf.get(name).removesuffix("b")) for name in set_here]
            assert shown == [partitions, session.TASK_BYTES]
        assert spark.conf.get(stated) == "7m"
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)
