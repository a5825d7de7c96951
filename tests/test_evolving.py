import json

import pytest
from conftest import rows

from larder.sources import evolving
from larder.streaming import jobs
from test_sources import put


def land(spark, tmp_path, **options):
    query = evolving.run_landing(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/checkpoint", **options)
    return evolving.read(spark, f"{tmp_path}/out"), query


def test_a_new_column_in_another_place(spark, tmp_path):
    put(f"{tmp_path}/in", "a.csv", "id,name\n1,x\n2,\n\n")
    got, _ = land(spark, tmp_path)
    assert got.columns[:2] == ["id", "name"]
    put(f"{tmp_path}/in", "b.csv", "﻿extra,ID\n\"p,q\",3\n,4\n5\n")
    put(f"{tmp_path}/in", "c.csv", "name,id,id,\nz,6,7,8\n")
    got, _ = land(spark, tmp_path)
    assert rows(got.select("id", "name", "extra", "id2", "_c3", evolving.RESCUED, "source_file_name")) == sorted([
        ("1", "x", None, None, None, None, "a.csv"), ("2", None, None, None, None, None, "a.csv"),
        ("3", None, "p,q", None, None, None, "b.csv"), ("4", None, None, None, None, None, "b.csv"),
        (None, None, "5", None, None, None, "b.csv"), ("6", "z", None, "7", "8", None, "c.csv")],
        key=lambda r: tuple(map(str, r)))
    assert evolving.known_columns(spark, f"{tmp_path}/out")[:2] == ["id", "name"]
    assert got.where("ingestion_timestamp IS NULL OR _source_system <> 'adls'").count() == 0
    assert rows(evolving.files(spark, f"{tmp_path}/out").select("rows", "batch")) == [(1, 1), (2, 0), (3, 1)]
    again, _ = land(spark, tmp_path)
    assert again.count() == 6


def test_declared_columns_are_kept_and_others_rescued(spark, tmp_path):
    put(f"{tmp_path}/in", "a.csv", "b,a,_source_system\n2,1,x\n,,\n4,3,y,5,,6\n")
    got, _ = land(spark, tmp_path, columns=["a", "c"], evolve=False)
    assert got.columns[:3] == ["a", "c", evolving.RESCUED]
    saved = {r["a"]: r[evolving.RESCUED] and json.loads(r[evolving.RESCUED]) for r in got.collect()}
    assert saved == {"1": {"b": "2", "_source_system": "x"}, None: None,
                     "3": {"b": "4", "_source_system": "y", "_c3": "5", "_c5": "6"}}


def test_large_files_have_one_header(spark, tmp_path):
    """Splits of a file that do not hold its header; lines that look like it are data."""
    put(f"{tmp_path}/in", "a.csv", "id,name\n" + "".join(f"{i},name\n" for i in range(3_000)) + "id,name\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got, _ = land(spark, tmp_path)
        assert got.count() == 3_001 and got.where("id = 'id'").count() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_small_micro_batches_and_header_only_files(spark, tmp_path):
    for i, text in enumerate(["a\n", "b,a\n1,2\n", "a,b,c\n3,4,5\n"]):
        put(f"{tmp_path}/in", f"{i}.csv", text)
    got, query = land(spark, tmp_path, max_files=1)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert rows(got.select("a", "b", "c")) == [("2", "1", None), ("3", "4", "5")]


def test_a_lost_checkpoint_stops_the_start(spark, tmp_path):
    put(f"{tmp_path}/in", "a.csv", "id\n1\n")
    land(spark, tmp_path)
    with pytest.raises(jobs.LostCheckpoint):
        evolving.run_landing(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/new")
    with pytest.raises(jobs.LostCheckpoint):
        evolving.run_landing(spark, f"{tmp_path}/in", f"{tmp_path}/other", f"{tmp_path}/checkpoint")
    assert land(spark, tmp_path)[0].count() == 1
