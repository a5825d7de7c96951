import os

import pytest
from conftest import rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from larder.operators import checks
from larder.sources import files, lineage, tables, topics
from larder.streaming import jobs


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as out:
        out.write(text)


def landed(spark, tmp_path, columns, run="run"):
    stream = files.csv_stream(spark, f"{tmp_path}/in", columns)
    jobs.run_append(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{tmp_path}/out")


def test_csv_stream_takes_new_files_only(spark, tmp_path):
    put(f"{tmp_path}/in", "a.csv", "transaction_id,product_id,quantity\n1,10,5\n2,20,\n")
    first = landed(spark, tmp_path, ["transaction_id", "product_id", "quantity"])
    assert rows(first.select("transaction_id", "quantity", "source_file_name",
                             "_source_system")) == [
        ("1", "5", "a.csv", "adls"), ("2", None, "a.csv", "adls")]
    put(f"{tmp_path}/in", "b.csv", "transaction_id,product_id,quantity\n1,10,5\n")
    again = landed(spark, tmp_path, ["transaction_id", "product_id", "quantity"])
    assert again.count() == 3 and again.where("ingestion_timestamp IS NULL").count() == 0
    assert {r[0].rsplit("/", 1)[1] for r in again.select("source_file_path").collect()} == {
        "a.csv", "b.csv"}


def test_another_column_order_is_rejected(spark, tmp_path):
    put(f"{tmp_path}/in", "a.csv", "b,a\n1,2\n")
    with pytest.raises(StreamingQueryException):
        landed(spark, tmp_path, ["a", "b"])
    with pytest.raises(Exception, match="header"):
        files.csv_batch(spark, f"{tmp_path}/in", ["a", "b"]).collect()


def test_header_only_file(spark, tmp_path):
    put(f"{tmp_path}/in", "a.csv", "id,value\n")
    assert landed(spark, tmp_path, ["id", "value"]).count() == 0


def test_evolving_headers(spark, tmp_path):
    put(f"{tmp_path}/x", "a.csv", "id\n1\n")
    put(f"{tmp_path}/x/y", "b.csv", "new_col,id\nhello,2\n")
    put(f"{tmp_path}/x", "c.csv", "id\n3")
    got = files.csv_evolving(spark, f"{tmp_path}/x")
    assert got.columns == ["id", "new_col"]
    assert rows(got) == [("1", None), ("2", "hello"), ("3", None)]
    with pytest.raises(FileNotFoundError):
        put(f"{tmp_path}/none", "_SUCCESS", "")
        files.csv_evolving(spark, f"{tmp_path}/none")


def test_corrupt_lines_are_kept(spark, tmp_path):
    put(f"{tmp_path}/c", "a.csv", "id,v\n1,2\n3,4,5\n6\n")
    got = files.csv_batch(spark, f"{tmp_path}/c", ["id", "v"], corrupt=True)
    assert rows(got) == [("1", "2", None), ("3", "4", "3,4,5"), ("6", None, "6")]
    assert dict(files.csv_inferred(spark, f"{tmp_path}/c").dtypes) == {"id": "int", "v": "int"}


def test_corrupt_lines_in_a_stream(spark, tmp_path):
    put(f"{tmp_path}/in", "a.csv", "id,v\n1,2\n3,4,5\n")
    stream = files.csv_stream(spark, f"{tmp_path}/in", ["id", "v"], corrupt=True)
    jobs.run_append(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    got = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out")
    assert rows(got.select("id", "v", files.CORRUPT)) == [
        ("1", "2", None), ("3", "4", "3,4,5")]
    assert checks.corrupt_rows(got, files.CORRUPT).count() == 1


def test_lineage_keeps_rows_as_they_are(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, "x")], "a INT, b STRING")
    got = lineage.landed(df, lineage.DOCUMENTS)
    assert got.columns == ["a", "b", "ingestion_timestamp", "_source_system"]
    assert rows(got.select("a", "b")) == rows(df)
    assert lineage.landed(df.where("false"), lineage.FILES).count() == 0


def test_topic_rows(spark):
    records = spark.sql("""SELECT CAST('k' AS BINARY) AS key, CAST('{"a":1}' AS BINARY) AS value,
        'orders' AS topic, 0 AS partition, 7L AS offset, current_timestamp() AS timestamp,
        0 AS timestampType""")
    got = topics.raw_payloads(records)
    assert got.columns == ["raw_payload", "topic", "partition", "offset", "timestamp",
                           "ingestion_timestamp", "_source_system"]
    assert got.first().raw_payload == '{"a":1}'


def test_kafka_needs_its_package(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        topics.kafka_stream(spark, "nowhere:1", "orders")


def test_document_stream(spark, tmp_path):
    spark.createDataFrame([("1", "{}")], "_id STRING, data STRING").write.mode(
        "overwrite").saveAsTable("docs")
    stream = tables.document_stream(spark, "docs")
    jobs.run_append(stream, f"{tmp_path}/o", f"{tmp_path}/c")
    got = spark.read.parquet(f"{tmp_path}/o")
    assert rows(got.select("_id", "_source_system")) == [("1", "fivetran")]


def test_partitioned_overwrite(spark, tmp_path):
    df = spark.range(1000).withColumn("day", F.when(F.col("id") < 700, 1).otherwise(2))
    for _ in range(2):
        tables.overwrite(df, f"{tmp_path}/t", ("day",))
    assert spark.read.parquet(f"{tmp_path}/t").where("day = 1").count() == 700
