import brute
import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from samples import docs, rows, texts  # noqa: F401
from larder.llm.common import stored
from larder.llm.queries import ORACLE, QUERIES


def test_queries_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and len(QUERIES) == 11


def test_chat_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    df = QUERIES["op3_chat_format"](spark, folder)
    want = con.execute(ORACLE["op3_chat_format"])
    names = [d[0] for d in want.description]
    assert sorted(map(tuple, df.select(names).collect())) == sorted(want.fetchall())


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    known = docs.selectExpr("doc_id", "text", "if(doc_id % 2 = 0, 'a', 'b') AS lang", "'s' AS source",
                            "length(text) AS n_chars", *(c for c in docs.columns if c not in ("doc_id", "text")))
    known.write.parquet(f"{path}/documents.parquet")
    item = " ".join(dict(texts())[25].split()[5:35])
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(
        f"{path}/benchmark.parquet")
    return str(path)


def test_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, ids = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, folder), name)
        ids.append({r["doc_id"] for r in docs.select("doc_id").collect()})
        if name != "encoded":
            assert docs.columns == columns, name
    assert {6, 7, 8} & ids[0] == set() and len(ids[0]) >= 33
    assert {2, 3, 4, 14} & ids[1] == set() and {0, 1, 5, 9, 11, 12, 19} <= ids[1] and 20 not in ids[1]
    assert 25 in ids[2] and 25 not in ids[3] and {0, 1, 9, 24, 26} <= ids[4]
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    kept = [(d, text[d]) for d in sorted(ids[1])]
    want = {d: n for d, (n, gone, _) in brute.repeats(kept).items() if gone == 0}
    got = {r["doc_id"]: r for r in docs.collect()}
    for d in want.keys() & got.keys():
        assert got[d]["ids"] == brute.byte_bpe([text[d]])[0] and got[d]["n_tokens"] == len(got[d]["ids"])


def test_stages_of_an_empty_table_and_repeated_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    none = docs.filter("doc_id < 0")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0, name
    some = docs.filter("doc_id in (1, 2, 9)")
    twice = some.unionByName(some).unionByName(some.selectExpr("CAST(NULL AS BIGINT) AS doc_id", *docs.columns[1:]))
    left = [r["doc_id"] for r in corpus_pipeline.near_copies(spark, twice, folder).collect()]
    assert sorted(x for x in left if x is not None) == [1, 9] and left.count(None) == 3
