import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from larder.operators import checks

T = dt.datetime(2024, 1, 1)


def hours(n):
    return None if n is None else T + dt.timedelta(hours=n)


def versions(spark, *intervals):
    return spark.createDataFrame(
        [(k, hours(a), hours(b)) for k, a, b in intervals],
        "k STRING, __START_AT TIMESTAMP, __END_AT TIMESTAMP")


def pairs(intervals):
    """All pairs of closed versions, as the check is defined; the later of each."""
    return sorted({
        (kb, hours(sb)) for ka, sa, ea in intervals for kb, sb, eb in intervals
        if ka == kb and None not in (ea, eb) and sa < eb and sb < ea and sa < sb})


def test_overlaps_equal_the_pairwise_definition(spark):
    import random
    rng = random.Random(3)
    made = []
    for _ in range(150):
        start = rng.randrange(300)
        end = None if rng.random() < 0.1 else start + rng.randrange(1, 30)
        made.append((rng.choice("abcd"), start, end))
    got = checks.overlapping_versions(versions(spark, *made), ["k"]).select("k", "__START_AT")
    assert rows(got) == sorted(pairs(made), key=lambda r: tuple(map(str, r)))


def test_touching_and_open_versions_do_not_overlap(spark):
    df = versions(spark, ("a", 0, 5), ("a", 5, 9), ("a", 9, None), ("b", 1, 100))
    assert checks.overlapping_versions(df, ["k"]).count() == 0
    assert checks.not_one_open_version(df, ["k"]).count() == 0
    assert checks.reversed_intervals(versions(spark, ("a", 5, 3))).count() == 1
    twice = df.union(versions(spark, ("a", 20, None)))
    assert rows(checks.not_one_open_version(twice, ["k"])) == [("a", 2)]


def test_orphans_count_null_keys(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k INT")
    parent = spark.createDataFrame([(1,), (1,)], "k INT")
    assert rows(checks.orphan_keys(fact, parent, "k")) == [(2, 1), (None, 1)]
    assert rows(checks.orphan_rows(fact, parent, "k")) == [(2,), (None,)]
    assert rows(checks.missing_keys(fact, parent, ["k"])) == [(2,), (None,)]


def test_profile_and_uniqueness(spark):
    df = spark.createDataFrame([(1, 5), (1, 0), (None, -1), (2, None)], "k INT, v INT")
    [row] = checks.profile(df, "k", ["k", "v"], ["v"]).collect()
    assert row.asDict() == {"n_rows": 4, "null_k": 1, "null_v": 1, "not_positive_v": 2,
                            "surplus_keys": 1}
    [row] = checks.profile(df.where("false"), "k", ["k"], ["v"]).collect()
    assert row.n_rows == 0 and row.surplus_keys == 0
    assert rows(checks.unique_key(df, ["k"])) == [(4, 3, False)]
    assert rows(checks.duplicate_groups(df, ["k"])) == [(1, 2)]
    assert rows(checks.duplicate_ratio(df, ["k"])) == [(4, 1, False)]


def test_reconciliation(spark):
    low, high = spark.range(10), spark.range(8)
    assert rows(checks.count_at_most(low, high)) == [(10, 8, True)]
    assert rows(checks.count_at_least(low, high)) == [(10, 8, False)]
    assert rows(checks.split_is_complete(low, high, spark.range(2))) == [(10, 8, 2, True)]
    total = F.sum("id").cast("double")
    assert rows(checks.sums_agree(low, high, total)) == [(45.0, 28.0, False)]
    assert rows(checks.sums_agree(low, high, total, relative=0.5)) == [(45.0, 28.0, True)]


def test_measures(spark):
    products = spark.createDataFrame(
        [("p", 0.1, 0.05)],
        "product_id STRING, product_retail_price DOUBLE, product_cost DOUBLE")
    sales = spark.createDataFrame(
        [("p", 3, 0.3, 0.15, 0.15), ("p", 3, 0.4, 0.15, 0.25), ("p", 1, 0.1, 0.05, 0.2),
         ("q", 1, 9.0, 1.0, 8.0)],
        "product_id STRING, quantity INT, total_revenue DOUBLE, total_cost DOUBLE, "
        "total_profit DOUBLE")
    wrong = checks.wrong_sales_measures(sales, products)
    assert sorted(r.wrong_measures for r in wrong.collect()) == ["profit", "revenue"]


def test_drift_tags_and_corrupt_rows(spark):
    df = spark.createDataFrame([(1, "x"), (None, "kafka")], "a INT, tag STRING")
    got = {r.column_name: (r.status, r.n_values) for r in
           checks.schema_drift(df, {"a": "bigint", "b": "int"}).collect()}
    assert got == {"a": ("retyped", 1), "b": ("missing", 0), "tag": ("added", 2)}
    assert rows(checks.unexpected_tags(df, "tag", ["kafka"])) == [("x", 1)]
    assert checks.corrupt_rows(df, "_rescued_data").count() == 0
    assert checks.corrupt_rows(df, "a").count() == 1
