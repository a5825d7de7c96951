"""History against a row-by-row model, for many shapes of feeds."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from larder.operators import scd2

SCHEMA = "k STRING, at TIMESTAMP, pos INT, a STRING, b INT, c STRING"
BASE = dt.datetime(2024, 1, 1)


def model(changes, ignore_nulls, tracked):
    """One pass over the ordered changes of each key."""
    out, keys = [], {c[0] for c in changes}
    for key in keys:
        mine = sorted((c for c in changes if c[0] == key), key=lambda c: (c[1], c[2]))
        state, versions = [None] * 3, []
        for i, change in enumerate(mine):
            values = list(change[3:])
            state = [old if v is None and ignore_nulls else v for old, v in zip(state, values)]
            if i + 1 < len(mine) and mine[i + 1][1] == change[1]:
                continue
            if not versions or any(versions[-1][0][t] != state[t] for t in tracked):
                if versions:
                    versions[-1][2] = change[1]
                versions.append([list(state), change[1], None])
            versions[-1][0] = list(state)
        out += [(key, *values, start, end) for values, start, end in versions]
    return sorted(out, key=lambda r: tuple(map(str, r)))


def feed(seed, n, keys, span, hot=None):
    rng = random.Random(seed)
    made = []
    for i in range(n):
        key = hot if hot is not None and rng.random() < 0.6 else rng.choice(keys)
        made.append((key, BASE + dt.timedelta(minutes=rng.randrange(span)), i,
                     rng.choice(["x", "y", None]), rng.choice([1, 2, 3, None]),
                     rng.choice(["p", "q", None])))
    return made


@pytest.mark.parametrize("ignore_nulls", [True, False])
@pytest.mark.parametrize("seed,n,span,hot,hot_rows", [
    (1, 60, 500, None, 10_000), (2, 200, 2000, "h", 20), (3, 200, 40, "h", 12),
    (4, 150, 5000, None, 4), (5, 120, 3000, "null", 10),
])
def test_history(spark, ignore_nulls, seed, n, span, hot, hot_rows):
    changes = feed(seed, n, ["k1", "k2", "k3", "h"], span, hot)
    if hot == "null":
        changes = [(None if c[0] == "null" else c[0], *c[1:]) for c in changes]
    spec = scd2.Spec(["k"], "at", ["a", "b"], ignore_nulls, ["pos"])
    got = scd2.history(spark.createDataFrame(changes, SCHEMA), spec, hot_rows)
    assert got.columns == ["k", "a", "b", "c", scd2.START, scd2.END]
    assert rows(got) == model(changes, ignore_nulls, [0, 1])


def test_latest_state_is_the_open_version(spark):
    df = spark.createDataFrame(feed(9, 200, ["k1", "k2"], 900, "h"), SCHEMA)
    for ignore_nulls in (True, False):
        spec = scd2.Spec(["k"], "at", ["a"], ignore_nulls, ["pos"])
        opened = scd2.current(scd2.history(df, spec)).select("k", "a", "b", "c")
        assert rows(scd2.latest_state(df, spec)) == rows(opened)


def test_without_tie_break_the_result_does_not_depend_on_row_order(spark):
    made = feed(7, 150, ["k1", "k2"], 60, "h")
    for ignore_nulls in (True, False):
        spec = scd2.Spec(["k"], "at", ["a", "b"], ignore_nulls)
        results = []
        for order in (made, made[::-1], sorted(made, key=str)):
            df = spark.createDataFrame(order, SCHEMA).drop("pos").repartition(3)
            results.append(rows(scd2.history(df, spec, hot_rows=25)))
            opened = scd2.current(scd2.history(df, spec)).select("k", "a", "b", "c")
            assert rows(scd2.latest_state(df, spec)) == rows(opened)
        assert results[0] == results[1] == results[2]


def test_untracked_values_are_overwritten_in_place(spark):
    df = spark.createDataFrame([
        ("k", BASE, 0, "x", 1, "p"), ("k", BASE + dt.timedelta(1), 1, "x", 1, "q")], SCHEMA)
    spec = scd2.Spec(["k"], "at", ["a", "b"], tie_break=["pos"])
    assert rows(scd2.history(df, spec)) == [("k", "x", 1, "q", BASE, None)]


def test_integer_and_date_sequences(spark):
    df = spark.range(40).select(
        F.lit("k").alias("k"), F.col("id").alias("n"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).alias("d"),
        (F.col("id") / 3).cast("int").alias("v"))
    by_number = scd2.history(df.drop("d"), scd2.Spec(["k"], "n", ["v"]), hot_rows=8)
    by_date = scd2.history(df.drop("n"), scd2.Spec(["k"], "d", ["v"]), hot_rows=8)
    assert by_number.count() == by_date.count() == 14
    assert {(r[scd2.START], r[scd2.END]) for r in by_number.where("v = 4").collect()} == {(12, 15)}


BURST = ["id", "CASE WHEN id % 10 = 0 THEN id * 1000000 ELSE 5000000000 + id END AS at"]


@pytest.mark.parametrize("hot_rows", [400, 4_000])
@pytest.mark.parametrize("kind", ["BIGINT", "STRING", "DECIMAL(30,3)", "TIMESTAMP", "DOUBLE"])
def test_slices_of_a_burst_have_equal_depth(spark, kind, hot_rows):
    """Nine changes in ten lie in a millionth of the time line."""
    cast = {"STRING": "lpad(CAST(at AS STRING), 15, '0')",
            "TIMESTAMP": "timestamp_micros(at)"}.get(kind, f"CAST(at AS {kind})")
    df = spark.range(20_000).selectExpr(*BURST).selectExpr(
        "IF(id % 1000 = 0, 'cold', 'hot') AS k", f"{cast} AS at", "id DIV 7 % 3 AS v")
    spec = scd2.Spec(["k"], "at", ["v"])
    keyed = df.withColumn(scd2._KEY, F.struct("k"))
    sliced = scd2._slices(keyed, spec, hot_rows).groupBy("k", scd2._SLICE, scd2._HOT).agg(
        F.count("*").alias("n"), F.min("at").alias("lo"), F.max("at").alias("hi")).collect()
    hot = sorted((r for r in sliced if r.k == "hot"), key=lambda r: r[scd2._SLICE])
    assert len(hot) >= 19_980 * 4 // hot_rows // 2 and all(r[scd2._HOT] for r in hot)
    assert max(r.n for r in hot) <= 2 * min(r.n for r in hot)
    assert all(a.hi < b.lo for a, b in zip(hot, hot[1:]))
    assert [(r[scd2._SLICE], r[scd2._HOT]) for r in sliced if r.k == "cold"] == [(0, False)]
    if hot_rows == 4_000:
        whole, cut = (scd2.history(df, spec, n) for n in (1 << 30, hot_rows))
        assert whole.exceptAll(cut).isEmpty() and cut.exceptAll(whole).isEmpty()


def test_the_feed_is_shuffled_twice_and_summaries_read_hot_keys_only(spark):
    df = spark.createDataFrame(feed(1, 50, ["k1"], 100), SCHEMA)
    spec = scd2.Spec(["k"], "at", ["a"], tie_break=["pos"])
    plan = scd2.history(df, spec)._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan and plan.count("Join Inner") >= 2
