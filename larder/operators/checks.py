"""Validation as data: each check returns the violating rows or a summary row.

Checks group before they join, so a key that holds a large part of a table is one row
by the time it is matched.  Totals of several tables are combined by a union and an
aggregation; nothing is multiplied out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from larder.operators.scd2 import END, START

TOLERANCE = 0.01


def _rows(name: str = "n_rows") -> Column:
    return F.count(F.lit(1)).alias(name)


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# -- one table ---------------------------------------------------------------------

def profile(df: DataFrame, key: str, required: Sequence[str] = (),
            positive: Sequence[str] = ()) -> DataFrame:
    """One row: row count, NULLs per required column, non-positive values, surplus keys."""
    per_key = df.groupBy(key).agg(
        _rows("__n"),
        *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required),
        *(F.count_if(F.col(c) <= 0).alias(f"not_positive_{c}") for c in positive),
    )
    sums = [c for c in per_key.columns if c not in (key, "__n")]
    total = F.coalesce(F.sum("__n"), F.lit(0))
    return per_key.agg(
        total.alias("n_rows"),
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums),
        (total - F.count(F.lit(1))).alias("surplus_keys"),
    )


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(_rows()).where("n_rows > 1")


def duplicate_ratio(df: DataFrame, keys: Sequence[str], limit: float = 0.1) -> DataFrame:
    """One row: duplicate groups against all rows, and whether that is within the limit."""
    return df.groupBy(*keys).agg(_rows("__n")).agg(
        F.sum("__n").alias("n_rows"),
        F.count_if(F.col("__n") > 1).alias("duplicate_groups"),
    ).withColumn("within_limit", F.col("duplicate_groups") <= F.col("n_rows") * limit)


def unique_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: all rows, distinct keys, and whether they agree."""
    return df.groupBy(*keys).agg(_rows("__n")).agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
    ).withColumn("is_unique", F.col("n_rows") == F.col("n_keys"))


def unexpected_tags(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values outside the allowed list, with their count."""
    return df.groupBy(column).agg(_rows()).where(~F.col(column).isin(*allowed))


def out_of_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.where((F.col(column) < low) | (F.col(column) > high))


def corrupt_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows with rescued text; none when the table has no such column."""
    return df.where(F.col(column).isNotNull() if column in df.columns else F.lit(False))


def schema_drift(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """One row per expected or present column: type wanted, type found, values present."""
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def status(name: str) -> str:
        if name not in found:
            return "missing"
        if name not in expected:
            return "added"
        return "ok" if found[name] == expected[name] else "retyped"

    names = [*expected, *(n for n in found if n not in expected)]
    counts = df.agg(*(F.count(n).alias(n) for n in found))
    lines = F.array(*(
        F.struct(
            F.lit(n).alias("column_name"),
            F.lit(expected.get(n)).cast("string").alias("expected_type"),
            F.lit(found.get(n)).cast("string").alias("actual_type"),
            F.lit(status(n)).alias("status"),
            (F.col(n) if n in found else F.lit(0).cast("bigint")).alias("n_values"),
        ) for n in names))
    return counts.select(F.explode(lines).alias("line")).select("line.*")


# -- two tables --------------------------------------------------------------------

def orphan_rows(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """The rows whose key the parent does not have, NULL keys included."""
    return df.join(parent.select(key).distinct(), key, "left_anti")


def orphan_keys(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Keys the parent does not have, with the number of rows they hold."""
    return df.groupBy(key).agg(_rows()).join(
        parent.select(key).distinct(), key, "left_anti")


def missing_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key values of ``df`` that ``other`` does not have; NULLs compare equal.

    Both sides are made distinct first: EXCEPT alone would move every row of a fact before
    it drops the copies.
    """
    return df.select(*keys).distinct().subtract(other.select(*keys).distinct())


def join_gaps(df: DataFrame, parent: DataFrame, key: str, attribute: str) -> DataFrame:
    """Per key, rows that find no parent or one without the attribute."""
    counted = df.groupBy(key).agg(_rows())
    joined = counted.join(parent.select(key, attribute), key, "left")
    return joined.where(F.col(attribute).isNull()).select(key, "n_rows")


def _totals(tables: Mapping[str, DataFrame], measure: Column) -> DataFrame:
    """One row with one total per table."""
    parts = [
        df.agg(measure.alias("v")).select(F.lit(name).alias("t"), "v")
        for name, df in tables.items()
    ]
    return _stack(parts).agg(
        *(F.max(F.when(F.col("t") == name, F.col("v"))).alias(name) for name in tables))


def count_at_most(lower: DataFrame, upper: DataFrame) -> DataFrame:
    """One row: the upper layer has no more rows than the layer it is made from."""
    counts = _totals({"lower_rows": lower, "upper_rows": upper}, F.count(F.lit(1)))
    return counts.withColumn("reconciles", F.col("upper_rows") <= F.col("lower_rows"))


def count_at_least(source: DataFrame, landed: DataFrame) -> DataFrame:
    """One row: at least as many rows landed as the source has."""
    counts = _totals({"source_rows": source, "landed_rows": landed}, F.count(F.lit(1)))
    return counts.withColumn("reconciles", F.col("landed_rows") >= F.col("source_rows"))


def files_agree(source: DataFrame, landed: DataFrame, source_file: Column, landed_file: Column,
                source_sum: Column, landed_sum: Column, tolerance: float = 1.0) -> DataFrame:
    """One row per file: what it holds at the source and what landed of it.

    ``source_file`` and ``landed_file`` name the file of a row; the sums are of one measure in
    each table's own type.  A file that never landed, or landed and is gone from the source,
    has no rows on the other side and does not reconcile.
    """
    def side(df: DataFrame, file: Column, total: Column, name: str) -> DataFrame:
        return df.groupBy(file.alias("file")).agg(
            _rows(f"{name}_rows"), F.sum(total).cast("double").alias(f"{name}_sum"))

    both = side(source, source_file, source_sum, "source").unionByName(
        side(landed, landed_file, landed_sum, "landed"), allowMissingColumns=True)
    one = both.groupBy("file").agg(*(
        F.coalesce(F.max(c), F.lit(0)).alias(c)
        for c in ("source_rows", "landed_rows", "source_sum", "landed_sum")))
    return one.withColumn("reconciles", (F.col("source_rows") == F.col("landed_rows")) & (
        F.abs(F.col("source_sum") - F.col("landed_sum")) <= tolerance))


def split_is_complete(raw: DataFrame, valid: DataFrame, quarantined: DataFrame) -> DataFrame:
    """One row: every input row went to exactly one side."""
    counts = _totals({"raw_rows": raw, "valid_rows": valid, "quarantined_rows": quarantined},
                     F.count(F.lit(1)))
    whole = F.col("valid_rows") + F.col("quarantined_rows")
    return counts.withColumn("complete", F.col("raw_rows") == whole)


def sums_agree(lower: DataFrame, upper: DataFrame, measure: Column,
               tolerance: float = 1.0, relative: float = 0.0) -> DataFrame:
    """One row: two totals and whether they differ by no more than the tolerance."""
    sums = _totals({"lower_sum": lower, "upper_sum": upper}, measure)
    allowed = F.greatest(F.lit(tolerance), F.abs("lower_sum") * F.lit(relative))
    return sums.withColumn(
        "reconciles", F.abs(F.col("lower_sum") - F.col("upper_sum")) <= allowed)


# -- measures ----------------------------------------------------------------------

def _differs(left: Column, right: Column) -> Column:
    return F.abs(left - right) > F.lit(TOLERANCE)


def wrong_sales_measures(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Sales whose revenue, cost or profit does not follow from quantity and price."""
    priced = sales.join(
        products.select("product_id", "product_retail_price", "product_cost"), "product_id")
    quantity = F.col("quantity")
    wrong = {
        "revenue": _differs(F.col("total_revenue"), quantity * F.col("product_retail_price")),
        "cost": _differs(F.col("total_cost"), quantity * F.col("product_cost")),
        "profit": _differs(F.col("total_profit"),
                           F.col("total_revenue") - F.col("total_cost")),
    }
    named = F.concat_ws(", ", *(F.when(w, F.lit(n)) for n, w in wrong.items()))
    return priced.withColumn("wrong_measures", named).where(
        F.col("wrong_measures") != "").select(*sales.columns, "wrong_measures")


def wrong_return_amounts(returns: DataFrame, products: DataFrame) -> DataFrame:
    priced = returns.join(products.select("product_id", "product_retail_price"), "product_id")
    expected = F.col("return_quantity") * F.col("product_retail_price")
    return priced.where(_differs(F.col("return_amount"), expected)).select(*returns.columns)


def wrong_averages(daily: DataFrame) -> DataFrame:
    mean = F.col("total_revenue") / F.col("total_transactions")
    return daily.where(F.abs(F.col("avg_transaction_value") - mean) > TOLERANCE)


# -- history -----------------------------------------------------------------------

def not_one_open_version(versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with open versions, but not exactly one."""
    opened = versions.where(F.col(END).isNull()).groupBy(*keys)
    return opened.agg(_rows("open_versions")).where("open_versions <> 1")


def reversed_intervals(versions: DataFrame) -> DataFrame:
    return versions.where(F.col(START) > F.col(END))


def overlapping_versions(versions: DataFrame, keys: Sequence[str],
                         slice_by: Column | None = None) -> DataFrame:
    """Starts of closed versions at which an earlier closed version of the key still runs.

    With starts in order it is enough to know the furthest end of all earlier starts, so
    no pairs are formed.  That running maximum is taken per (key, slice) and the slices'
    own maxima are carried over, so a key with very many versions is not one task's work;
    a slice is a day of starts unless told otherwise.
    """
    day = F.date_trunc("day", F.col(START)) if slice_by is None else slice_by
    starts = (
        versions.where(F.col(END).isNotNull())
        .withColumn("__key", F.struct(*keys))
        .groupBy("__key", day.alias("__slice"), START).agg(F.max(END).alias("__end"))
    )
    across = Window.partitionBy("__key").orderBy("__slice")
    within = Window.partitionBy("__key", "__slice").orderBy(START)
    before = starts.groupBy("__key", "__slice").agg(F.max("__end").alias("__end")).select(
        "__key", "__slice",
        F.max("__end").over(across.rowsBetween(Window.unboundedPreceding, -1))
        .alias("__carried"))
    reach = F.greatest(
        "__carried", F.max("__end").over(within.rowsBetween(Window.unboundedPreceding, -1)))
    checked = starts.join(before, ["__key", "__slice"]).withColumn("runs_until", reach)
    return checked.where(
        (F.col("runs_until") > F.col(START)) & (F.col("__end") > F.col(START))
    ).select("__key.*", START, "runs_until")
