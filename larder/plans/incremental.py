"""Star schema facts and aggregates that follow late rows, day by day.

``refresh`` recomputes the days it is told of and leaves the files of all others alone:

* ``fact_sales`` and ``fact_returns``, by day;
* ``sales_parts`` and ``returns_parts``, by day: sums and counts per store and product, which
  add up to any longer period;
* ``buyers``, by day: the distinct customers per store and brand, since counts of them do not
  add up;
* ``daily`` by day and ``monthly`` by month, the aggregates without dimension attributes.

A day is always computed from all its rows, never added to, so a refresh that stopped or runs
twice gives the same tables.  What depends on a product (price, cost, brand) is that of the
refresh: ``days_selling`` gives the days that a changed product touches.  Store attributes are
joined when an aggregate is read.

Rows without a date form a day of their own.  Spark replaces only partitions that get a row, and a
day may lose its last one: each refreshed day gets a filler row besides, which ``table`` leaves out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from larder.functions.money import exact_sum
from larder.plans import gold
from larder.session import FREEING, using, work_dir
from larder.sources.tables import overwrite

_FILLER, _PART, _SLICE = "_filler", "_part", "_slice"
_SLICED = (_PART, _SLICE, _FILLER)
_MONEY = ("total_revenue", "total_cost", "total_profit")
# Days (or months) are refreshed together as far as their rows take so many shuffle partitions: what
# is shuffled and kept on the way is on disk for one such group at a time.
GROUP_TASKS = 1024
_SUMS = ", ".join(f"{name} DOUBLE" for name in _MONEY)

# Table: its day (or month) column and the other columns.
TABLES = {
    "fact_sales": ("transaction_date", f"""customer_id STRING, product_id STRING, store_id INT,
        quantity INT, {_SUMS}"""),
    "fact_returns": ("return_date", """product_id STRING, store_id INT, return_quantity INT,
        return_amount DOUBLE"""),
    "sales_parts": ("transaction_date", f"""store_id INT, product_id STRING,
        product_brand STRING, quantity BIGINT, {_SUMS}, lines BIGINT"""),
    "returns_parts": ("return_date", """store_id INT, product_id STRING,
        return_quantity BIGINT"""),
    "buyers": ("transaction_date", "store_id INT, product_brand STRING, customer_id STRING"),
    "daily": ("transaction_date", f"""store_id INT, total_units BIGINT, {_SUMS},
        unique_customers BIGINT, total_transactions BIGINT"""),
    "monthly": ("month_start", f"""store_id INT, product_brand STRING, total_units BIGINT,
        {_SUMS}, unique_customers BIGINT, total_transactions BIGINT"""),
}


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One of ``TABLES`` as the last refresh left it."""
    return _stored(spark, path, name).drop(_PART)


def refresh(spark: SparkSession, path: str, *, sales: DataFrame, returns: DataFrame,
            products: DataFrame, sale_days: DataFrame, return_days: DataFrame,
            by: str = "day") -> None:
    """Recompute the days in the one column of ``sale_days`` and of ``return_days``.

    ``sales`` and ``returns`` are ``gold.fact_sales`` and ``gold.fact_returns`` over all rows;
    of a source that is partitioned by day only the named days are read.  With ``by="month"``
    folders hold months, for tables with few rows a day, and whole months are recomputed; it is
    the same in all refreshes of one ``path``.
    """
    if by not in ("day", "month"):
        raise ValueError(f"by is day or month, not {by}")
    unit = (lambda date: F.trunc(date, "MM")) if by == "month" else F.col
    with using(spark, FREEING):
        sold, back = (_kept(spark, days, unit) for days in (sale_days, return_days))
        for days in (groups := _groups(sold)):
            _refresh_sales(path, sales, products, days, unit, by, len(groups))
        if by == "day":
            months = sold.select(F.trunc("day", "MM").alias("day")).distinct()
            made = _merged(*(_on_days(_stored(spark, path, name), F.trunc(_PART, "MM"), months).withColumn(
                "month_start", F.trunc("transaction_date", "MM")) for name in ("sales_parts", "buyers")),
                ["month_start", "store_id", "product_brand"])
            _replace(path, "monthly", made.withColumn(_PART, F.col("month_start")), months)
        for days in (groups := _groups(back)):
            _refresh_returns(path, returns, days, unit, len(groups))


def _refresh_sales(path: str, sales: DataFrame, products: DataFrame, days: DataFrame,
                   unit: Callable[[str], Column], by: str, groups: int) -> None:
    dealt = _dealt(_branded(_on_days(sales, unit("transaction_date"), days), products), days,
                   unit("transaction_date"), groups)
    try:
        _release(dealt)
        _put(path, "fact_sales", dealt.where(F.coalesce("_copy", F.lit(1)) == 1))
        _put(path, "sales_parts", dealt.groupBy(
            *_SLICED, "transaction_date", "store_id", "product_id", "product_brand").agg(
            F.sum("quantity").alias("quantity"), *(exact_sum(c).alias(c) for c in _MONEY),
            F.count(F.lit(1)).alias("lines")))
        _put(path, "buyers", dealt.where(F.col(_FILLER) | F.col("customer_id").isNotNull()).select(
            *_SLICED, "transaction_date", "store_id", "product_brand", "customer_id").distinct())
        _put(path, "daily", _totals(dealt, "transaction_date", "store_id"))
        if by == "month":
            _put(path, "monthly", _totals(dealt.withColumn(
                "month_start", F.trunc("transaction_date", "MM")), "month_start", "store_id", "product_brand"))
    finally:
        dealt.unpersist()


def _refresh_returns(path: str, returns: DataFrame, days: DataFrame, unit: Callable[[str], Column],
                     groups: int) -> None:
    dealt = _dealt(_on_days(returns, unit("return_date"), days), days, unit("return_date"), groups)
    try:
        _release(dealt)
        _put(path, "fact_returns", dealt)
        _put(path, "returns_parts", dealt.groupBy(
            *_SLICED, "return_date", "store_id", "product_id").agg(
            F.sum("return_quantity").alias("return_quantity")))
    finally:
        dealt.unpersist()


# -- aggregates, column for column those of ``gold`` --------------------------------

def agg_daily_sales(spark: SparkSession, path: str, stores: DataFrame) -> DataFrame:
    mean = F.round(F.col("total_revenue") / F.col("total_transactions"), 2)
    return table(spark, path, "daily").join(stores, "store_id", "left").withColumn(
        "avg_transaction_value", mean)


def agg_monthly_sales(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, "monthly").select(
        F.year("month_start").alias("year"), F.month("month_start").alias("month"),
        *(c.split()[0] for c in TABLES["monthly"][1].split(",")))


def agg_store_performance(spark: SparkSession, path: str) -> DataFrame:
    """Merged from the days' sums; no fact is read."""
    return gold.agg_store_performance(*_parts(spark, path))


def agg_return_kpi(spark: SparkSession, path: str) -> DataFrame:
    """Merged from the days' sums; no fact is read."""
    return gold.agg_return_kpi(*_parts(spark, path))


# -- what to refresh ----------------------------------------------------------------

def changed_products(before: DataFrame, after: DataFrame) -> DataFrame:
    """``product_id`` of products that came, went or have another price, cost or brand."""
    def shown(products: DataFrame, name: str) -> DataFrame:
        return products.select(
            F.col("product_id").cast("string").alias("product_id"),
            F.struct("product_retail_price", "product_cost", "product_brand").alias(name))

    return shown(before, "_old").join(shown(after, "_new"), "product_id", "full").where(
        ~F.col("_old").eqNullSafe(F.col("_new"))).select("product_id")


def days_selling(spark: SparkSession, path: str,
                 products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The days on which any of ``products`` was sold, and on which one came back."""
    ids = products.select(F.col("product_id").cast("string").alias("product_id"))
    sold, back = _parts(spark, path)
    return (sold.join(ids, "product_id", "left_semi").select("transaction_date").distinct(),
            back.join(ids, "product_id", "left_semi").select("return_date").distinct())


# -- steps --------------------------------------------------------------------------

def _parts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, path, "sales_parts"), table(spark, path, "returns_parts")


def _stored(spark: SparkSession, path: str, name: str) -> DataFrame:
    day, columns = TABLES[name]
    return spark.read.schema(f"{columns}, {day} DATE, {_FILLER} BOOLEAN, {_PART} DATE").parquet(
        f"{path}/{name}").where(~F.col(_FILLER)).drop(_FILLER)


def _kept(spark: SparkSession, days: DataFrame, unit: Callable[[str], Column]) -> DataFrame:
    """The distinct days, written once: every table of a refresh replaces the same ones."""
    target = work_dir(spark, "days")
    dates = days.select(F.col(days.columns[0]).cast("date").alias("day"))
    dates.select(unit("day").alias("day")).distinct().write.parquet(target)
    return spark.read.schema("day DATE").parquet(target)


def _on_days(rows: DataFrame, date: Column, days: DataFrame) -> DataFrame:
    """Rows of the days; no date matches no date.

    Stated as equalities, and with a comparison on the side of the days that all of them pass:
    Spark derives filters on partitions from nothing less.
    """
    first = F.lit("0001-01-01").cast("date")
    days = days.where(F.coalesce("day", first) >= F.least("day", first))
    return rows.join(days, (F.coalesce(date, first) == F.coalesce("day", first))
                     & (date.isNull() == F.col("day").isNull()), "left_semi")


def _branded(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Sales with the brand; of a product that is there several times, with each, ``_copy`` from 1."""
    copies = Window.partitionBy("product_id").orderBy("product_brand")
    brands = products.select(F.col("product_id").cast("string").alias("product_id"), "product_brand").where(
        "product_id is not null").withColumn("_copy", F.row_number().over(copies))
    return sales.join(brands, "product_id", "left")


def _tasks(spark: SparkSession) -> int:
    own = spark.conf.get("spark.sql.shuffle.partitions")
    return max(int(own), int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", own)))


def _groups(days: DataFrame) -> list[DataFrame]:
    """The days in so many groups that the shuffle of one has ``GROUP_TASKS`` partitions at most."""
    groups = min(-(-_tasks(days.sparkSession) // GROUP_TASKS), max(1, days.count()))
    return [days] if groups == 1 else [
        days.where(F.pmod(F.xxhash64("day"), F.lit(groups)) == n) for n in range(groups)]


def _dealt(rows: DataFrame, days: DataFrame, date: Column, groups: int = 1) -> DataFrame:
    """Rows and fillers, shuffled once for all tables: by day (or month) and a slice of the stores.

    What is grouped by day, slice, store and more needs no other shuffle and lies as it is written:
    a store's day (or month) is in one task.  Kept on the executors' disks for the tables made of it.
    The days are one of so many ``groups``.
    """
    tasks = -(-_tasks(rows.sparkSession) // groups)
    slices = -(-2 * tasks // max(1, days.count()))
    filler = days.select(F.lit(True).alias(_FILLER), F.col("day").alias(_PART))
    every = rows.select("*", F.lit(False).alias(_FILLER), date.alias(_PART)).unionByName(
        filler, allowMissingColumns=True)
    return every.withColumn(_SLICE, F.pmod(F.xxhash64("store_id"), F.lit(slices)).cast("int")).repartition(
        tasks, _PART, _SLICE).persist(StorageLevel.DISK_ONLY)


def _release(dealt: DataFrame) -> None:
    """Fills ``dealt`` and drops the shuffle files its rows came by, or they would be on disk twice.

    As Spark itself does after a write; a kept block that is lost is computed again, shuffles included.
    """
    dealt.count()
    plan = dealt._jdf.queryExecution().withCachedData().cacheBuilder().cachedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        shuffles = dealt.sparkSession.sparkContext._jsc.sc().shuffleDriverComponents()
        for shuffle in list(plan.context().shuffleIds()):
            shuffles.removeShuffle(shuffle, False)


def _totals(dealt: DataFrame, *keys: str) -> DataFrame:
    return dealt.groupBy(*_SLICED, *keys).agg(
        F.sum("quantity").alias("total_units"), *(exact_sum(c).alias(c) for c in _MONEY),
        F.count_distinct("customer_id").alias("unique_customers"), F.count(F.lit(1)).alias("total_transactions"))


def _put(path: str, name: str, dealt: DataFrame) -> None:
    """Replaces the days (or months) that ``dealt``, clustered by them, has rows or fillers of."""
    day, columns = TABLES[name]
    named = [c.split()[0] for c in columns.split(",")]
    dealt.select(*named, day, _FILLER, _PART).sortWithinPartitions(_PART, "store_id", day).write.mode(
        "overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(
        _PART).parquet(f"{path}/{name}")


def _replace(path: str, name: str, rows: DataFrame, days: DataFrame) -> None:
    day, columns = TABLES[name]
    named = [c.split()[0] for c in columns.split(",")]
    plain = rows.select(*named, day, F.lit(False).alias(_FILLER), _PART)
    filler = days.select(F.lit(True).alias(_FILLER), F.col("day").alias(_PART))
    overwrite(plain.unionByName(filler, allowMissingColumns=True), f"{path}/{name}", (_PART,),
              dynamic=True)


def _merged(parts: DataFrame, buyers: DataFrame, keys: list[str]) -> DataFrame:
    """Both inputs under ``keys``: sums of the parts, distinct customers of the sets.

    A set and the sums of one group meet in one aggregation; there is no join.
    """
    sums = parts.groupBy(*keys).agg(
        F.sum("quantity").alias("total_units"), *(exact_sum(c).alias(c) for c in _MONEY),
        F.sum("lines").alias("total_transactions"))
    counts = buyers.select(*keys, "customer_id").distinct().groupBy(*keys).agg(
        F.count(F.lit(1)).alias("unique_customers"))
    first = [F.max(c).alias(c) for c in ("total_units", *_MONEY, "total_transactions")]
    return sums.unionByName(counts, allowMissingColumns=True).groupBy(*keys).agg(
        *first, F.coalesce(F.max("unique_customers"), F.lit(0)).alias("unique_customers"))
