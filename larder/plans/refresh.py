"""Recomputed tables of the star schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larder.operators.audit import RunLog
from larder.plans import gold
from larder.sources.tables import overwrite


def refresh_gold(spark: SparkSession, path: str, *, transactions: DataFrame,
                 orders: DataFrame, returns: DataFrame, regions: DataFrame,
                 customers: DataFrame, products: DataFrame, stores: DataFrame,
                 log: RunLog | None = None) -> dict[str, DataFrame]:
    """Write all dimensions, facts and aggregates below ``path``.

    Inputs are the valid transactions and orders, the cleaned returns and regions, and
    the current rows of the three histories.  Each table is written once and what is
    built on it reads the written table: the facts are computed once for four aggregates.
    """
    made: dict[str, DataFrame] = {}

    def write(name: str, df: DataFrame) -> None:
        target = f"{path}/{name}"
        if log is None:
            overwrite(df, target)
        else:
            log.write(df, target, "gold", name)
        made[name] = spark.read.schema(df.schema).parquet(target)

    write("dim_customer", gold.dim_customer(customers))
    write("dim_product", gold.dim_product(products))
    write("dim_store", gold.dim_store(stores, regions))
    write("fact_sales", gold.fact_sales(transactions, orders, made["dim_product"]))
    write("fact_returns", gold.fact_returns(returns, made["dim_product"]))
    aggregates: dict[str, tuple[Callable[..., DataFrame], str, str]] = {
        "agg_daily_sales": (gold.agg_daily_sales, "fact_sales", "dim_store"),
        "agg_monthly_sales": (gold.agg_monthly_sales, "fact_sales", "dim_product"),
        "agg_store_performance": (gold.agg_store_performance, "fact_sales", "fact_returns"),
        "agg_return_kpi": (gold.agg_return_kpi, "fact_sales", "fact_returns"),
    }
    for name, (build, left, right) in aggregates.items():
        write(name, build(made[left], made[right]))
    return made
