"""Star schema and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from larder.functions.money import exact_sum, from_ticks, to_ticks

# Column lists of the dimension tables.
CUSTOMER_COLUMNS = (
    "customer_id", "customer_name", "customer_city", "customer_state_province",
    "customer_country", "gender", "marital_status", "yearly_income", "education",
    "occupation", "homeowner",
)
PRODUCT_COLUMNS = (
    "product_id", "product_name", "product_brand", "product_retail_price",
    "product_cost", "product_weight", "recyclable", "low_fat",
)
STORE_COLUMNS = (
    "store_id", "store_name", "store_city", "store_state", "region_id",
    "sales_region", "sales_district",
)


# -- dimensions: the inputs are current rows, see ``scd2.current`` -----------------

def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(*CUSTOMER_COLUMNS)


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(*PRODUCT_COLUMNS)


def dim_store(stores: DataFrame, regions: DataFrame) -> DataFrame:
    """Every current store, with its region's names where the region is known."""
    names = regions.select("region_id", "sales_region", "sales_district")
    return stores.join(names, "region_id", "left").select(*STORE_COLUMNS)


# -- facts -------------------------------------------------------------------------

def sale_lines(rows: DataFrame, date_column: str) -> DataFrame:
    """The columns of a sale in their canonical types.

    CSV ids arrive as text and topic ids as integers.  Product and customer ids are
    text, store ids integers; without the casts a union would widen to BIGINT and
    stop at the first id that is not a number.
    """
    return rows.select(
        F.col("product_id").cast("string").alias("product_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("store_id").try_cast("int").alias("store_id"),
        F.col(date_column).alias("transaction_date"),
        "quantity",
    )


def sales_union(transactions: DataFrame, orders: DataFrame) -> DataFrame:
    """Valid transactions and valid orders under one schema, copies kept."""
    return sale_lines(transactions, "transaction_date").unionByName(
        sale_lines(orders, "order_date"))


def fact_sales(transactions: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Sales at today's price; a sale of an unknown product keeps NULL measures.

    The price side grows with the catalogue, so the join carries no broadcast hint:
    adaptive execution broadcasts it while it is small and otherwise splits the
    partitions of hot products.
    """
    prices = products.select(
        F.col("product_id").cast("string").alias("product_id"),
        to_ticks("product_retail_price").alias("_price"),
        to_ticks("product_cost").alias("_cost"),
    )
    revenue = F.col("quantity") * F.col("_price")
    cost = F.col("quantity") * F.col("_cost")
    return sales_union(transactions, orders).join(prices, "product_id", "left").select(
        "transaction_date", "customer_id", "product_id", "store_id", "quantity",
        from_ticks(revenue).alias("total_revenue"),
        from_ticks(cost).alias("total_cost"),
        from_ticks(revenue - cost).alias("total_profit"),
    )


def fact_returns(returns: DataFrame, products: DataFrame) -> DataFrame:
    """Cleaned returns at today's price; they pass no quarantine."""
    prices = products.select(
        F.col("product_id").cast("string").alias("product_id"),
        to_ticks("product_retail_price").alias("_price"),
    )
    rows = returns.select(
        F.col("product_id").cast("string").alias("product_id"),
        F.col("store_id").try_cast("int").alias("store_id"),
        "return_date",
        F.col("quantity").alias("return_quantity"),
    )
    return rows.join(prices, "product_id", "left").select(
        "product_id", "store_id", "return_date", "return_quantity",
        from_ticks(F.col("return_quantity") * F.col("_price")).alias("return_amount"),
    )


# -- aggregates --------------------------------------------------------------------

def _sales_measures(approximate: float | None) -> list[Column]:
    customers = (
        F.count_distinct("customer_id") if approximate is None
        else F.approx_count_distinct("customer_id", approximate)
    )
    return [
        F.sum("quantity").alias("total_units"),
        exact_sum("total_revenue").alias("total_revenue"),
        exact_sum("total_cost").alias("total_cost"),
        exact_sum("total_profit").alias("total_profit"),
        customers.alias("unique_customers"),
        F.count(F.lit(1)).alias("total_transactions"),
    ]


def agg_daily_sales(sales: DataFrame, stores: DataFrame,
                    approximate: float | None = None) -> DataFrame:
    """Sales per day and store, store attributes attached after the aggregation.

    The exact distinct count spreads a busy store over its customers: Spark first
    groups by (day, store, customer), partially per map task, and only the merged
    rows meet per (day, store).  ``approximate`` trades it for a sketch with that
    relative error.
    """
    daily = sales.groupBy("transaction_date", "store_id").agg(*_sales_measures(approximate))
    mean = F.round(F.col("total_revenue") / F.col("total_transactions"), 2)
    return daily.join(stores, "store_id", "left").withColumn("avg_transaction_value", mean)


def agg_monthly_sales(sales: DataFrame, products: DataFrame,
                      approximate: float | None = None) -> DataFrame:
    """Sales per month, store and brand; sales without a known brand form a group."""
    brands = products.select("product_id", "product_brand")
    return (
        sales.join(brands, "product_id", "left")
        .groupBy(
            F.year("transaction_date").alias("year"),
            F.month("transaction_date").alias("month"),
            "store_id",
            "product_brand",
        )
        .agg(*_sales_measures(approximate))
    )


def agg_store_performance(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """Units, money and the percentage of units that came back, per store."""
    sold = sales.groupBy("store_id").agg(
        F.sum("quantity").alias("total_units_sold"),
        exact_sum("total_revenue").alias("total_revenue"),
        exact_sum("total_profit").alias("total_profit"),
    )
    back = returns.groupBy("store_id").agg(
        F.sum("return_quantity").alias("total_units_returned"))
    share = F.try_divide("total_units_returned", "total_units_sold") * 100
    return sold.join(back, "store_id", "left").withColumn("return_rate", F.round(share, 2))


def agg_return_kpi(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """Units sold, units returned and their ratio, per product."""
    sold = sales.groupBy("product_id").agg(F.sum("quantity").alias("sold_qty"))
    back = returns.groupBy("product_id").agg(F.sum("return_quantity").alias("returned_qty"))
    return sold.join(back, "product_id", "left").withColumn(
        "return_rate", F.try_divide("returned_qty", "sold_qty"))
