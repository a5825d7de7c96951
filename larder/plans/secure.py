"""Views limited by the caller's groups, as functions and as SQL views.

Groups are plain names.  Tests on them are literals when the plan is built, so the
optimizer removes masked columns from the scan and turns an empty row rule into an
empty relation.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Group names and masks.
ADMINS = "admins"
ENGINEERS = "data_engineers"
ANALYSTS = "data_analysts"
BUSINESS = "business_users"
REGION_MANAGERS = "central_managers"
OTHER_MANAGERS = "other_region_managers"
SEES_ALL_ROWS = frozenset({ADMINS, ENGINEERS, ANALYSTS, BUSINESS})
SEES_MONEY = frozenset({ADMINS, ENGINEERS})
SEES_NAMES = frozenset({ADMINS})
NAME_MASK = "REDACTED"
INCOME_MASK = "RESTRICTED"
RESTRICTED_REGION = "Central"


def shown_to(allowed: Collection[str], groups: Collection[str], column: str,
             mask: str | None = None) -> Column:
    """The column for members of an allowed group, the mask for anyone else."""
    member = not set(allowed).isdisjoint(groups)
    return F.when(F.lit(member), F.col(column)).otherwise(F.lit(mask)).alias(column)


def row_rule(groups: Collection[str], region: str = RESTRICTED_REGION) -> Column:
    """Which fact rows the groups may see; an unknown region is in no manager's area."""
    groups = set(groups)
    rule = F.lit(not SEES_ALL_ROWS.isdisjoint(groups))
    if REGION_MANAGERS in groups:
        rule = rule | (F.col("sales_region") == region)
    if OTHER_MANAGERS in groups:
        rule = rule | (F.col("sales_region") != region)
    return rule


def _with_region(fact: DataFrame, stores: DataFrame, groups: Collection[str],
                 region: str) -> DataFrame:
    areas = stores.select("store_id", "sales_region")
    return fact.join(areas, "store_id", "left").where(row_rule(groups, region))


def secure_fact_sales(sales: DataFrame, stores: DataFrame, groups: Collection[str],
                      region: str = RESTRICTED_REGION) -> DataFrame:
    return _with_region(sales, stores, groups, region).select(
        "transaction_date", "store_id", "product_id", "sales_region", "quantity",
        *(shown_to(SEES_MONEY, groups, c)
          for c in ("total_revenue", "total_cost", "total_profit")),
    )


def secure_fact_returns(returns: DataFrame, stores: DataFrame, groups: Collection[str],
                        region: str = RESTRICTED_REGION) -> DataFrame:
    return _with_region(returns, stores, groups, region).select(
        *returns.columns, "sales_region")


def _masked(df: DataFrame, masks: dict[str, Column]) -> DataFrame:
    return df.select(*(masks.get(c, F.col(c)) for c in df.columns))


def secure_dim_customer(customers: DataFrame, groups: Collection[str]) -> DataFrame:
    return _masked(customers, {
        "customer_name": shown_to(SEES_NAMES, groups, "customer_name", NAME_MASK),
        "yearly_income": shown_to(SEES_MONEY, groups, "yearly_income", INCOME_MASK),
    })


def secure_dim_product(products: DataFrame, groups: Collection[str]) -> DataFrame:
    return _masked(products, {"product_cost": shown_to(SEES_MONEY, groups, "product_cost")})


def create_views(gold: dict[str, DataFrame], groups: Collection[str],
                 region: str = RESTRICTED_REGION) -> None:
    """Register the four views for one caller, so that SQL can query them by name."""
    sales, returns = gold["fact_sales"], gold["fact_returns"]
    stores = gold["dim_store"]
    views = {
        "v_secure_fact_sales": secure_fact_sales(sales, stores, groups, region),
        "v_secure_fact_returns": secure_fact_returns(returns, stores, groups, region),
        "v_secure_dim_customer": secure_dim_customer(gold["dim_customer"], groups),
        "v_secure_dim_product": secure_dim_product(gold["dim_product"], groups),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)


# -- the same as SQL views ---------------------------------------------------------
#
# The groups are a session variable.  A statement over the views sees the groups that are set
# when it is analyzed; they are constants to the optimizer, as above.

VARIABLE = "session.caller_groups"


def act_as(spark: SparkSession, groups: Collection[str]) -> None:
    """Sets the groups that later statements of this session are answered for."""
    spark.sql(f"SET VARIABLE {VARIABLE} = CAST(:groups AS ARRAY<STRING>)",
              args={"groups": sorted(groups)})


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _member(allowed: Collection[str]) -> str:
    names = ", ".join(_quoted(g) for g in sorted(allowed))
    return f"arrays_overlap({VARIABLE}, array({names}))"


def _shown_sql(allowed: Collection[str], column: str, mask: str | None = None) -> str:
    other = "NULL" if mask is None else _quoted(mask)
    return f"CASE WHEN {_member(allowed)} THEN {column} ELSE {other} END AS {column}"


def create_sql_views(spark: SparkSession, gold: dict[str, DataFrame],
                     region: str = RESTRICTED_REGION) -> None:
    """Declares the variable, with no groups, and the four views of ``create_views`` over it.

    ``gold`` are the facts and dimensions; they are registered as ``gold_...`` views.
    """
    spark.sql(f"DECLARE OR REPLACE VARIABLE {VARIABLE} ARRAY<STRING> "
              "DEFAULT CAST(array() AS ARRAY<STRING>)")
    for name, df in gold.items():
        df.createOrReplaceTempView(f"gold_{name}")
    rule = f"""{_member(SEES_ALL_ROWS)}
        OR ({_member({REGION_MANAGERS})} AND sales_region = {_quoted(region)})
        OR ({_member({OTHER_MANAGERS})} AND sales_region <> {_quoted(region)})"""

    def fact(name: str, columns: Collection[str]) -> str:
        return f"""SELECT {", ".join(columns)} FROM gold_{name} LEFT JOIN
            (SELECT store_id, sales_region FROM gold_dim_store) USING (store_id) WHERE {rule}"""

    def masked(name: str, masks: dict[str, str]) -> str:
        columns = ", ".join(masks.get(c, c) for c in gold[name].columns)
        return f"SELECT {columns} FROM gold_{name}"

    money = [_shown_sql(SEES_MONEY, c) for c in ("total_revenue", "total_cost", "total_profit")]
    views = {
        "fact_sales": fact("fact_sales", [
            "transaction_date", "store_id", "product_id", "sales_region", "quantity", *money]),
        "fact_returns": fact("fact_returns", [*gold["fact_returns"].columns, "sales_region"]),
        "dim_customer": masked("dim_customer", {
            "customer_name": _shown_sql(SEES_NAMES, "customer_name", NAME_MASK),
            "yearly_income": _shown_sql(SEES_MONEY, "yearly_income", INCOME_MASK)}),
        "dim_product": masked("dim_product", {"product_cost": _shown_sql(SEES_MONEY, "product_cost")}),
    }
    for name, sql in views.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW v_secure_{name} AS {sql}")
