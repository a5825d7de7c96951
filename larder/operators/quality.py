"""Rules over rows: expectations, the valid / quarantine split, and rule counts.

A rule set is a mapping from rule name to a SQL predicate.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, functions as F

from larder.functions.scalar import all_of

Rules = Mapping[str, str]

# Rule names appear in quarantine reasons and metrics.
TRANSACTION_RULES: Rules = {
    "valid_product": "product_id IS NOT NULL",
    "valid_customer": "customer_id IS NOT NULL",
    "valid_store": "store_id IS NOT NULL",
    "positive_qty": "quantity > 0",
    "valid_date": "transaction_date IS NOT NULL",
}
ORDER_RULES: Rules = {
    "valid_order_id": "order_id IS NOT NULL",
    "valid_product": "product_id IS NOT NULL",
    "valid_customer": "customer_id IS NOT NULL",
    "valid_store": "store_id IS NOT NULL",
    "positive_qty": "quantity > 0",
}
INVENTORY_RULES: Rules = {
    "valid_product": "product_id IS NOT NULL",
    "valid_store": "store_id IS NOT NULL",
    "valid_stock": "quantity_remaining >= 0",
}

# Expectations that only warn, per cleaned table.
WARNINGS: Mapping[str, Rules] = {
    "transactions": {
        "valid_quantity": "quantity > 0",
        "valid_customer": "customer_id IS NOT NULL",
        "valid_product": "product_id IS NOT NULL",
        "valid_date": "transaction_date IS NOT NULL",
    },
    "stores": {"valid_store": "store_id IS NOT NULL"},
    "regions": {"valid_region": "region_id IS NOT NULL"},
    "calendar": {"valid_date": "date IS NOT NULL"},
    "returns": {
        "valid_quantity": "quantity > 0",
        "valid_date": "return_date IS NOT NULL",
    },
    "inventory": {"valid_stock": "quantity_remaining >= 0"},
}
# The two inventory expectations that act on rows.
INVENTORY_MUST_HOLD: Rules = {"valid_product": "product_id IS NOT NULL"}
INVENTORY_DROP_UNLESS: Rules = {"valid_store": "store_id IS NOT NULL"}

REASON = "_quarantine_reason"
SET_ASIDE_AT = "_quarantine_timestamp"
VERDICT = "_is_valid"


def holds(predicate: str) -> Column:
    """The predicate with UNKNOWN counted as a failure."""
    return F.coalesce(F.expr(predicate), F.lit(False))


def passes(rules: Rules) -> Column:
    return all_of(holds(p) for p in rules.values())


def failed_names(rules: Rules, null_safe: bool = True) -> Column:
    """Names of the broken rules in rule order, comma separated."""
    def broken(p: str) -> Column:
        return ~holds(p) if null_safe else ~F.expr(p)

    return F.concat_ws(", ", *(F.when(broken(p), F.lit(n)) for n, p in rules.items()))


def judge(df: DataFrame, rules: Rules) -> DataFrame:
    """Every row once, with its verdict and the reason for a rejection.

    One pass over the input serves both outputs: write it partitioned by the
    verdict, or filter it twice from a written table.
    """
    return df.withColumns({VERDICT: passes(rules), REASON: failed_names(rules)})


def valid(df: DataFrame, rules: Rules) -> DataFrame:
    return df.where(passes(rules))


def quarantined(df: DataFrame, rules: Rules, null_safe: bool = True,
                clock: Column | None = None) -> DataFrame:
    """The rows that are not valid.

    ``null_safe=False`` keeps three-valued logic to the letter: a row whose rules are
    neither broken nor all true is then in neither output.
    """
    literal = all_of(F.expr(p) for p in rules.values())
    rejected = ~passes(rules) if null_safe else ~literal
    return df.where(rejected).withColumns({
        SET_ASIDE_AT: F.current_timestamp() if clock is None else clock,
        REASON: failed_names(rules, null_safe),
    })


def split(df: DataFrame, rules: Rules, null_safe: bool = True,
          clock: Column | None = None) -> tuple[DataFrame, DataFrame]:
    return valid(df, rules), quarantined(df, rules, null_safe, clock)


def drop_unless(df: DataFrame, rules: Rules) -> DataFrame:
    return df.where(passes(rules))


def fail_unless(df: DataFrame, rules: Rules) -> DataFrame:
    """Stop the job at the first row that breaks a rule.

    The check sits in a filter: an extra column nobody reads would be pruned.
    """
    checks = (
        holds(p) | F.raise_error(F.lit(f"expectation {n} violated: {p}")).isNull()
        for n, p in rules.items()
    )
    return df.where(all_of(checks))


def rule_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """(rule, passed, failed) for all rules from a single scan."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *(F.count_if(~holds(p)).alias(n) for n, p in rules.items()),
    )
    pairs = F.array(*(
        F.struct(F.lit(n).alias("rule"), F.col(n).alias("failed")) for n in rules
    ))
    return counts.select("n", F.explode(pairs).alias("r")).select(
        F.col("r.rule").alias("rule"),
        (F.col("n") - F.col("r.failed")).alias("passed"),
        F.col("r.failed").alias("failed"),
    )


def observe_rules(df: DataFrame, rules: Rules,
                  observation: Observation | str = "expectations") -> DataFrame:
    """Count rows and rule violations on the way through, without a job of their own.

    With an ``Observation`` the counts are there after the batch action; with a name
    they appear in the progress of a streaming query.
    """
    return df.observe(
        observation,
        F.count(F.lit(1)).alias("rows"),
        *(F.count_if(~holds(p)).alias(n) for n, p in rules.items()),
    )
