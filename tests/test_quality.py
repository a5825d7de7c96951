import pytest
from conftest import rows
from pyspark.sql import Observation, functions as F

from larder.operators import quality as q

SALES = "product_id INT, customer_id INT, store_id INT, quantity INT, transaction_date STRING"


@pytest.fixture
def sales(spark):
    return spark.createDataFrame([
        (1, 10, 100, 5, "2024-01-01"),
        (2, 20, 200, 3, "2024-01-02"),
        (None, 30, 300, 2, "2024-01-03"),
        (4, None, 400, 1, "2024-01-04"),
        (5, 50, None, 4, "2024-01-05"),
        (6, 60, 600, 0, "2024-01-06"),
        (7, 70, 700, -1, "2024-01-07"),
        (8, 80, 800, 2, None),
    ], SALES)


def test_split_names_the_broken_rule(sales):
    good, bad = q.split(sales, q.TRANSACTION_RULES)
    assert good.count() == 2
    reasons = {r.product_id: r[q.REASON] for r in bad.collect()}
    assert reasons == {None: "valid_product", 4: "valid_customer", 5: "valid_store",
                       6: "positive_qty", 7: "positive_qty", 8: "valid_date"}
    assert bad.where(F.col(q.SET_ASIDE_AT).isNull()).count() == 0


def test_inventory_and_order_rules(spark):
    stock = spark.createDataFrame(
        [(1, 1, 10), (2, 1, 0), (None, 1, 5), (3, None, 5), (4, 1, -5)],
        "product_id INT, store_id INT, quantity_remaining INT")
    good, bad = q.split(stock, q.INVENTORY_RULES)
    assert (good.count(), bad.count()) == (2, 3)
    orders = spark.createDataFrame(
        [("a", 1, 1, 1, 1), ("b", 2, 1, 1, 2), (None, 1, 1, 1, 1), ("d", None, 1, 1, 1),
         ("e", 1, 1, 1, 0)],
        "order_id STRING, product_id INT, customer_id INT, store_id INT, quantity INT")
    good, bad = q.split(orders, q.ORDER_RULES)
    assert (good.count(), bad.count()) == (2, 3)


def test_unknown_quantity_is_lost_only_by_the_letter(spark):
    df = spark.createDataFrame([(1, 1, 1, None, "2024-01-01")], SALES)
    assert q.valid(df, q.TRANSACTION_RULES).count() == 0
    kept = q.quarantined(df, q.TRANSACTION_RULES)
    assert [r[q.REASON] for r in kept.collect()] == ["positive_qty"]
    assert q.quarantined(df, q.TRANSACTION_RULES, null_safe=False).count() == 0


def test_several_reasons_keep_rule_order(spark):
    df = spark.createDataFrame([(None, None, 1, 0, None)], SALES)
    [row] = q.quarantined(df, q.TRANSACTION_RULES).collect()
    assert row[q.REASON] == "valid_product, valid_customer, positive_qty, valid_date"


def test_judge_covers_every_row_once(sales):
    judged = q.judge(sales, q.TRANSACTION_RULES)
    assert judged.count() == sales.count()
    assert judged.where(q.VERDICT).count() == 2
    assert judged.where(q.VERDICT).where(f"{q.REASON} <> ''").count() == 0


def test_counts_and_observation_agree(spark, sales):
    counted = {r.rule: r.failed for r in q.rule_counts(sales, q.TRANSACTION_RULES).collect()}
    seen = Observation()
    q.observe_rules(sales, q.TRANSACTION_RULES, seen).write.format("noop").mode(
        "overwrite").save()
    assert seen.get == {"rows": 8, **counted}
    assert counted["positive_qty"] == 2


def test_counts_of_nothing(spark, sales):
    none = q.rule_counts(sales.where("false"), q.TRANSACTION_RULES)
    assert {(r.passed, r.failed) for r in none.collect()} == {(0, 0)}


def test_drop_and_fail(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "product_id INT, store_id INT")
    assert rows(q.drop_unless(df, q.INVENTORY_DROP_UNLESS)) == [(2, 3)]
    assert q.fail_unless(df, q.INVENTORY_MUST_HOLD).count() == 2
    broken = df.union(spark.createDataFrame([(None, 1)], df.schema))
    with pytest.raises(Exception, match="valid_product violated"):
        q.fail_unless(broken, q.INVENTORY_MUST_HOLD).select("store_id").collect()
