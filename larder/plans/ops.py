"""Live operations queries over cleaned orders and inventory.

Every query looks back from a point in time.  By default that is the current time;
``as_of`` replays an earlier moment and then also hides what came later.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from larder.functions.scalar import minute_of

# Default window, thresholds and report sizes.
LOOKBACK = "2 hours"
LOW_STOCK = 10
MEDIUM_STOCK = 50
TOP_GROUPS = 20
LATEST_ROWS = 50


@dataclass(frozen=True)
class Window:
    """The time span the queries look at."""

    as_of: Column | None = None
    lookback: str = LOOKBACK

    @property
    def now(self) -> Column:
        return F.current_timestamp() if self.as_of is None else self.as_of

    def of(self, df: DataFrame) -> DataFrame:
        time = F.col("timestamp")
        inside = time >= self.now - F.expr(f"INTERVAL {self.lookback}")
        if self.as_of is not None:
            inside = inside & (time <= self.as_of)
        return df.where(inside)


def _seconds(time: Column) -> Column:
    return F.unix_timestamp(time)


def _count(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def _low(window: Window, inventory: DataFrame) -> DataFrame:
    return window.of(inventory).where(F.col("quantity_remaining") < LOW_STOCK)


# -- single figures ----------------------------------------------------------------

def orders_per_minute(orders: DataFrame, window: Window = Window()) -> DataFrame:
    """Orders over the whole minutes between the first and last one, one at least."""
    minutes = F.timestamp_diff("MINUTE", F.min("timestamp"), F.max("timestamp"))
    rate = F.count(F.lit(1)) / F.greatest(minutes, F.lit(1))
    return window.of(orders).agg(F.round(rate, 2).alias("orders_per_minute"))


def total_orders(orders: DataFrame, window: Window = Window()) -> DataFrame:
    return window.of(orders).agg(_count("total_orders"))


def latest_event(orders: DataFrame, window: Window = Window()) -> DataFrame:
    return window.of(orders).agg(F.max("timestamp").alias("latest_event_time"))


def streaming_lag(orders: DataFrame, window: Window = Window()) -> DataFrame:
    behind = (_seconds(window.now) - _seconds(F.max("timestamp"))) / 60
    return window.of(orders).agg(F.round(behind, 2).alias("lag_minutes"))


def low_stock_alerts(inventory: DataFrame, window: Window = Window()) -> DataFrame:
    return _low(window, inventory).agg(_count("low_stock_alerts"))


def duplicate_orders(orders: DataFrame, window: Window = Window()) -> DataFrame:
    """Surplus copies over all repeated order ids; NULL when nothing repeats."""
    copies = window.of(orders).groupBy("order_id").agg(_count("copies"))
    return copies.where("copies > 1").agg(
        F.sum(F.col("copies") - 1).alias("duplicate_count"))


def null_critical_fields(orders: DataFrame, window: Window = Window()) -> DataFrame:
    missing = sum(
        (F.col(c).isNull().cast("int") for c in ("order_id", "product_id", "store_id")),
        start=F.lit(0),
    )
    return window.of(orders).agg(F.sum(missing).alias("null_count"))


# -- trends and distributions ------------------------------------------------------

def orders_per_minute_trend(orders: DataFrame, window: Window = Window()) -> DataFrame:
    per_minute = window.of(orders).groupBy(minute_of("timestamp").alias("minute_bucket"))
    return per_minute.agg(_count("order_count")).orderBy("minute_bucket")


def _both(orders: DataFrame, inventory: DataFrame, window: Window, key: Column,
          name: str) -> DataFrame:
    """Counts per key for both streams, tagged with the stream they come from."""
    def counted(df: DataFrame, tag: str) -> DataFrame:
        per_key = window.of(df).groupBy(key.alias(name)).agg(_count("event_count"))
        return per_key.select(name, F.lit(tag).alias("event_type"), "event_count")

    tagged = counted(orders, "Orders").unionByName(counted(inventory, "Inventory"))
    return tagged.orderBy(name, "event_type")


def events_per_minute(orders: DataFrame, inventory: DataFrame,
                      window: Window = Window()) -> DataFrame:
    return _both(orders, inventory, window, minute_of("timestamp"), "minute_bucket")


def store_distribution(orders: DataFrame, inventory: DataFrame,
                       window: Window = Window()) -> DataFrame:
    return _both(orders, inventory, window, F.col("store_id"), "store_id")


def _low_stock_by(inventory: DataFrame, window: Window, key: str) -> DataFrame:
    counts = _low(window, inventory).groupBy(key).agg(_count("low_stock_count"))
    return counts.orderBy(F.desc("low_stock_count"), key).limit(TOP_GROUPS)


def low_stock_by_store(inventory: DataFrame, window: Window = Window()) -> DataFrame:
    return _low_stock_by(inventory, window, "store_id")


def low_stock_by_product(inventory: DataFrame, window: Window = Window()) -> DataFrame:
    return _low_stock_by(inventory, window, "product_id")


def stock_level_distribution(inventory: DataFrame, window: Window = Window()) -> DataFrame:
    """Rows per stock band; these bands differ from the ones in ``stock_status``."""
    level = F.col("quantity_remaining")
    band = F.when(level < LOW_STOCK, "Low").when(level < MEDIUM_STOCK, "Medium")
    counted = window.of(inventory).groupBy(band.otherwise("High").alias("stock_bucket"))
    return counted.agg(_count("count")).orderBy("stock_bucket")


def latency_trend(orders: DataFrame, window: Window = Window()) -> DataFrame:
    """Mean seconds from event to processing, per minute; unknown times are left out."""
    delay = _seconds(F.col("processing_timestamp")) - _seconds(F.col("event_timestamp"))
    timed = window.of(orders).where(
        "processing_timestamp IS NOT NULL AND event_timestamp IS NOT NULL")
    per_minute = timed.groupBy(minute_of("timestamp").alias("minute_bucket"))
    return per_minute.agg(F.round(F.avg(delay), 2).alias("avg_delay_seconds")).orderBy(
        "minute_bucket")


# -- latest rows -------------------------------------------------------------------

def recent_orders(orders: DataFrame, window: Window = Window()) -> DataFrame:
    rows = window.of(orders).select(
        "order_id", "product_id", "store_id", "quantity", "order_channel", "timestamp")
    return rows.orderBy(F.desc("timestamp"), "order_id").limit(LATEST_ROWS)


def recent_inventory(inventory: DataFrame, window: Window = Window()) -> DataFrame:
    rows = window.of(inventory).select(
        "inventory_id", "product_id", "store_id", "quantity_remaining", "stock_status",
        "timestamp")
    return rows.orderBy(F.desc("timestamp"), "inventory_id").limit(LATEST_ROWS)
