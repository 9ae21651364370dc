"""Orders per location in tumbling time windows; one function for tables and streams."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions import with_order_time

EVENT_TIME = "order_date_time"


def location_windows(
    orders: DataFrame, size: str = "10 minutes", watermark: str | None = None, exact: bool = False
) -> DataFrame:
    """Lines and distinct sellers per window and location.

    Distinct sellers are approximate, which keeps the state of a stream small; `exact` is for tables only.
    """
    timed = with_order_time(orders, EVENT_TIME)
    if watermark:
        timed = timed.withWatermark(EVENT_TIME, watermark)
    sellers = F.count_distinct("seller_id") if exact else F.approx_count_distinct("seller_id")
    return (
        timed.groupBy(F.window(EVENT_TIME, size), "location")
        .agg(F.count("product_id").alias("product_count"), sellers.alias("distinct_seller_count"))
        .select("location", "product_count", "distinct_seller_count", "window")
    )


def window_starts(windows: DataFrame) -> DataFrame:
    """The same rows with the window's start instead of the window."""
    return windows.select(
        F.col("window.start").alias("window_start"), "location", "product_count", "distinct_seller_count"
    )


def sellers_within(found: DataFrame, exact: DataFrame, tolerance: float = 0.15) -> DataFrame:
    """`found` with the exact number of sellers, and whether its own number is within three standard deviations.

    Both are windows as `window_starts` gives them. A window that only `found` has gets nulls.
    """
    right = exact.select(
        F.col("window_start").alias("_start"), F.col("location").alias("_place"), F.col("distinct_seller_count").alias("_n")
    )
    joined = found.join(right, (F.col("window_start") == F.col("_start")) & F.col("location").eqNullSafe(F.col("_place")), "left")
    bound = F.greatest(F.lit(1), F.ceil(F.col("_n") * F.lit(tolerance)))
    return joined.select(
        "window_start",
        "location",
        "product_count",
        F.col("_n").alias("distinct_seller_count"),
        (F.abs(F.col("distinct_seller_count") - F.col("_n")) <= bound).alias("within_bound"),
    )


def seller_count_check(orders: DataFrame, size: str = "1 day", tolerance: float = 0.15) -> DataFrame:
    """Exact distinct sellers per window, and whether the approximate count of `location_windows` is close to it."""
    found, exact = (window_starts(location_windows(orders, size, exact=exact)) for exact in (False, True))
    return sellers_within(found, exact, tolerance).drop("product_count")


def seller_sketches(orders: DataFrame, size: str = "10 minutes") -> DataFrame:
    """Lines per window and location, and a sketch of their sellers that can be merged: (window_start, location,
    product_count, sellers).
    """
    counted = with_order_time(orders, EVENT_TIME).groupBy(F.window(EVENT_TIME, size), "location")
    sketches = counted.agg(F.count("product_id").alias("product_count"), F.hll_sketch_agg("seller_id").alias("sellers"))
    return sketches.select(F.col("window.start").alias("window_start"), "location", "product_count", "sellers")


def merged_sketches(sketches: DataFrame, size: str) -> DataFrame:
    """Stored sketches rolled up to longer windows, or those of several loads to one each, without the orders."""
    merged = sketches.groupBy(F.window("window_start", size), "location").agg(
        F.sum("product_count").alias("product_count"), F.hll_union_agg("sellers").alias("sellers")
    )
    return merged.select(F.col("window.start").alias("window_start"), "location", "product_count", "sellers")


def sketched_sellers(sketches: DataFrame) -> DataFrame:
    """The same rows with the number of different sellers, approximately, in place of the sketch."""
    return sketches.withColumn("distinct_seller_count", F.hll_sketch_estimate("sellers")).drop("sellers")
