"""Best rows per group.

`row_number() <= k` lets Spark cut every task's rows to k per group before the shuffle, so a group that holds
a large share of the table reaches its final task as at most k rows per input task.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions import is_created, is_reversed, with_order_day, with_status
from marketlens.operators.totals import location_counts
from marketlens.schemas import CREATED


def top_k(
    df: DataFrame, partition: Sequence[str], order: Sequence[Column], k: int, rank: str = "ranking"
) -> DataFrame:
    """The first `k` rows of every group; `order` must settle ties if the choice matters."""
    window = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def recent_lines(orders: DataFrame, n: int = 5) -> DataFrame:
    """Every product's `n` newest created lines with their rank."""
    newest = [F.desc("order_date"), F.asc("order_id"), F.asc("price"), F.asc("seller_id")]
    created = with_status(orders, CREATED)
    return top_k(created, ["product_id"], newest, n).select("product_id", "order_id", "order_date", "ranking")


def avg_recent(orders: DataFrame, n: int = 5, by: str = "line") -> DataFrame:
    """Created lines among a product's `n` newest lines, or in its `n` newest selling days, divided by `n`."""
    created = with_status(orders, CREATED)
    if by == "line":
        newest = top_k(
            created.select("product_id", "order_id", "order_date"),
            ["product_id"],
            [F.desc("order_date"), F.asc("order_id")],
            n,
        )
        return newest.groupBy("product_id").agg((F.count("order_id") / F.lit(n)).alias("avg_sales_amount"))
    if by == "day":
        days = (
            with_order_day(created)
            .where(F.col("order_date").isNotNull())
            .groupBy("product_id", "order_date")
            .agg(F.count("order_id").alias("lines"))
        )
        newest = top_k(days, ["product_id"], [F.desc("order_date")], n)
        return newest.groupBy("product_id").agg((F.sum("lines") / F.lit(n)).alias("avg_daily_sales_last5"))
    raise ValueError(f"by must be 'line' or 'day', not {by!r}")


def avg_recent_of_sides(lines: DataFrame, n: int = 5) -> DataFrame:
    """As `avg_recent` by line, from the created and reversed lines that the totals are made of.

    Both then read the same columns of the same rows, so that Spark shuffles the lines once for both. Created lines rank
    first, so the others do not count.
    """
    made = is_created()
    newest = [F.when(made, 0).otherwise(1), F.desc("order_date"), F.asc("order_id"), F.asc("price")]
    ranked = top_k(lines.where(made | is_reversed()), ["product_id"], newest, n)
    created = ranked.where(made).groupBy("product_id")
    return created.agg((F.count("order_id") / F.lit(n)).alias("avg_sales_amount"))


def top_location(orders: DataFrame) -> DataFrame:
    """The location with most created lines of each product; the first by name among equals."""
    best = [F.desc("total_sales_amount"), F.asc("location")]
    return top_k(location_counts(orders), ["product_id"], best, 1).select(
        "product_id", F.col("location").alias("top_selling_location")
    )


def top_sellers(totals: DataFrame, k: int = 10) -> DataFrame:
    """The `k` best sellers of each day by net price."""
    return top_k(totals, ["order_date"], [F.desc("net_sales_price"), F.asc("seller_id")], k)


def top_categories(totals: DataFrame) -> DataFrame:
    """Each seller's best category of each day by net price."""
    best = [F.desc("net_sales_price"), F.asc("category_name")]
    return top_k(totals, ["order_date", "seller_id"], best, 1)
