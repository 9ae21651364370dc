"""The reports in their plainest form, to test and time the library's shapes against.

One aggregate per side and a full join, one window per ranking, one self-join for pairs, one `lag` per product.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.operators.prices import distinct_price_points, price_change
from marketlens.operators.ranking import avg_recent, top_categories, top_location, top_sellers
from marketlens.operators.totals import (
    full_join_totals,
    seller_category_totals,
    seller_totals,
    with_category,
)
from marketlens.functions import from_units, to_units, with_order_day
from marketlens.sources import tables


def plain_net_gross(orders: DataFrame, keys: list[str]) -> DataFrame:
    created, cancelled = (to_units(F.col(f"total_{side}_price")) for side in ("created", "cancelled"))
    return full_join_totals(orders, keys).select(
        *keys,
        (F.col("total_created_amount") - F.col("total_cancelled_amount")).alias("net_sales_amount"),
        from_units(created - cancelled, F.lit(0.0)).alias("net_sales_price"),
        F.col("total_created_amount").alias("gross_sales_amount"),
        F.col("total_created_price").alias("gross_sales_price"),
    )


def plain_summary(orders: DataFrame) -> DataFrame:
    sales = plain_net_gross(orders, ["product_id"]).alias("s")
    recent, place = avg_recent(orders).alias("r"), top_location(orders).alias("p")
    return (
        sales.join(recent, F.col("s.product_id") == F.col("r.product_id"), "left")
        .join(place, F.col("s.product_id") == F.col("p.product_id"), "left")
        .select(
            F.col("s.product_id").alias("productid"),
            "net_sales_amount",
            "net_sales_price",
            "gross_sales_amount",
            "gross_sales_price",
            "avg_sales_amount",
            "top_selling_location",
        )
        .na.fill(0.0, ["avg_sales_amount"])
        .na.fill("No city", ["top_selling_location"])
        .orderBy(F.desc("gross_sales_amount"), F.asc("productid"))
    )


def plain_top_sellers(orders: DataFrame, products: DataFrame) -> DataFrame:
    keys = ["product_id", "order_date", "seller_id"]
    sales = with_category(plain_net_gross(with_order_day(orders), keys), products)
    sellers = top_sellers(seller_totals(sales)).select("order_date", "seller_id", "gross_sales_amount")
    best = top_categories(seller_category_totals(sales)).select("order_date", "seller_id", "category_name")
    return sellers.join(best, ["order_date", "seller_id"])


def plain_price_changes(orders: DataFrame) -> DataFrame:
    in_time = Window.partitionBy("product_id").orderBy("order_date", "price")
    return (
        distinct_price_points(orders)
        .withColumn("previous_price", F.lag("price").over(in_time))
        .select("product_id", "order_date", "price", price_change().alias("price_changes"))
        .orderBy(F.desc("order_date"), F.asc("product_id"), F.asc("price"))
    )


def plain_pairs(sessions: DataFrame, max_len: int = 7) -> DataFrame:
    first, second = F.col("a.product_id"), F.col("b.product_id")
    return (
        sessions.alias("a")
        .join(sessions.alias("b"), "session_id")
        .groupBy(first.alias("product_id_1"), second.alias("product_id_2"))
        .agg(F.count("session_id").alias("frequency"))
        .where(
            (F.col("product_id_1") < F.col("product_id_2"))
            & (F.length("product_id_1") == F.length("product_id_2"))
            & (F.length("product_id_1") <= max_len)
        )
        .select(F.concat("product_id_1", "product_id_2").alias("id"), "product_id_1", "product_id_2", "frequency")
    )


def _orders(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The lines with the columns that the registered query of the report reads, so both join the same tables."""
    return tables.order_lines(spark, sf_dir, columns)


SALE = ("product_id", "order_id", "price", "status")
PLAIN = {
    "net_gross_by_product": lambda spark, sf: plain_net_gross(_orders(spark, sf, *SALE), ["product_id"]),
    "product_sales_summary": lambda spark, sf: plain_summary(_orders(spark, sf, *SALE, "location", "order_date")),
    "daily_top_sellers": lambda spark, sf: plain_top_sellers(
        _orders(spark, sf, *SALE, "order_date", "seller_id"), tables.products(spark, sf)
    ),
    "price_changes": lambda spark, sf: plain_price_changes(_orders(spark, sf, "product_id", "price", "order_date")),
    "pair_frequency": lambda spark, sf: plain_pairs(tables.event_sessions(spark, sf)),
    "pair_frequency_baskets": lambda spark, sf: plain_pairs(tables.basket_sessions(spark, sf)),
}
