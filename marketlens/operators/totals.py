"""Created, reversed, net and gross totals of order lines.

An *amount* is a number of lines (with an order id), a *price* is money.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions import SCALE, from_units, is_created, is_reversed, money_sum, to_rest, to_units, with_status
from marketlens.schemas import CREATED, REVERSED

# Columns of `status_totals`, all of which can be summed further.
PARTS = (
    "created_units", "created_rest", "created_amount", "created_lines",
    "reversed_units", "reversed_rest", "reversed_amount", "reversed_lines",
)


def created_totals(orders: DataFrame, keys: Sequence[str], scale: int = SCALE) -> DataFrame:
    return (
        with_status(orders, CREATED)
        .groupBy(*keys)
        .agg(
            money_sum("price", scale).alias("total_created_price"),
            F.count("order_id").alias("total_created_amount"),
        )
    )


def reversed_totals(orders: DataFrame, keys: Sequence[str], scale: int = SCALE) -> DataFrame:
    return (
        with_status(orders, REVERSED)
        .groupBy(*keys)
        .agg(
            money_sum("price", scale).alias("total_cancelled_price"),
            F.count("order_id").alias("total_cancelled_amount"),
        )
    )


def full_join_totals(orders: DataFrame, keys: Sequence[str], scale: int = SCALE) -> DataFrame:
    """Created and reversed totals side by side, 0 where one side has no row.

    Two scans and a full join; `net_gross` gets the same numbers from one scan. Null keys never meet, so they
    give one row per side.
    """
    made = created_totals(orders, keys, scale).alias("made")
    undone = reversed_totals(orders, keys, scale).alias("undone")
    same = F.lit(True)
    for key in keys:
        same = same & (F.col(f"made.{key}") == F.col(f"undone.{key}"))
    totals = (
        "total_created_price", "total_created_amount", "total_cancelled_price", "total_cancelled_amount",
    )
    return made.join(undone, same, "full").select(
        *[F.coalesce(f"made.{key}", f"undone.{key}").alias(key) for key in keys],
        *[F.coalesce(F.col(name), F.lit(0)).alias(name) for name in totals],
    )


def status_totals(orders: DataFrame, keys: Sequence[str], scale: int = SCALE) -> DataFrame:
    """Both sides' totals in one pass, prices in minor units and remainders, with the number of lines behind each side."""
    made, undone = is_created(), is_reversed()
    units, rest = to_units(F.col("price"), scale), to_rest(F.col("price"), scale)
    return (
        orders.where(made | undone)
        .groupBy(*keys)
        .agg(
            F.coalesce(F.sum(F.when(made, units)), F.lit(0)).alias("created_units"),
            F.coalesce(F.sum(F.when(made, rest)), F.lit(0.0)).alias("created_rest"),
            F.count(F.when(made, F.col("order_id"))).alias("created_amount"),
            F.count_if(made).alias("created_lines"),
            F.coalesce(F.sum(F.when(undone, units)), F.lit(0)).alias("reversed_units"),
            F.coalesce(F.sum(F.when(undone, rest)), F.lit(0.0)).alias("reversed_rest"),
            F.count(F.when(undone, F.col("order_id"))).alias("reversed_amount"),
            F.count_if(undone).alias("reversed_lines"),
        )
    )


def roll_up(totals: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    """`status_totals` summed to fewer keys, next to any further aggregates."""
    return totals.groupBy(*keys).agg(*[F.sum(part).alias(part) for part in PARTS], *more)


def net_and_gross(totals: DataFrame, keys: Sequence[str], scale: int = SCALE) -> DataFrame:
    """Net and gross columns in place of the parts.

    A full join leaves a null key's created and reversed lines in two rows. The same split is made here, on the
    aggregated rows, with no shuffle.
    """
    null_key = F.lit(False)
    for key in keys:
        null_key = null_key | F.col(key).isNull()
    both = (F.col("created_lines") > 0) & (F.col("reversed_lines") > 0)
    side = F.explode(
        F.when(null_key & both, F.array(F.lit("created"), F.lit("reversed"))).otherwise(F.array(F.lit("all")))
    )
    rows = totals.withColumn("side", side)

    def of_side(name: str, other: str) -> Column:
        return F.when(F.col("side") == other, F.lit(0)).otherwise(F.col(name))

    gross_amount = of_side("created_amount", "reversed")
    gross_units, gross_rest = of_side("created_units", "reversed"), of_side("created_rest", "reversed")
    net_units = gross_units - of_side("reversed_units", "created")
    net_rest = gross_rest - of_side("reversed_rest", "created")
    rest = [name for name in totals.columns if name not in (*keys, *PARTS)]
    return rows.select(
        *keys,
        (gross_amount - of_side("reversed_amount", "created")).alias("net_sales_amount"),
        from_units(net_units, net_rest, scale).alias("net_sales_price"),
        gross_amount.alias("gross_sales_amount"),
        from_units(gross_units, gross_rest, scale).alias("gross_sales_price"),
        *rest,
    )


def net_gross(orders: DataFrame, keys: Sequence[str], scale: int = SCALE) -> DataFrame:
    """Net and gross amount and price per key: one scan, one shuffle, combined before it."""
    return net_and_gross(status_totals(orders, keys, scale), keys, scale)


def with_category(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Left join of the product's category. No broadcast is forced: the product table may be large."""
    categories = products.select("productid", F.col("categoryname").alias("category_name"))
    return sales.join(categories, F.col("product_id") == F.col("productid"), "left").drop("productid")


def seller_totals(sales: DataFrame, scale: int = SCALE) -> DataFrame:
    return sales.groupBy("order_date", "seller_id").agg(
        money_sum("net_sales_price", scale).alias("net_sales_price"),
        F.sum("gross_sales_amount").alias("gross_sales_amount"),
    )


def seller_category_totals(sales: DataFrame, scale: int = SCALE) -> DataFrame:
    return sales.groupBy("order_date", "seller_id", "category_name").agg(
        money_sum("net_sales_price", scale).alias("net_sales_price")
    )


def location_counts(orders: DataFrame) -> DataFrame:
    """Created lines per product and location."""
    return (
        with_status(orders, CREATED)
        .groupBy("product_id", "location")
        .agg(F.count("order_id").alias("total_sales_amount"))
    )


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))
