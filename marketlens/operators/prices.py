"""Price history of products."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions import with_order_time

# Length of a slice of time in microseconds: an hour.
SLICE = 3_600_000_000


def distinct_price_points(orders: DataFrame) -> DataFrame:
    """Distinct (product, price, time)."""
    return with_order_time(orders).select("product_id", "price", "order_date").distinct()


#: Columns that name a slice of a product: the product, whether it is null, and the number of the slice.
SLICE_KEYS = ("product_key", "no_product", "slice")


def in_slices(points: DataFrame, slice_micros: int = SLICE) -> DataFrame:
    """Points with the columns that name their slice, dealt out by them: the one shuffle that all of them take.

    Points without a time are a slice of their own, the first.
    """
    number = F.floor(F.unix_micros("order_date") / F.lit(slice_micros)).cast("long")
    keys = (F.coalesce(F.col("product_id").cast("string"), F.lit("")), F.col("product_id").isNull(), F.coalesce(number, F.lit(-(1 << 63)).cast("long")))
    named = {name: key for name, key in zip(SLICE_KEYS, keys)}
    return points.select("product_id", "price", "order_date").withColumns(named).repartition(*SLICE_KEYS)


def previous_price(points: DataFrame, slice_micros: int = SLICE) -> DataFrame:
    """Each price point with the product's price before it, by time and then price.

    A plain `lag` sorts one product in one task. Every product is therefore cut into slices of the calendar that sort
    apart from each other. The last price of a slice is carried to the first row of the product's next one. Slices without
    points do not exist, so a stray date costs one slice.
    """
    return previous_in_slices(in_slices(points, slice_micros))


def previous_in_slices(sliced: DataFrame) -> DataFrame:
    """The same for points that `in_slices` has dealt out; of these only one row a slice is shuffled again."""
    within = Window.partitionBy(*SLICE_KEYS).orderBy("order_date", "price")
    seen = sliced.withColumns(
        {
            "before": F.lag("price").over(within),
            "nth": F.row_number().over(within),
            "last": F.lead(F.lit(True), 1, False).over(within) == F.lit(False),
        }
    )
    # By the product itself, so that this reads the same columns as the rest does, and Spark can share the shuffle.
    in_order = Window.partitionBy("product_id").orderBy("slice")
    ends = seen.where("last").select("product_id", "product_key", "no_product", "slice", "price")
    carried = ends.select(
        "product_key", "no_product", F.lead("slice").over(in_order).alias("slice"), F.col("price").alias("carried")
    ).where(F.col("slice").isNotNull())
    previous = F.when(F.col("nth") == 1, F.col("carried")).otherwise(F.col("before"))
    # Both sides lie by slice and in its order already, so a merge costs neither shuffle nor sort of the points.
    return seen.join(carried.hint("merge"), [*SLICE_KEYS], "left").select(
        "product_id", "price", "order_date", previous.alias("previous_price")
    )


def price_change() -> Column:
    """Direction of a price against the one before it. No price on either side gives no information."""
    price, previous = F.col("price"), F.col("previous_price")
    return (
        F.when(price == previous, "same")
        .when(price > previous, "rise")
        .when(price < previous, "fall")
        .otherwise("no info")
    )
