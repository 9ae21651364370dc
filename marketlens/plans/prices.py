"""Price changes of each product over time."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions import with_order_time
from marketlens.operators.prices import in_slices, previous_in_slices, price_change


def price_changes(orders: DataFrame, **slicing: int) -> DataFrame:
    """Every distinct price point and its direction against the one before, newest first.

    Points are dealt out to slices first; equal ones meet there, so finding them takes no shuffle of its own.
    """
    return (
        previous_in_slices(in_slices(with_order_time(orders), **slicing).distinct())
        .select("product_id", "order_date", "price", price_change().alias("price_changes"))
        .orderBy(F.desc("order_date"), F.asc("product_id"), F.asc("price"))
    )
