"""Order status predicates."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.schemas import CREATED, REVERSED


def is_created() -> Column:
    return F.col("status").isin(*CREATED)


def is_reversed() -> Column:
    return F.col("status").isin(*REVERSED)


def with_status(orders: DataFrame, statuses: Iterable[str]) -> DataFrame:
    return orders.where(F.col("status").isin(*statuses))
