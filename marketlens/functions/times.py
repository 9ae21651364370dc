"""Order time as a timestamp or a day. Text that is no time becomes null, it does not stop the job."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _order_time(orders: DataFrame) -> Column:
    if isinstance(orders.schema["order_date"].dataType, StringType):
        return F.try_to_timestamp("order_date")
    return F.col("order_date").cast("timestamp")


def with_order_time(orders: DataFrame, name: str = "order_date") -> DataFrame:
    """`order_date` as a timestamp, put into column `name`."""
    return orders.withColumn(name, _order_time(orders))


def with_order_day(orders: DataFrame) -> DataFrame:
    """`order_date` cut down to its day."""
    return orders.withColumn("order_date", F.to_date(_order_time(orders)))
