"""Record schemas. Inputs are always read with one of these, never inferred."""

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType


def _strings(*names: str) -> list[StructField]:
    return [StructField(name, StringType()) for name in names]


# Column names and types of the input and output records.
ORDERS = StructType(
    _strings("customer_id", "location", "order_date", "order_id")
    + [StructField("price", DoubleType())]
    + _strings("product_id", "seller_id", "status")
)

PRODUCTS = StructType(_strings("brandname", "categoryname", "productid", "productname"))

SESSIONS = StructType(
    _strings(
        "date", "referrer", "current_url", "page_type", "product_category",
        "product_name", "image_url", "col_1", "col_2", "col_3",
        "currency", "cart_amount", "col_4", "user_id", "session_id",
        "year", "month", "day", "hour", "product_id",
    )
)

# Session columns that no report uses.
SESSION_DROPPED = (
    "referrer", "current_url", "page_type", "product_category", "image_url",
    "col_1", "col_2", "col_3", "col_4", "currency",
)

PAIRS = StructType(_strings("id", "product_id_1", "product_id_2") + [StructField("frequency", LongType())])

# Order statuses with a meaning here; any other status is legal.
CREATED = ("Created",)
REVERSED = ("Cancelled", "Returned")
