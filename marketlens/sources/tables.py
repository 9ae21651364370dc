"""The bundled Parquet tables seen as orders, products, sessions and order events.

Every join here is a left join on a unique key, so an input row gives exactly one output row and
a caller that needs fewer columns can leave joins out without changing the rows.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.schemas import ORDERS, SESSIONS


# Column types of the bundled tables. A given schema saves a job per table that reads footers.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _line_status() -> Column:
    return (
        F.when(F.col("l_linestatus") == "O", "Created")
        .when(F.col("l_returnflag") == "A", "Cancelled")
        .when(F.col("l_returnflag") == "R", "Returned")
        .otherwise("Verified")
    )


def order_lines(spark: SparkSession, sf_dir: str, columns: Sequence[str] = tuple(ORDERS.names)) -> DataFrame:
    """`lineitem` as orders. Only the tables behind `columns` are read and joined.

    Orders meet customer and nation before the lines do, so the lines are shuffled at most once.
    """
    lines = table(spark, sf_dir, "lineitem")
    if {"order_date", "customer_id", "location"} & set(columns):
        heads = table(spark, sf_dir, "orders")
        if "location" in columns:
            places = table(spark, sf_dir, "customer").join(
                table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
            )
            heads = heads.join(places, F.col("o_custkey") == F.col("c_custkey"), "left")
        lines = lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    source = {
        "customer_id": lambda: F.col("o_custkey").cast("string"),
        "location": lambda: F.col("n_name"),
        "order_date": lambda: F.col("o_orderdate"),
        "order_id": lambda: F.col("l_orderkey").cast("string"),
        "price": lambda: F.col("l_extendedprice"),
        "product_id": lambda: F.col("l_partkey").cast("string"),
        "seller_id": lambda: F.col("l_suppkey").cast("string"),
        "status": _line_status,
    }
    return lines.select(*[source[name]().alias(name) for name in columns])


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`part` as products."""
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("brandname"),
        F.col("p_type").alias("categoryname"),
        F.col("p_partkey").cast("string").alias("productid"),
        F.col("p_name").alias("productname"),
    )


def _event_product() -> Column:
    return F.get_json_object("props", "$.k")


def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as views: a session is one user's day."""
    return table(spark, sf_dir, "events").select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("session_id"),
        _event_product().alias("product_id"),
    )


def basket_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` as views: a session is one order's lines."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("session_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
    )


def session_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` with all session columns: no cart amount unless bought, no product on an error page."""
    bought = F.col("event_type") == "purchase"
    failed = F.col("event_type") == "error"
    known = {
        "date": F.date_format("ts", "yyyy-MM-dd"),
        "page_type": F.col("event_type"),
        "product_name": F.concat(F.lit("product "), _event_product()),
        "cart_amount": F.when(bought, F.format_string("%.2f", "value")),
        "user_id": F.col("user_id").cast("string"),
        "session_id": F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")),
        "year": F.date_format("ts", "yyyy"),
        "month": F.date_format("ts", "MM"),
        "day": F.date_format("ts", "dd"),
        "hour": F.date_format("ts", "HH"),
        "product_id": F.when(~failed, _event_product()),
    }
    return table(spark, sf_dir, "events").select(
        *[known.get(name, F.lit(name)).alias(name) for name in SESSIONS.names]
    )


def event_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as a feed of orders: the event type is the location, the user is the seller."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("event_type").alias("location"),
        F.col("ts").cast("timestamp").alias("order_date"),
        F.col("event_id").cast("string").alias("order_id"),
        F.col("value").alias("price"),
        _event_product().alias("product_id"),
        F.col("user_id").cast("string").alias("seller_id"),
        F.lit("Created").alias("status"),
    )
