"""Product sales summary and daily top sellers."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions import SCALE, from_units, is_created, is_reversed, to_rest, to_units, with_order_day
from marketlens.operators.ranking import avg_recent, avg_recent_of_sides, top_sellers
from marketlens.operators.totals import net_and_gross, net_gross, roll_up, status_totals, with_category

NO_CITY = "No city"


def product_sales_summary(orders: DataFrame, n: int = 5, scale: int = SCALE, by: str = "line") -> DataFrame:
    """Net and gross sales, lines among the last `n` divided by `n`, and top location of each product.

    `by` "day" counts the lines of the last `n` selling days instead, as `avg_recent` does.
    Totals per product and location are made in one pass; they give both the product's totals and its top
    location. Sorted by gross amount, largest first.
    """
    by_location = status_totals(orders, ["product_id", "location"], scale)
    # Most created lines first, then location by name; a location without a created line does not compete.
    place = F.struct((-F.col("created_amount")).alias("rank"), "location")
    top_location = F.min_by("location", F.when(F.col("created_lines") > 0, place))
    by_product = roll_up(by_location, ["product_id"], top_location.alias("top_selling_location"))
    sales = net_and_gross(by_product, ["product_id"], scale)
    recent = avg_recent_of_sides(orders, n) if by == "line" else avg_recent(orders, n, by)
    recent = recent.toDF("recent_product", "avg_sales_amount")
    # A null product has neither recent lines nor locations. The join is null-safe all the same: otherwise Spark would leave
    # lines without a product out of one of the two scans, and could not shuffle once for both.
    named = F.col("product_id").isNotNull()
    known, average = (F.when(named, F.col(name)) for name in ("top_selling_location", "avg_sales_amount"))
    return (
        sales.join(recent, F.col("product_id").eqNullSafe(F.col("recent_product")), "left")
        .select(
            F.col("product_id").alias("productid"),
            "net_sales_amount",
            "net_sales_price",
            "gross_sales_amount",
            "gross_sales_price",
            F.coalesce(average, F.lit(0.0)).alias("avg_sales_amount"),
            F.coalesce(known, F.lit(NO_CITY)).alias("top_selling_location"),
        )
        .orderBy(F.desc("gross_sales_amount"), F.asc("productid"))
    )


def daily_sales(orders: DataFrame, products: DataFrame, scale: int = SCALE) -> DataFrame:
    """Net and gross sales per day, seller and product, with the product's category."""
    sales = net_gross(with_order_day(orders), ["product_id", "order_date", "seller_id"], scale)
    return with_category(sales, products).select(
        "order_date",
        "seller_id",
        "product_id",
        "category_name",
        "net_sales_amount",
        "net_sales_price",
        "gross_sales_amount",
        "gross_sales_price",
    )


def daily_top_sellers(orders: DataFrame, products: DataFrame, k: int = 10, scale: int = SCALE) -> DataFrame:
    """Each day's `k` best sellers by net price, with their gross amount and best category.

    Net is a sum over lines, so lines meet their category first and are summed straight to day, seller and
    category; these sums roll up to the seller, best category included.
    """
    made, undone = is_created(), is_reversed()
    units, rest = to_units(F.col("price"), scale), to_rest(F.col("price"), scale)
    lines = (
        with_order_day(orders)
        .where((made | undone) & F.col("order_date").isNotNull())
        .select(
            "order_date",
            "seller_id",
            "product_id",
            F.when(made, units).otherwise(-units).alias("net"),
            F.when(made, rest).otherwise(-rest).alias("net_rest"),
            F.when(made, F.col("order_id")).alias("created_id"),
        )
    )
    by_category = (
        with_category(lines, products)
        .groupBy("order_date", "seller_id", "category_name")
        .agg(
            F.coalesce(F.sum("net"), F.lit(0)).alias("net_units"),
            F.coalesce(F.sum("net_rest"), F.lit(0.0)).alias("net_rest"),
            F.count("created_id").alias("gross_sales_amount"),
        )
    )
    best = F.struct((-from_units(F.col("net_units"), F.col("net_rest"), scale)).alias("rank"), "category_name")
    by_seller = by_category.groupBy("order_date", "seller_id").agg(
        from_units(F.sum("net_units"), F.sum("net_rest"), scale).alias("net_sales_price"),
        F.sum("gross_sales_amount").alias("gross_sales_amount"),
        F.min_by("category_name", best).alias("category_name"),
    )
    # A null seller takes a rank but is not reported.
    return (
        top_sellers(by_seller, k)
        .where(F.col("seller_id").isNotNull())
        .select("order_date", "seller_id", "gross_sales_amount", "category_name")
    )
