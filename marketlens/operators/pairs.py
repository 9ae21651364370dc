"""Products that occur in the same session."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sessions with more products (of one id length) than this are joined in blocks of about this many.
BLOCK = 500


def session_products(sessions: DataFrame, max_len: int = 7) -> DataFrame:
    """How often each session shows each product. Repeats are folded here, before any join."""
    return (
        sessions.where(F.col("session_id").isNotNull() & (F.length("product_id") <= max_len))
        .groupBy("session_id", "product_id")
        .agg(F.count(F.lit(1)).alias("views"))
    )


def _blocks(views: DataFrame, block: int) -> DataFrame:
    """Number of blocks of each session, by id length.

    Counting `views > 0` (always true) instead of rows keeps this plan's input identical to the join's input, so
    Spark reuses that shuffle and reads the sessions once.
    """
    sizes = views.groupBy("session_id", F.length("product_id").alias("id_length")).agg(
        F.count_if(F.col("views") > 0).alias("products")
    )
    return sizes.select("session_id", "id_length", F.ceil(F.col("products") / F.lit(block)).cast("int").alias("blocks"))


def pair_frequency(sessions: DataFrame, max_len: int = 7, block: int = BLOCK) -> DataFrame:
    """How often two products with ids of equal length meet in a session.

    A session that shows one product m times and the other n times counts m * n times. The products of every
    session are dealt into blocks, one for a small session, and each pair of blocks (a cell) is a join key of its own:
    the work on one session spreads over many tasks and one key has about 2 * `block` rows at most.
    """
    views = session_products(sessions, max_len)
    own = F.pmod(F.xxhash64("product_id"), F.col("blocks")).cast("int")
    cells = (
        views.withColumn("id_length", F.length("product_id"))
        .join(_blocks(views, block), ["session_id", "id_length"])
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "session_id",
            "id_length",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            "own",
            "product_id",
            "views",
        )
    )
    key = ["session_id", "id_length", "low", "high"]
    # Two products of one block meet in every cell of that block; the cell on the diagonal counts them.
    counted_here = (F.col("a.own") != F.col("b.own")) | (F.col("low") == F.col("high"))
    return (
        cells.alias("a")
        .join(cells.alias("b"), key)
        .where((F.col("a.product_id") < F.col("b.product_id")) & counted_here)
        .groupBy(F.col("a.product_id").alias("product_id_1"), F.col("b.product_id").alias("product_id_2"))
        .agg(F.sum(F.col("a.views") * F.col("b.views")).alias("frequency"))
        .select(
            F.concat("product_id_1", "product_id_2").alias("id"), "product_id_1", "product_id_2", "frequency"
        )
    )
