"""Totals that are kept up to date from the order lines of each load, without a scan of those before."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions import SCALE
from marketlens.operators.totals import PARTS, net_and_gross, status_totals
from marketlens.sources.keyed import read_keyed_table, upsert_by_key

#: Columns of the stored table besides the keys and the parts.
TOTAL_KEY, LOAD = "total_key", "load"


def add_totals(orders: DataFrame, path: str, keys: Sequence[str], load: int, scale: int = SCALE, **options: object) -> int:
    """Add the created and reversed totals of new order lines to those stored at `path`; the number of keys brought in.

    `load` numbers the loads upwards. One that comes again, also after it has broken off, does not count twice. Null keys
    are keys of their own. A line belongs to one load.
    """
    key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    totals = status_totals(orders, keys, scale).withColumns({TOTAL_KEY: key, LOAD: F.lit(load).cast("long")})
    return upsert_by_key(totals, path, TOTAL_KEY, unique=True, newer=LOAD, add=PARTS, **options)


def kept_totals(spark: SparkSession, path: str) -> DataFrame:
    """The stored totals as `status_totals` gives them for the lines of all loads."""
    return read_keyed_table(spark, path).drop(TOTAL_KEY, LOAD)


def kept_net_gross(spark: SparkSession, path: str, keys: Sequence[str], scale: int = SCALE) -> DataFrame:
    """Net and gross of each key as of the last load."""
    return net_and_gross(kept_totals(spark, path), keys, scale)
