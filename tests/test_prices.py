from datetime import datetime

import pytest
from pyspark.sql import functions as F

from marketlens.functions import with_order_time
from marketlens.operators.prices import SLICE, distinct_price_points, in_slices, previous_in_slices, previous_price
from marketlens.plans.prices import price_changes
from marketlens.session import settings
from tests.conftest import rows_of
from tests.plain_shapes import plain_price_changes

JAN = lambda day, hour, minute=0: datetime(2021, 1, day, hour, minute)

CHANGES = [
    ("p2", JAN(5, 10), 5.0, "same"),
    ("p1", JAN(4, 10), 15.0, "rise"),
    ("p1", JAN(3, 12), 10.0, "rise"),
    ("p1", JAN(3, 10), 9.0, "fall"),
    ("p1", JAN(2, 10), 12.0, "rise"),
    ("p4", JAN(2, 9, 30), 8.0, "no info"),
    ("p3", JAN(2, 9), 7.5, "no info"),
    (None, JAN(1, 12, 30), 2.0, "rise"),
    (None, JAN(1, 12), 1.0, "no info"),
    ("p1", JAN(1, 11), 10.0, "same"),
    ("p2", JAN(1, 10, 5), 5.0, "no info"),
    ("p1", JAN(1, 10), 10.0, "no info"),
    ("p5", None, 3.0, "no info"),
]


@pytest.mark.parametrize("slicing", [{}, {"slice_micros": 1}, {"slice_micros": 86_400_000_000}])
def test_changes(orders, slicing):
    got = price_changes(orders.withColumn("order_date", F.col("order_date")), **slicing)
    shown = got.withColumn("order_date", F.col("order_date").cast("timestamp_ntz"))
    assert [tuple(row) for row in shown.collect()] == CHANGES


@pytest.mark.parametrize(
    "slicing",
    [
        {},
        {"slice_micros": 1_000_000},
        {"slice_micros": 7 * 3_600_000_000},
        {"slice_micros": 400 * 86_400_000_000},
    ],
)
def test_slices_do_not_change_the_result(messy_orders, slicing):
    """Null products, null times, null prices, many prices at one time, and slices without a row."""
    assert rows_of(price_changes(messy_orders, **slicing)) == rows_of(plain_price_changes(messy_orders))


def _points(spark, last="timestamp_seconds(id * 60)"):
    """5,000 minutes of one product, at most 60 to an hour."""
    return spark.sql(f"SELECT 'hot' AS product_id, id / 100 AS price, {last} AS order_date FROM range(5000)")


@pytest.mark.parametrize("last", ["timestamp_seconds(id * 60)", "if(id = 4999, timestamp'9999-01-01', timestamp_seconds(id * 60))"])
def test_a_large_product_is_spread(spark, last):
    """Also with one date that is far off."""
    points = _points(spark, last)
    per_slice = points.groupBy(F.floor(F.unix_micros("order_date") / SLICE)).count()
    assert per_slice.agg(F.max("count")).first()[0] == 60
    lagged = previous_price(points)
    windows = [line for line in lagged._jdf.queryExecution().optimizedPlan().toString().splitlines() if "lag(price" in line]
    assert windows and all("slice" in line.split("],")[-2] for line in windows)  # the one product is a constant here
    assert lagged.where("previous_price IS NULL").count() == 1
    assert lagged.where("round((price - previous_price) * 100) = 1").count() == 4999


def test_many_hot_products(spark):
    points = spark.sql(
        "SELECT if(p = 0, NULL, p) AS product_id, CAST(id AS DOUBLE) AS price, "
        "if(id = 0, NULL, timestamp_seconds(id * 600)) AS order_date FROM range(20), range(1001) AS r(p)"
    )
    lagged = previous_price(points)
    assert lagged.where("previous_price = price - 1").count() == 19 * 1001
    assert lagged.where("previous_price IS NULL").count() == 1001


def test_points_are_distinct(orders):
    assert distinct_price_points(orders).count() == 13


def test_price_points_are_shuffled_by_few_keys(messy_orders):
    """Distinct points, last prices, their order, and the lag: four shuffles at most, and no broadcast."""
    changes = previous_price(distinct_price_points(messy_orders))
    changes.collect()
    plan = changes._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    own = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert 0 < len(own) <= 5 and "Broadcast" not in plan


def exchanges(df):
    """The shuffles of a plan as Spark would run it without looking at sizes, those that are shared once."""
    with settings(df.sparkSession, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    return [line.strip(" :+-") for line in plan.split("\n") if line.strip(" :+-").startswith("Exchange ")]


def test_points_are_shuffled_once(messy_orders):
    """Equal points, the order within slices and the ends of slices come from one shuffle."""
    found = exchanges(previous_in_slices(in_slices(with_order_time(messy_orders)).distinct()))
    assert sum("REPARTITION_BY_COL" in line for line in found) == 1  # the points
    assert len(found) == 3  # and the ends of slices: by product, then to the next slice
    assert len(exchanges(previous_price(distinct_price_points(messy_orders)))) == 4
