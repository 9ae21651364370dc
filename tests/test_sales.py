from datetime import date

import pytest
from pyspark.sql import functions as F

from marketlens.functions import with_order_day, with_order_time, with_status
from marketlens.operators.ranking import avg_recent, recent_lines, top_k, top_location
from marketlens.operators.totals import (
    count_rows,
    created_totals,
    full_join_totals,
    location_counts,
    net_gross,
    reversed_totals,
    seller_category_totals,
    seller_totals,
    with_category,
)
from marketlens.plans.kept import add_totals, kept_net_gross
from marketlens.plans.sales import daily_sales, daily_top_sellers, product_sales_summary
from marketlens.schemas import CREATED, REVERSED
from tests.conftest import rows_of
from tests.plain_shapes import plain_net_gross, plain_summary, plain_top_sellers

SUMMARY = [
    ("p1", 5, 56.0, 6, 66.0, 1.0, "Ankara"),
    ("p2", 2, 10.0, 2, 10.0, 0.4, "Ankara"),
    (None, 1, 1.0, 1, 1.0, 0.0, "No city"),
    ("p5", 1, 3.0, 1, 3.0, 0.2, "Izmir"),
    (None, -1, -2.0, 0, 0.0, 0.0, "No city"),
    ("p3", -1, -7.5, 0, 0.0, 0.0, "No city"),
]

TOP_SELLERS = [
    (date(2021, 1, 1), "s1", 4, "electronics"),
    (date(2021, 1, 1), "s2", 1, "electronics"),
    (date(2021, 1, 2), "s2", 1, "electronics"),
    (date(2021, 1, 3), "s1", 1, "electronics"),
    (date(2021, 1, 4), "s1", 1, "electronics"),
    (date(2021, 1, 5), "s2", 1, "home"),
]


def test_status_filters(orders):
    assert with_status(orders, CREATED).count() == 10
    assert with_status(orders, REVERSED).count() == 3


def test_totals_of_each_side(orders):
    assert rows_of(created_totals(orders, ["product_id"])) == [
        ("p1", 66.0, 6), ("p2", 10.0, 2), ("p5", 3.0, 1), (None, 1.0, 1),
    ]
    assert rows_of(reversed_totals(orders, ["product_id"])) == [("p1", 10.0, 1), ("p3", 7.5, 1), (None, 2.0, 1)]


def test_full_join_keeps_one_sided_and_null_keys_apart(orders):
    assert rows_of(full_join_totals(orders, ["product_id"])) == [
        ("p1", 66.0, 6, 10.0, 1),
        ("p2", 10.0, 2, 0.0, 0),
        ("p3", 0.0, 0, 7.5, 1),
        ("p5", 3.0, 1, 0.0, 0),
        (None, 0.0, 0, 2.0, 1),
        (None, 1.0, 1, 0.0, 0),
    ]


@pytest.mark.parametrize("keys", [["product_id"], ["product_id", "order_date", "seller_id"]])
def test_one_pass_net_gross_equals_the_full_join(messy_orders, keys):
    days = with_order_day(messy_orders)
    got = net_gross(days, keys)
    assert rows_of(got) == rows_of(plain_net_gross(days, keys))
    assert got.where(F.col("product_id").isNull()).count() > 1


def test_net_gross_scans_once(messy_orders):
    plan = net_gross(messy_orders, ["product_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "Join" not in plan


def _priced(spark, *prices):
    rows = [("p", f"o{k}", price, "Created") for k, price in enumerate(prices)]
    return spark.createDataFrame(rows, "product_id string, order_id string, price double, status string")


@pytest.mark.parametrize("scale", [2, 3])
def test_finer_prices_lose_nothing(spark, scale):
    prices = _priced(spark, 0.125, 0.25)
    assert created_totals(prices, ["product_id"], scale=scale).first()["total_created_price"] == 0.375
    assert net_gross(prices, ["product_id"], scale).first()["net_sales_price"] == 0.375
    one = created_totals(_priced(spark, 0.125), ["product_id"]).first()
    assert one["total_created_price"] == 0.125


def test_many_small_prices(spark):
    prices = _priced(spark, *[0.004] * 1000)
    assert created_totals(prices, ["product_id"]).first()["total_created_price"] == pytest.approx(4.0, abs=1e-9)
    assert net_gross(prices, ["product_id"]).first()["gross_sales_price"] == pytest.approx(4.0, abs=1e-9)


def test_two_decimals_are_exact_in_any_order(spark):
    prices = _priced(spark, *[0.1] * 1000, 1e6 + 0.07)
    assert created_totals(prices, ["product_id"]).first()["total_created_price"] == 1000100.07


@pytest.mark.parametrize(
    ("prices", "total"),
    [((float("nan"), 1.0), float("nan")), ((float("inf"), 1.0), float("inf")), ((1e300, 1.0), 1e300), ((None, 1.5), 1.5)],
)
def test_prices_that_are_no_numbers_of_units(spark, prices, total):
    for got in (
        created_totals(_priced(spark, *prices), ["product_id"]).first()["total_created_price"],
        net_gross(_priced(spark, *prices), ["product_id"]).first()["net_sales_price"],
    ):
        assert got == total or (got != got and total != total)


def test_summary(orders):
    assert [tuple(row) for row in product_sales_summary(orders).collect()] == SUMMARY


def test_summary_equals_the_plain_shape(messy_orders):
    got = product_sales_summary(messy_orders)
    assert rows_of(got) == rows_of(plain_summary(messy_orders))
    assert [name for name, _ in got.dtypes] == [
        "productid", "net_sales_amount", "net_sales_price", "gross_sales_amount", "gross_sales_price",
        "avg_sales_amount", "top_selling_location",
    ]
    assert {kind for _, kind in got.dtypes} == {"string", "bigint", "double"}


def test_averages_over_lines_and_days(orders):
    assert rows_of(avg_recent(orders)) == [("p1", 1.0), ("p2", 0.4), ("p5", 0.2), (None, 0.2)]
    assert rows_of(avg_recent(orders, by="day")) == [("p1", 1.2), ("p2", 0.4), (None, 0.2)]
    with pytest.raises(ValueError):
        avg_recent(orders, by="week")


def test_recent_lines_are_cut_before_the_shuffle(orders):
    plan = recent_lines(orders)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert rows_of(recent_lines(orders).where("product_id = 'p2'")) == [
        ("p2", "o6", "2021-01-01T10:05:00.000Z", 2), ("p2", "o9", "2021-01-05T10:00:00.000Z", 1),
    ]


def test_locations(orders):
    assert ("p1", "Ankara", 4) in rows_of(location_counts(orders))
    assert rows_of(top_location(orders)) == [
        ("p1", "Ankara"), ("p2", "Ankara"), ("p5", "Izmir"), (None, "Izmir"),
    ]


def test_top_k_cuts_each_group(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    assert rows_of(top_k(rows, ["g"], [F.desc("id")], 2).select("g", "id")) == [
        (0, 96), (0, 99), (1, 94), (1, 97), (2, 95), (2, 98),
    ]


def test_duplicate_product_ids_multiply_sales(orders, products):
    doubled = products.unionByName(products.withColumn("categoryname", F.lit("other")))
    sales = net_gross(orders, ["product_id"])
    assert with_category(sales, doubled).where("product_id = 'p1'").count() == 2
    got = daily_top_sellers(orders, doubled).where("seller_id = 's1' and order_date = '2021-01-04'").first()
    assert got["gross_sales_amount"] == 2


def test_daily_top_sellers(orders, products):
    got = daily_top_sellers(orders, products)
    assert dict(got.dtypes)["order_date"] == "date"
    assert rows_of(got) == TOP_SELLERS


@pytest.mark.parametrize("k", [2, 10])
def test_daily_top_sellers_equals_the_plain_shape(spark, messy_orders, k):
    products = spark.sql(
        "SELECT 'b' AS brandname, concat('cat', id % 3) AS categoryname, concat('p', id % 20) AS productid, "
        "'n' AS productname FROM range(25) UNION ALL SELECT 'b', NULL, 'hot', 'n'"
    )
    from marketlens.operators import ranking

    sales = daily_sales(messy_orders, products)
    sellers = ranking.top_sellers(seller_totals(sales), k).select("order_date", "seller_id", "gross_sales_amount")
    best = ranking.top_categories(seller_category_totals(sales)).select("order_date", "seller_id", "category_name")
    expected = rows_of(sellers.join(best, ["order_date", "seller_id"]))
    assert rows_of(daily_top_sellers(messy_orders, products, k)) == expected
    if k == 10:
        assert expected == rows_of(plain_top_sellers(messy_orders, products))


def test_null_seller_takes_a_rank_but_is_not_reported(spark, products):
    rows = [("p1", "o1", 9.0, None, "Created"), ("p1", "o2", 5.0, "s1", "Created"), ("p1", "o3", 1.0, "s2", "Created")]
    lines = spark.createDataFrame(
        rows, "product_id string, order_id string, price double, seller_id string, status string"
    ).withColumn("order_date", F.lit("2021-01-01"))
    got = daily_top_sellers(lines, products, k=2).select("seller_id")
    assert rows_of(got) == [("s1",)]


def test_unreadable_time_is_null(orders):
    times = with_order_time(orders).where("order_id = 'o12'").first()
    assert times["order_date"] is None
    assert with_order_day(orders).where("order_id = 'o1'").first()["order_date"] == date(2021, 1, 1)


def test_count_rows(orders):
    assert count_rows(orders).first()["n"] == 14


@pytest.mark.parametrize("keys", [["product_id"], ["product_id", "location"]])
def test_kept_totals_equal_a_full_run(spark, messy_orders, tmp_path, keys):
    """After every load, with null keys and hot ones; a load that comes again does not count twice."""
    path = str(tmp_path / "totals")
    part = F.pmod(F.xxhash64("customer_id", "order_date", "price"), F.lit(3))
    seen = messy_orders.where("false")
    for load in range(3):
        lines = messy_orders.where(part == load)
        seen = seen.union(lines)
        for _ in range(2 if load == 1 else 1):
            assert add_totals(lines, path, keys, load, buckets=4, bucket_rows=5) > 0
            assert rows_of(kept_net_gross(spark, path, keys)) == rows_of(net_gross(seen, keys))
