"""One local session for all tests, and the hand-made rows."""

import json
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

from marketlens.schemas import ORDERS, PRODUCTS

TESTDATA = Path("/root/testdata")

# customer, location, time, order, price, product, seller, status
ORDER_ROWS = [
    ("c1", "Izmir", "2021-01-01T10:00:00.000Z", "o1", 10.0, "p1", "s1", "Created"),
    ("c1", "Izmir", "2021-01-01T11:00:00.000Z", "o2", 10.0, "p1", "s1", "Created"),
    ("c2", "Ankara", "2021-01-02T10:00:00.000Z", "o3", 12.0, "p1", "s2", "Created"),
    ("c2", "Ankara", "2021-01-03T10:00:00.000Z", "o4", 9.0, "p1", "s1", "Created"),
    ("c3", "Izmir", "2021-01-03T12:00:00.000Z", "o5", 10.0, "p1", "s1", "Returned"),
    ("c1", "Izmir", "2021-01-01T10:05:00.000Z", "o6", 5.0, "p2", "s1", "Created"),
    ("c2", "Bursa", "2021-01-02T09:00:00.000Z", "o7", 7.5, "p3", "s2", "Cancelled"),
    ("c2", "Bursa", "2021-01-02T09:30:00.000Z", "o8", 8.0, "p4", "s2", "Verified"),
    ("c3", "Ankara", "2021-01-05T10:00:00.000Z", "o9", 5.0, "p2", "s2", "Created"),
    ("c3", "Izmir", "2021-01-01T12:00:00.000Z", "o10", 1.0, None, "s1", "Created"),
    ("c3", "Izmir", "2021-01-01T12:30:00.000Z", "o11", 2.0, None, "s1", "Returned"),
    ("c4", "Izmir", "not-a-date", "o12", 3.0, "p5", "s1", "Created"),
    ("c4", "Ankara", "2021-01-01T10:00:00.000Z", "o13", 10.0, "p1", "s2", "Created"),
    ("c4", "Ankara", "2021-01-04T10:00:00.000Z", "o14", 15.0, "p1", "s1", "Created"),
]

PRODUCT_ROWS = [("b1", "electronics", "p1", "one"), ("b1", "home", "p2", "two"), ("b2", "home", "p3", "three")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory: pytest.TempPathFactory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]")
        .appName("marketlens-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def orders(spark: SparkSession, tmp_path_factory: pytest.TempPathFactory) -> DataFrame:
    """The hand-made orders, read from JSON lines; null fields are left out of the text."""
    folder = tmp_path_factory.mktemp("orders")
    lines = [
        json.dumps({name: value for name, value in zip(ORDERS.names, row) if value is not None})
        for row in ORDER_ROWS
    ]
    (folder / "orders.json").write_text("\n".join(lines))
    return spark.read.schema(ORDERS).json(str(folder))


@pytest.fixture(scope="session")
def products(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PRODUCT_ROWS, PRODUCTS)


@pytest.fixture(scope="session")
def messy_orders(spark: SparkSession) -> DataFrame:
    """Many rows with null keys, null prices and ids, repeats, ties and one product with a third of all rows."""
    return spark.sql(
        """
        SELECT concat('c', id % 7) AS customer_id,
               CASE WHEN h % 11 = 0 THEN NULL ELSE concat('city', h % 5) END AS location,
               CASE WHEN h % 53 = 0 THEN 'never'
                    ELSE date_format(timestamp_seconds(1600000000 + (h % 400) * 3600), "yyyy-MM-dd'T'HH:mm:ss'Z'")
               END AS order_date,
               CASE WHEN h % 13 = 0 THEN NULL ELSE concat('o', id) END AS order_id,
               CASE WHEN h % 17 = 0 THEN NULL ELSE CAST(h % 900 AS DOUBLE) / 100 END AS price,
               CASE WHEN id % 3 = 0 THEN 'hot' WHEN h % 19 = 0 THEN NULL ELSE concat('p', h % 23) END AS product_id,
               CASE WHEN h % 29 = 0 THEN NULL ELSE concat('s', h % 14) END AS seller_id,
               element_at(array('Created', 'Cancelled', 'Returned', 'Verified', 'Created'), CAST(h % 5 + 1 AS INT))
                 AS status
        FROM (SELECT id, pmod(xxhash64(id), 1000003) AS h FROM range(3000))
        """
    )


def rows_of(df: DataFrame) -> list[tuple]:
    """Rows in a fixed order, nulls last."""
    rows = [tuple(row) for row in df.collect()]
    return sorted(rows, key=lambda row: [(value is None, str(value)) for value in row])
