"""Every registered query on the bundled tables, next to the SQL that must give the same rows.

The SQL states what each result means in the plainest way (two aggregates and a full join, one window per ranking,
one self-join for pairs); the queries may get there on another road.
"""

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampType

from marketlens import jobs
from marketlens.functions import with_order_day, with_order_time, with_status
from marketlens.operators import locations, pairs, prices, ranking, totals
from marketlens.plans import kept
from marketlens.plans import pairs as pair_plans
from marketlens.plans import prices as price_plans
from marketlens.plans import sales as sales_plans
from marketlens.schemas import CREATED, ORDERS, PRODUCTS, REVERSED
from marketlens.session import settings
from marketlens.sources import files, keyed, tables
from marketlens.sources.scratch import new_folder
from marketlens.streaming import locations as streams

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# --- shared SQL ---------------------------------------------------------------------------------------------

LINES = """
lines AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer_id, n_name AS location, o_orderdate AS order_date,
         CAST(l_orderkey AS VARCHAR) AS order_id, l_extendedprice AS price,
         CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
         CASE WHEN l_linestatus = 'O' THEN 'Created' WHEN l_returnflag = 'A' THEN 'Cancelled'
              WHEN l_returnflag = 'R' THEN 'Returned' ELSE 'Verified' END AS status
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
)"""

CATALOG = """
products AS (
  SELECT p_brand AS brandname, p_type AS categoryname, CAST(p_partkey AS VARCHAR) AS productid,
         p_name AS productname
  FROM part
)"""

FEED = """
feed AS (
  SELECT CAST(user_id AS VARCHAR) AS customer_id, event_type AS location, ts AS order_date,
         CAST(event_id AS VARCHAR) AS order_id, value AS price, json_extract_string(props, '$.k') AS product_id,
         CAST(user_id AS VARCHAR) AS seller_id, 'Created' AS status
  FROM events
)"""


def _money(expression: str) -> str:
    return f"SUM(CAST({expression} AS DECIMAL(18,2)))"


def _sides(keys: Sequence[str], source: str = "lines") -> str:
    """CTEs `made` and `undone`: one aggregate per side."""
    names = ", ".join(keys)
    return f"""
made AS (
  SELECT {names}, {_money("price")} AS price, COUNT(order_id) AS amount
  FROM {source} WHERE status IN ('Created') GROUP BY {names}
), undone AS (
  SELECT {names}, {_money("price")} AS price, COUNT(order_id) AS amount
  FROM {source} WHERE status IN ('Cancelled', 'Returned') GROUP BY {names}
)"""


def _net(keys: Sequence[str], name: str = "net") -> str:
    """CTE: net and gross from a full join of `made` and `undone`."""
    names = ", ".join(f"COALESCE(m.{key}, u.{key}) AS {key}" for key in keys)
    same = " AND ".join(f"m.{key} = u.{key}" for key in keys)
    return f"""
{name} AS (
  SELECT {names},
         COALESCE(m.amount, 0) - COALESCE(u.amount, 0) AS net_sales_amount,
         CAST(COALESCE(m.price, 0) - COALESCE(u.price, 0) AS DOUBLE) AS net_sales_price,
         COALESCE(m.amount, 0) AS gross_sales_amount,
         CAST(COALESCE(m.price, 0) AS DOUBLE) AS gross_sales_price
  FROM made m FULL JOIN undone u ON {same}
)"""


DAYS = "days AS (SELECT * REPLACE (CAST(CAST(order_date AS DATE) AS TIMESTAMP) AS order_date) FROM lines)"
DAY_KEYS = ("product_id", "order_date", "seller_id")
DAILY = f"""WITH {LINES}, {DAYS}, {CATALOG}, {_sides(DAY_KEYS, "days")}, {_net(DAY_KEYS)},
sales AS (SELECT net.*, categoryname AS category_name FROM net LEFT JOIN products ON product_id = productid),
sellers AS (
  SELECT order_date, seller_id, CAST({_money("net_sales_price")} AS DOUBLE) AS net_sales_price,
         CAST(SUM(gross_sales_amount) AS BIGINT) AS gross_sales_amount
  FROM sales GROUP BY order_date, seller_id
), categories AS (
  SELECT order_date, seller_id, category_name, CAST({_money("net_sales_price")} AS DOUBLE) AS net_sales_price
  FROM sales GROUP BY order_date, seller_id, category_name
), top_sellers AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY order_date
    ORDER BY net_sales_price DESC NULLS LAST, seller_id NULLS FIRST) AS ranking FROM sellers
), top_categories AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY order_date, seller_id
    ORDER BY net_sales_price DESC NULLS LAST, category_name NULLS FIRST) AS ranking FROM categories
)"""

LAST_LINES = """
ranked AS (
  SELECT product_id, order_id, order_date, ROW_NUMBER() OVER (PARTITION BY product_id
    ORDER BY order_date DESC NULLS LAST, order_id NULLS FIRST, price NULLS FIRST, seller_id NULLS FIRST) AS ranking
  FROM lines WHERE status = 'Created'
)"""

PLACES = """
places AS (
  SELECT product_id, location, COUNT(order_id) AS total_sales_amount
  FROM lines WHERE status = 'Created' GROUP BY product_id, location
), top_places AS (
  SELECT product_id, location AS top_selling_location FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id
      ORDER BY total_sales_amount DESC, location NULLS FIRST) AS ranking FROM places)
  WHERE ranking = 1
)"""

POINTS = """
points AS (SELECT DISTINCT product_id, price, order_date FROM lines),
lagged AS (
  SELECT product_id, price, order_date, LAG(price) OVER (PARTITION BY product_id
    ORDER BY order_date NULLS FIRST, price NULLS FIRST) AS previous_price
  FROM points
)"""

VIEWS = """
sessions AS (
  SELECT CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
         json_extract_string(props, '$.k') AS product_id
  FROM events
)"""

BASKETS = """
sessions AS (SELECT CAST(l_orderkey AS VARCHAR) AS session_id, CAST(l_partkey AS VARCHAR) AS product_id FROM lineitem)
"""

PAIRS = """
SELECT a.product_id || b.product_id AS id, a.product_id AS product_id_1, b.product_id AS product_id_2,
       COUNT(a.session_id) AS frequency
FROM sessions a JOIN sessions b USING (session_id)
WHERE a.product_id < b.product_id AND length(a.product_id) = length(b.product_id) AND length(a.product_id) <= 7
GROUP BY a.product_id, b.product_id"""

SESSION_LOG = """
log AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, 'referrer' AS referrer, 'current_url' AS current_url,
         event_type AS page_type, 'product_category' AS product_category,
         'product ' || json_extract_string(props, '$.k') AS product_name, 'image_url' AS image_url,
         'col_1' AS col_1, 'col_2' AS col_2, 'col_3' AS col_3, 'currency' AS currency,
         CASE WHEN event_type = 'purchase' THEN format('{:.2f}', value) END AS cart_amount,
         'col_4' AS col_4, CAST(user_id AS VARCHAR) AS user_id,
         CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
         strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
         strftime(ts, '%H') AS hour,
         CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k') END AS product_id
  FROM events
)"""

WINDOWS = """
SELECT time_bucket(INTERVAL '10 minutes', order_date) AS window_start, location,
       COUNT(product_id) AS product_count{more}
FROM feed WHERE order_date IS NOT NULL GROUP BY 1, 2"""


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query. Times are read as UTC."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            with settings(spark, {"spark.sql.session.timeZone": "UTC"}):
                return _comparable(build(spark, sf_dir))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return build

    return register


def _comparable(df: DataFrame) -> DataFrame:
    """Times without zone and days as their midnight: the one form that every client shows alike."""
    shown = [field.name for field in df.schema if isinstance(field.dataType, (TimestampType, DateType))]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in shown}) if shown else df


# --- sources and sinks --------------------------------------------------------------------------------------

ISO_LINES = f"""WITH {LINES}
SELECT * REPLACE (strftime(order_date, '%Y-%m-%dT%H:%M:%S.%g') AS order_date) FROM lines"""


def _written_orders(spark: SparkSession, sf_dir: str) -> str:
    """The orders as JSON lines in a new folder, times as text."""
    folder = new_folder(spark, "orders-json")
    orders = tables.order_lines(spark, sf_dir)
    text = F.date_format("order_date", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    files.write_json(orders.withColumn("order_date", text), folder)
    return folder


@query("scan_orders_json", ISO_LINES)
def scan_orders_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_json(spark, _written_orders(spark, sf_dir), ORDERS)


def _written_with_bad_lines(spark: SparkSession, sf_dir: str) -> str:
    """The orders as JSON lines in a new folder, those of every fiftieth order spoiled in one of two ways."""
    folder = new_folder(spark, "orders-spoiled")
    orders = tables.order_lines(spark, sf_dir)
    orders = orders.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
    number, text = F.col("order_id").cast("long"), F.to_json(F.struct(*ORDERS.names))
    wrong = F.to_json(F.struct(F.lit("many").alias("price"), *(name for name in ORDERS.names if name != "price")))
    # Without the bracket it is no object; with a text for a price it is no order.
    spoiled = F.when(number % 100 == 0, F.substr(text, F.lit(2))).when(number % 50 == 0, wrong).otherwise(text)
    orders.select(spoiled.alias("value")).write.text(folder)
    return folder


@query("scan_orders_checked", f"SELECT * FROM ({ISO_LINES}) WHERE CAST(order_id AS BIGINT) % 50 <> 0")
def scan_orders_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The good lines of a feed with bad ones."""
    folder, quarantine = _written_with_bad_lines(spark, sf_dir), new_folder(spark, "quarantine")
    return files.read_json_checked(spark, folder, ORDERS, quarantine)[0]


@query(
    "quarantined_orders",
    f"""SELECT order_id, COUNT(*) AS n_lines, SUM(COUNT(*)) OVER ()::BIGINT AS n_counted
FROM ({ISO_LINES}) WHERE CAST(order_id AS BIGINT) % 50 = 0 GROUP BY order_id""",
)
def quarantined_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bad lines by the order id in their text, and the number that was counted as they were written."""
    folder, quarantine = _written_with_bad_lines(spark, sf_dir), new_folder(spark, "quarantine")
    _, _, bad = files.read_json_checked(spark, folder, ORDERS, quarantine)
    order_id = F.regexp_extract(files.BAD_LINE, '"order_id":"([0-9]+)"', 1).alias("order_id")
    lines = spark.read.parquet(quarantine).groupBy(order_id)
    return lines.agg(F.count(F.lit(1)).alias("n_lines"), F.lit(bad).cast("long").alias("n_counted"))


@query("scan_products_json", f"WITH {CATALOG} SELECT * FROM products")
def scan_products_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "products-json")
    files.write_json(tables.products(spark, sf_dir), folder)
    return files.read_json(spark, folder, PRODUCTS)


def _written_sessions(spark: SparkSession, sf_dir: str) -> str:
    folder = new_folder(spark, "sessions-tsv")
    log = tables.session_log(spark, sf_dir)
    log.write.option("delimiter", "\t").option("nullValue", files.NULL_MARKER).csv(folder)
    return folder


@query(
    "scan_sessions_tsv",
    f"""WITH {SESSION_LOG}
SELECT * REPLACE (COALESCE(cart_amount, '\\N') AS cart_amount, COALESCE(product_id, '\\N') AS product_id) FROM log""",
)
def scan_sessions_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_sessions(spark, _written_sessions(spark, sf_dir))


@query(
    "clean_sessions",
    f"""WITH {SESSION_LOG}
SELECT date, product_name, cart_amount, user_id, session_id, year, month, day, hour, product_id
FROM log WHERE product_id IS NOT NULL""",
)
def clean_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.clean_sessions(files.read_sessions(spark, _written_sessions(spark, sf_dir)))


@query("parse_delimited_orders", ISO_LINES)
def parse_delimited_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "orders-text")
    orders = tables.order_lines(spark, sf_dir)
    text = F.date_format("order_date", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ORDERS.names]
    orders.withColumn("order_date", text).select(F.concat_ws(",", *fields).alias("value")).write.text(folder)
    return files.parse_delimited(files.read_lines(spark, folder), ORDERS)


@query("write_json_roundtrip", f"WITH {LINES}, {_sides(['product_id'])}, {_net(['product_id'])} SELECT * FROM net")
def write_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = totals.net_gross(_lines(spark, sf_dir, "product_id", "order_id", "price", "status"), ["product_id"])
    folder = new_folder(spark, "net-gross-json")
    files.write_json(sales, folder)
    return files.read_json(spark, folder, sales.schema)


@query("keyed_table_read", f"WITH {VIEWS} {PAIRS}")
def keyed_table_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "pairs")
    pair_plans.save_product_pairs(tables.event_sessions(spark, sf_dir), folder)
    return keyed.read_keyed_table(spark, folder)


@query(
    "keyed_upsert",
    f"""WITH {VIEWS}, views AS ({PAIRS}), views_baskets AS (
  WITH {BASKETS} {PAIRS}
) SELECT * FROM views_baskets UNION ALL SELECT * FROM views WHERE id NOT IN (SELECT id FROM views_baskets)""",
)
def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of one source, then those of another on top: shared ids take the second frequency."""
    folder = new_folder(spark, "pairs")
    pair_plans.save_product_pairs(tables.event_sessions(spark, sf_dir), folder)
    pair_plans.save_product_pairs(tables.basket_sessions(spark, sf_dir), folder)
    return keyed.read_keyed_table(spark, folder)


@query(
    "product_pairs_job",
    f"""WITH {SESSION_LOG}, sessions AS (SELECT session_id, product_id FROM log WHERE product_id IS NOT NULL) {PAIRS}""",
)
def product_pairs_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job: tab-separated log, marker, filter, check, pairs, keyed table."""
    folder = new_folder(spark, "pairs")
    jobs.write_product_pairs(spark, _written_sessions(spark, sf_dir), folder)
    return keyed.read_keyed_table(spark, folder)


# --- projections and predicates -----------------------------------------------------------------------------


def _lines(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return tables.order_lines(spark, sf_dir, columns or ORDERS.names)


@query("project_columns", f"WITH {LINES} SELECT product_id, price, order_date FROM lines")
def project_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.order_lines(spark, sf_dir).select("product_id", "price", "order_date")


@query("drop_columns", f"WITH {LINES} SELECT order_id, price, product_id, seller_id, status FROM lines")
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.order_lines(spark, sf_dir).drop("customer_id", "location", "order_date")


@query(
    "rename_columns",
    f"WITH {CATALOG} SELECT brandname, categoryname AS category_name, productid AS product_id, productname FROM products",
)
def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = {"categoryname": "category_name", "productid": "product_id"}
    return tables.products(spark, sf_dir).withColumnsRenamed(renamed)


@query("filter_created", f"WITH {LINES} SELECT * FROM lines WHERE status IN ('Created')")
def filter_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_status(_lines(spark, sf_dir), CREATED)


@query("filter_reversed", f"WITH {LINES} SELECT * FROM lines WHERE status IN ('Cancelled', 'Returned')")
def filter_reversed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_status(_lines(spark, sf_dir), REVERSED)


@query("parse_order_time", f"WITH {LINES} SELECT order_id, order_date FROM lines")
def parse_order_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order time as the text a feed would hold, parsed back."""
    text = F.date_format("order_date", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return with_order_time(_lines(spark, sf_dir, "order_id", "order_date").withColumn("order_date", text))


@query("order_day", f"WITH {LINES}, {DAYS} SELECT order_id, order_date FROM days")
def order_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.date_format("order_date", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return with_order_day(_lines(spark, sf_dir, "order_id", "order_date").withColumn("order_date", text))


@query("row_count", f"WITH {VIEWS}, pairs AS ({PAIRS}) SELECT COUNT(*) AS n FROM pairs")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.count_rows(pairs.pair_frequency(tables.event_sessions(spark, sf_dir)))


# --- totals and joins ---------------------------------------------------------------------------------------

SALE = ("product_id", "order_id", "price", "status")


def _side_sql(side: str, keys: Sequence[str], label: str) -> str:
    return (
        f"SELECT {', '.join(keys)}, CAST(price AS DOUBLE) AS total_{label}_price, "
        f"amount AS total_{label}_amount FROM {side}"
    )


@query(
    "created_totals_by_product",
    f"WITH {LINES}, {_sides(['product_id'])} {_side_sql('made', ['product_id'], 'created')}",
)
def created_totals_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.created_totals(_lines(spark, sf_dir, *SALE), ["product_id"])


@query(
    "reversed_totals_by_product",
    f"WITH {LINES}, {_sides(['product_id'])} {_side_sql('undone', ['product_id'], 'cancelled')}",
)
def reversed_totals_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.reversed_totals(_lines(spark, sf_dir, *SALE), ["product_id"])


@query(
    "created_totals_by_day_seller",
    f"WITH {LINES}, {DAYS}, {_sides(DAY_KEYS, 'days')} {_side_sql('made', DAY_KEYS, 'created')}",
)
def created_totals_by_day_seller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.created_totals(_daily_lines(spark, sf_dir), DAY_KEYS)


@query(
    "reversed_totals_by_day_seller",
    f"WITH {LINES}, {DAYS}, {_sides(DAY_KEYS, 'days')} {_side_sql('undone', DAY_KEYS, 'cancelled')}",
)
def reversed_totals_by_day_seller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.reversed_totals(_daily_lines(spark, sf_dir), DAY_KEYS)


def _daily_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_order_day(_lines(spark, sf_dir, *SALE, "order_date", "seller_id"))


@query(
    "full_join_by_product",
    f"""WITH {LINES}, {_sides(['product_id'])}
SELECT COALESCE(m.product_id, u.product_id) AS product_id,
       CAST(COALESCE(m.price, 0) AS DOUBLE) AS total_created_price, COALESCE(m.amount, 0) AS total_created_amount,
       CAST(COALESCE(u.price, 0) AS DOUBLE) AS total_cancelled_price, COALESCE(u.amount, 0) AS total_cancelled_amount
FROM made m FULL JOIN undone u ON m.product_id = u.product_id""",
)
def full_join_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.full_join_totals(_lines(spark, sf_dir, *SALE), ["product_id"])


@query(
    "full_join_by_key",
    f"""WITH {LINES}, {DAYS}, {_sides(DAY_KEYS, "days")}
SELECT {", ".join(f"COALESCE(m.{key}, u.{key}) AS {key}" for key in DAY_KEYS)},
       CAST(COALESCE(m.price, 0) AS DOUBLE) AS total_created_price, COALESCE(m.amount, 0) AS total_created_amount,
       CAST(COALESCE(u.price, 0) AS DOUBLE) AS total_cancelled_price, COALESCE(u.amount, 0) AS total_cancelled_amount
FROM made m FULL JOIN undone u ON {" AND ".join(f"m.{key} = u.{key}" for key in DAY_KEYS)}""",
)
def full_join_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.full_join_totals(_daily_lines(spark, sf_dir), DAY_KEYS)


@query("net_gross_by_product", f"WITH {LINES}, {_sides(['product_id'])}, {_net(['product_id'])} SELECT * FROM net")
def net_gross_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.net_gross(_lines(spark, sf_dir, *SALE), ["product_id"])


@query("net_gross_kept", f"WITH {LINES}, {_sides(['product_id'])}, {_net(['product_id'])} SELECT * FROM net")
def net_gross_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From three loads of lines, each added to the totals of those before; the second comes twice."""
    path, lines = new_folder(spark, "totals"), _lines(spark, sf_dir, *SALE)
    for load in (0, 1, 2, 1):
        kept.add_totals(lines.where(F.col("order_id").cast("long") % 3 == load), path, ["product_id"], load)
    return kept.kept_net_gross(spark, path, ["product_id"])


@query("net_gross_by_key", f"WITH {LINES}, {DAYS}, {_sides(DAY_KEYS, 'days')}, {_net(DAY_KEYS)} SELECT * FROM net")
def net_gross_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.net_gross(_daily_lines(spark, sf_dir), DAY_KEYS)


def _daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir, *SALE, "order_date", "seller_id")
    return sales_plans.daily_sales(lines, tables.products(spark, sf_dir))


@query("join_product_category", f"""{DAILY} SELECT order_date, seller_id, product_id, category_name, net_sales_amount, net_sales_price,
gross_sales_amount, gross_sales_price FROM sales""")
def join_product_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily_sales(spark, sf_dir)


@query("daily_seller_totals", f"{DAILY} SELECT * FROM sellers")
def daily_seller_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.seller_totals(_daily_sales(spark, sf_dir))


@query("daily_seller_category_totals", f"{DAILY} SELECT * FROM categories")
def daily_seller_category_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.seller_category_totals(_daily_sales(spark, sf_dir))


@query(
    "sales_by_location",
    f"WITH {LINES}, {PLACES} SELECT * FROM places",
)
def sales_by_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.location_counts(_lines(spark, sf_dir, "product_id", "order_id", "location", "status"))


# --- rankings -----------------------------------------------------------------------------------------------


@query("rank_recent_lines", f"WITH {LINES}, {LAST_LINES} SELECT * FROM ranked WHERE ranking <= 5")
def rank_recent_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.recent_lines(_lines(spark, sf_dir, *SALE, "order_date", "seller_id"))


AVG_LINES = "SELECT product_id, COUNT(order_id) / 5.0::DOUBLE AS avg_sales_amount FROM ranked WHERE ranking <= 5 GROUP BY 1"


@query("avg_last_n_lines", f"WITH {LINES}, {LAST_LINES} {AVG_LINES}")
def avg_last_n_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.avg_recent(_lines(spark, sf_dir, "product_id", "order_id", "order_date", "status"))


@query(
    "avg_last_n_days",
    f"""WITH {LINES}, per_day AS (
  SELECT product_id, CAST(order_date AS DATE) AS day, COUNT(order_id) AS n FROM lines
  WHERE status = 'Created' AND order_date IS NOT NULL GROUP BY 1, 2
), ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY day DESC) AS ranking FROM per_day)
SELECT product_id, CAST(SUM(n) AS BIGINT) / 5.0::DOUBLE AS avg_daily_sales_last5 FROM ranked WHERE ranking <= 5 GROUP BY 1""",
)
def avg_last_n_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.avg_recent(_lines(spark, sf_dir, "product_id", "order_id", "order_date", "status"), by="day")


@query("top_location", f"WITH {LINES}, {PLACES} SELECT * FROM top_places")
def top_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_location(_lines(spark, sf_dir, "product_id", "order_id", "location", "status"))


@query("top_sellers_daily", f"{DAILY} SELECT * FROM top_sellers WHERE ranking <= 10")
def top_sellers_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_sellers(totals.seller_totals(_daily_sales(spark, sf_dir)))


@query("top_category_daily", f"{DAILY} SELECT * FROM top_categories WHERE ranking = 1")
def top_category_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_categories(totals.seller_category_totals(_daily_sales(spark, sf_dir)))


# --- reports ------------------------------------------------------------------------------------------------


@query(
    "product_sales_summary",
    f"""WITH {LINES}, {_sides(['product_id'])}, {_net(['product_id'])}, {LAST_LINES}, recent AS ({AVG_LINES}), {PLACES}
SELECT net.product_id AS productid, net_sales_amount, net_sales_price, gross_sales_amount, gross_sales_price,
       COALESCE(avg_sales_amount, 0) AS avg_sales_amount,
       COALESCE(top_selling_location, 'No city') AS top_selling_location
FROM net LEFT JOIN recent ON net.product_id = recent.product_id
LEFT JOIN top_places ON net.product_id = top_places.product_id""",
)
def product_sales_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_plans.product_sales_summary(_lines(spark, sf_dir, *SALE, "location", "order_date"))


@query(
    "daily_top_sellers",
    f"""{DAILY} SELECT order_date, seller_id, s.gross_sales_amount, c.category_name
FROM top_sellers s JOIN top_categories c USING (order_date, seller_id) WHERE s.ranking <= 10 AND c.ranking = 1""",
)
def daily_top_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir, *SALE, "order_date", "seller_id")
    return sales_plans.daily_top_sellers(lines, tables.products(spark, sf_dir))


PRICED = ("product_id", "price", "order_date")


@query("distinct_price_points", f"WITH {LINES}, {POINTS} SELECT * FROM points")
def distinct_price_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prices.distinct_price_points(_lines(spark, sf_dir, *PRICED))


@query("lag_price", f"WITH {LINES}, {POINTS} SELECT * FROM lagged")
def lag_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prices.previous_price(prices.distinct_price_points(_lines(spark, sf_dir, *PRICED)))


@query(
    "price_changes",
    f"""WITH {LINES}, {POINTS}
SELECT product_id, order_date, price,
       CASE WHEN price = previous_price THEN 'same' WHEN price > previous_price THEN 'rise'
            WHEN price < previous_price THEN 'fall' ELSE 'no info' END AS price_changes
FROM lagged""",
)
def price_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_plans.price_changes(_lines(spark, sf_dir, *PRICED))


@query("pair_frequency", f"WITH {VIEWS} {PAIRS}")
def pair_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.pair_frequency(tables.event_sessions(spark, sf_dir))


@query("pair_frequency_baskets", f"WITH {BASKETS} {PAIRS}")
def pair_frequency_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.pair_frequency(tables.basket_sessions(spark, sf_dir))


@query("product_pairs_report", f"WITH {VIEWS} {PAIRS}")
def product_pairs_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_plans.product_pairs_report(files.require_non_empty(tables.event_sessions(spark, sf_dir)))


# --- time windows and streams -------------------------------------------------------------------------------

EXACT_SELLERS = ", COUNT(DISTINCT seller_id) AS distinct_seller_count"


@query("location_window_batch", f"WITH {FEED} {WINDOWS.format(more=EXACT_SELLERS)}")
def location_window_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return locations.window_starts(locations.location_windows(tables.event_orders(spark, sf_dir), exact=True))


@query(
    "approx_distinct_sellers",
    f"""WITH {FEED} SELECT date_trunc('day', order_date)::TIMESTAMP AS window_start, location,
COUNT(DISTINCT seller_id) AS distinct_seller_count, TRUE AS within_bound
FROM feed WHERE order_date IS NOT NULL GROUP BY 1, 2""",
)
def approx_distinct_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return locations.seller_count_check(tables.event_orders(spark, sf_dir))


def _streamed(
    spark: SparkSession,
    sf_dir: str,
    shape: Callable[[DataFrame], DataFrame],
    keys: Mapping[str, str],
) -> DataFrame:
    """Stream the event feed from a folder of JSON files until all is read; the last version of every window."""
    feed, versions, checkpoint = (new_folder(spark, f"feed-{part}") for part in ("json", "versions", "progress"))
    orders = tables.event_orders(spark, sf_dir).withColumn("order_date", F.col("order_date").cast("string"))
    files.write_json(orders, feed)
    windows = streams.stream_locations(spark, feed, maxFilesPerTrigger=len(spark.read.text(feed).inputFiles()))
    keyed_windows = shape(windows.withColumns({name: F.expr(sql) for name, sql in keys.items()}))
    streams.start_versions(keyed_windows, versions, checkpoint, {"availableNow": True}).awaitTermination()
    return streams.last_versions(streams.read_versions(spark, versions, keyed_windows), list(keys))


def _checked_sellers(spark: SparkSession, sf_dir: str, found: DataFrame) -> DataFrame:
    exact = locations.location_windows(tables.event_orders(spark, sf_dir), exact=True)
    return locations.sellers_within(found, locations.window_starts(exact))


CHECKED_SELLERS = EXACT_SELLERS + ", TRUE AS within_bound"


@query("stream_location_window", f"WITH {FEED} {WINDOWS.format(more=CHECKED_SELLERS)}")
def stream_location_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In several batches, each of which changes windows of the ones before, into a table of the newest versions.

    The files are in no order of time, so the watermark is set too far back to call any row late.
    """
    feed, path, checkpoint = (new_folder(spark, f"feed-{part}") for part in ("json", "table", "progress"))
    orders = tables.event_orders(spark, sf_dir).withColumn("order_date", F.col("order_date").cast("string"))
    files.write_json(orders.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))), feed)
    at_once = -(-len(spark.read.text(feed).inputFiles()) // 4)
    windows = streams.stream_locations(spark, feed, maxFilesPerTrigger=at_once, watermark="100000 days")
    keys = ["window_start", "location"]
    # Slices of a month: the bundled events are spread thinly over one.
    streams.start_table(
        locations.window_starts(windows), path, checkpoint, keys, {"availableNow": True}, slice_seconds=30 * 86_400
    ).awaitTermination()
    return _checked_sellers(spark, sf_dir, streams.read_table(spark, path))


#: Days of a delivery, and which rows come with the one after: some at any time, some from the last hour before it.
DELIVERY_DAYS = 6
LATE = """
deliveries AS (
  SELECT *, CAST(order_id AS BIGINT) AS number,
         (epoch_us(order_date) - min(epoch_us(order_date)) OVER ()) // (6 * 86400000000) AS slice,
         (epoch_us(order_date) - min(epoch_us(order_date)) OVER ()) % (6 * 86400000000) AS within
  FROM feed WHERE order_date IS NOT NULL
), delivered AS (
  SELECT *, slice + CASE WHEN number % 10 = 3 OR number % 10 < 5 AND within >= 6 * 86400000000 - 3600000000
                    THEN 1 ELSE 0 END AS delivery FROM deliveries
), watermarks AS (
  SELECT delivery, max(max(order_date)) OVER (ORDER BY delivery ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
         - INTERVAL '20 minutes' AS watermark FROM delivered GROUP BY delivery
), timely AS (
  SELECT time_bucket(INTERVAL '10 minutes', order_date) AS window_start, location, product_id
  FROM delivered JOIN watermarks USING (delivery)
  WHERE watermark IS NULL OR time_bucket(INTERVAL '10 minutes', order_date) + INTERVAL '10 minutes' > watermark
)"""


@query(
    "late_rows_dropped",
    f"""WITH {FEED}, {LATE}
SELECT window_start, location, COUNT(product_id) AS product_count FROM timely GROUP BY 1, 2""",
)
def late_rows_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed in deliveries of some days each, a run of the stream for each, with rows that come a delivery late.

    The watermark is the usual 20 minutes, so most late rows meet a window that is over and are dropped.
    """
    feed, path, checkpoint = (new_folder(spark, f"deliveries-{part}") for part in ("json", "table", "progress"))
    orders = tables.event_orders(spark, sf_dir).where("order_date IS NOT NULL")
    first = orders.agg(F.unix_micros(F.min("order_date"))).first()[0]
    length = DELIVERY_DAYS * 86_400_000_000
    since, number = F.unix_micros("order_date") - F.lit(first), F.col("order_id").cast("long") % 10
    late = (number == 3) | ((number < 5) & (since % length >= length - 3_600_000_000))
    delivered = orders.withColumn("delivery", F.floor(since / length) + late.cast("int"))
    delivered = delivered.withColumn("order_date", F.col("order_date").cast("string"))
    last = delivered.agg(F.max("delivery")).first()[0]
    for delivery in range(last + 1):
        delivered.where(F.col("delivery") == delivery).drop("delivery").write.mode("append").json(feed)
        windows = locations.window_starts(streams.stream_locations(spark, feed))
        streams.start_table(
            windows, path, checkpoint, ["window_start", "location"], {"availableNow": True}, slice_seconds=30 * 86_400
        ).awaitTermination()
    return streams.read_table(spark, path).select("window_start", "location", "product_count")


@query(
    "sellers_from_sketches",
    f"""WITH {FEED} SELECT date_trunc('day', order_date)::TIMESTAMP AS window_start, location,
COUNT(product_id) AS product_count, COUNT(DISTINCT seller_id) AS distinct_seller_count, TRUE AS within_bound
FROM feed WHERE order_date IS NOT NULL GROUP BY 1, 2""",
)
def sellers_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different sellers of each day from the stored sketches of its ten minutes, rolled up to hours first."""
    folder, orders = new_folder(spark, "sketches"), tables.event_orders(spark, sf_dir)
    locations.seller_sketches(orders).write.parquet(folder)
    days = locations.merged_sketches(locations.merged_sketches(spark.read.parquet(folder), "1 hour"), "1 day")
    exact = locations.window_starts(locations.location_windows(orders, "1 day", exact=True))
    return locations.sellers_within(locations.sketched_sellers(days), exact, tolerance=0.05)


@query("stream_location_window_json", f"WITH {FEED} {WINDOWS.format(more=CHECKED_SELLERS)}")
def stream_location_window_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream's JSON text, parsed again for the comparison."""
    keys = {"start": "window.start", "place": "location"}
    last = _streamed(spark, sf_dir, lambda df: streams.to_json_value(df, *keys), keys)
    fields = "location string, product_count bigint, distinct_seller_count bigint, window struct<start: timestamp>"
    parsed = last.select(F.from_json("value", fields).alias("v")).select("v.*")
    return _checked_sellers(spark, sf_dir, locations.window_starts(parsed))
