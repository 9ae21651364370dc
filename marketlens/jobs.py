"""The five jobs end to end: from input paths to written results.

For example `python -m marketlens.jobs product-summary --orders in/orders --out out/summary`.
"""

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from marketlens.functions import SCALE
from marketlens.operators.locations import window_starts
from marketlens.plans.pairs import save_product_pairs
from marketlens.plans.prices import price_changes
from marketlens.plans.sales import daily_top_sellers, product_sales_summary
from marketlens.schemas import ORDERS, PRODUCTS
from marketlens.session import settings
from marketlens.sources.files import clean_sessions, read_json, read_sessions, write_json
from marketlens.streaming.locations import (
    DISK_STATE,
    TRIGGER,
    WATERMARK,
    WINDOW,
    start_stream,
    start_table,
    start_versions,
    stream_locations,
    to_json_value,
)


def write_product_summary(
    spark: SparkSession, orders: str, out: str, single_file: bool = False, n: int = 5, by: str = "line", scale: int = SCALE
) -> None:
    write_json(product_sales_summary(read_json(spark, orders, ORDERS), n, scale, by), out, single_file)


def write_top_sellers(
    spark: SparkSession,
    orders: str,
    products: str,
    out: str,
    single_file: bool = False,
    k: int = 10,
    scale: int = SCALE,
) -> None:
    report = daily_top_sellers(read_json(spark, orders, ORDERS), read_json(spark, products, PRODUCTS), k, scale)
    write_json(report, out, single_file)


def write_price_changes(spark: SparkSession, orders: str, out: str, single_file: bool = False) -> None:
    write_json(price_changes(read_json(spark, orders, ORDERS)), out, single_file)


def write_product_pairs(
    spark: SparkSession, sessions: str, out: str, format: str | None = None, option: Sequence[str] = ()
) -> int:
    options = dict(pair.split("=", 1) for pair in option)
    return save_product_pairs(clean_sessions(read_sessions(spark, sessions)), out, format=format, **options)


def start_location_counts(
    spark: SparkSession,
    orders: str,
    checkpoint: str,
    servers: str | None = None,
    topic: str | None = None,
    out: str | None = None,
    table: str | None = None,
    trigger: str = TRIGGER,
    watermark: str = WATERMARK,
    window: str = WINDOW,
    files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Counts per location and window: JSON messages on a topic (needs Spark's Kafka package) or in a folder a batch at
    `out`, or the newest counts of each window in one `table`.

    `trigger` is an interval, or `once` for all that is there now.
    """
    if not (out or table or servers and topic):
        raise ValueError("the counts need servers and a topic, a folder, or a table")
    windows = stream_locations(spark, orders, watermark, window, maxFilesPerTrigger=files_per_trigger)
    when = {"availableNow": True} if trigger == "once" else {"processingTime": trigger}
    with settings(spark, DISK_STATE):  # a stream keeps the settings it began with
        if table:
            return start_table(window_starts(windows), table, checkpoint, ["window_start", "location"], when)
        if out:
            return start_versions(to_json_value(windows), out, checkpoint, when)
        options = {"kafka.bootstrap.servers": servers, "topic": topic}
        return start_stream(to_json_value(windows), "kafka", options, checkpoint, when)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="marketlens.jobs")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("product-summary", "top-sellers", "price-changes"):
        job = jobs.add_parser(name)
        job.add_argument("--orders", required=True)
        if name == "top-sellers":
            job.add_argument("--products", required=True)
        job.add_argument("--out", required=True)
        job.add_argument("--single-file", action="store_true")
        if name == "product-summary":
            job.add_argument("--n", type=int, default=5, help="lines or days that the average is of")
            job.add_argument("--by", choices=("line", "day"), default="line")
        if name == "top-sellers":
            job.add_argument("--k", type=int, default=10, help="sellers of a day")
        if name != "price-changes":
            job.add_argument("--scale", type=int, default=SCALE, help="decimals of prices that are summed exactly")
    pairs = jobs.add_parser("product-pairs")
    pairs.add_argument("--sessions", required=True)
    pairs.add_argument("--out", required=True)
    pairs.add_argument("--format")
    pairs.add_argument("--option", action="append", default=[], help="name=value, for the connector")
    counts = jobs.add_parser("location-counts")
    for name in ("orders", "checkpoint"):
        counts.add_argument(f"--{name}", required=True)
    for name in ("servers", "topic", "out", "table"):
        counts.add_argument(f"--{name}")
    for name, usual in (("trigger", TRIGGER), ("watermark", WATERMARK), ("window", WINDOW)):
        counts.add_argument(f"--{name}", default=usual)
    counts.add_argument("--files-per-trigger", type=int, default=1000)
    return parser


RUN = {
    "product-summary": write_product_summary,
    "top-sellers": write_top_sellers,
    "price-changes": write_price_changes,
    "product-pairs": write_product_pairs,
    "location-counts": lambda *args, **kwargs: start_location_counts(*args, **kwargs).awaitTermination(),
}


def main(arguments: list[str] | None = None) -> None:
    given = vars(_parser().parse_args(arguments))
    spark = SparkSession.builder.appName("marketlens").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    RUN[given.pop("job")](spark, **given)


if __name__ == "__main__":
    main()
