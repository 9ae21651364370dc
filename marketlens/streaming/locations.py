"""Orders and distinct sellers per location and ten minutes, as a stream.

The stream runs in update mode: each batch emits the windows it changed, so a window appears in several versions
and the last one counts.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlens.operators.locations import location_windows
from marketlens.sources.files import read_order_stream
from marketlens.sources.keyed import read_keyed_table, upsert_by_key

WATERMARK = "20 minutes"
WINDOW = "10 minutes"
TRIGGER = "20 seconds"
#: Seconds of window starts that a bucket of the table of newest versions holds: a day.
TABLE_SLICE = 86_400
#: Columns of that table which tell versions apart.
VERSION_KEY, BATCH = "version_key", "batch"
#: Session settings that keep the state of a stream on local disk, with a log of changes in the checkpoint for every
#: batch, in place of the executors' heap. A stream keeps the kind of store it began with.
DISK_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
JSON_COLUMNS = ("location", "product_count", "distinct_seller_count", "window")


def stream_locations(
    spark: SparkSession, path: str, watermark: str = WATERMARK, size: str = WINDOW, **options: object
) -> DataFrame:
    return location_windows(read_order_stream(spark, path, **options), size, watermark)


def to_json_value(windows: DataFrame, *keep: str) -> DataFrame:
    """One text column `value`, the form a message queue takes, after the columns to keep."""
    return windows.select(*keep, F.to_json(F.struct(*JSON_COLUMNS)).alias("value"))


def start_stream(
    df: DataFrame,
    format: str,
    options: Mapping[str, str],
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Start writing to any sink that takes update mode (`kafka`, `console`, `memory`)."""
    return (
        df.writeStream.format(format)
        .options(**options)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .start()
    )


def start_versions(
    df: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, object] | None = None
) -> StreamingQuery:
    """Start writing every batch to its own folder under `path`.

    A batch that runs again after a failure replaces its folder, so each version is kept once.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        df.writeStream.foreachBatch(write_batch)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .start()
    )


def read_versions(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """All batches written by `start_versions`, with their number in `batch`."""
    return spark.read.schema(like.schema.add("batch", "long")).option("basePath", path).parquet(path)


def last_versions(versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest version of every key."""
    values = [name for name in versions.columns if name not in (*keys, "batch")]
    newest = F.max_by(F.struct(*values), "batch").alias("newest")
    return versions.groupBy(*keys).agg(newest).select(*keys, "newest.*")


def put_versions(batch: DataFrame, batch_id: int, path: str, keys: Sequence[str], slice_seconds: int = TABLE_SLICE) -> int:
    """Bring one batch into the table of newest versions at `path`; the number of rows brought in.

    The first of `keys` is the start of the window. The table is cut by it, so a batch rewrites only the slices whose
    windows it has changed. Of two versions of a key the one of the later batch stays, so a batch that comes again
    changes nothing, whenever it does.
    """
    key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    rows = batch.withColumns({VERSION_KEY: key, BATCH: F.lit(batch_id).cast("long")})
    start = F.floor(F.unix_seconds(F.col(keys[0]).cast("timestamp")) / slice_seconds)
    return upsert_by_key(rows, path, VERSION_KEY, unique=True, bucket=start, newer=BATCH)


def start_table(
    df: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    trigger: Mapping[str, object] | None = None,
    slice_seconds: int = TABLE_SLICE,
) -> StreamingQuery:
    """Start keeping the newest version of every key in one table, whose size is that of the result, not of its history.

    `keys` are columns of `df`, the start of the window first.
    """
    return (
        df.writeStream.foreachBatch(lambda batch, batch_id: put_versions(batch, batch_id, path, keys, slice_seconds) and None)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .start()
    )


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of every key that `start_table` has kept."""
    return read_keyed_table(spark, path).drop(VERSION_KEY, BATCH)


def held_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows a stream still keeps as state after its last batch: window, location and the partition that has them."""
    return spark.read.format("statestore").load(checkpoint).select("key.window", "key.location", "partition_id")
