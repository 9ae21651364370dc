"""JSON, delimited text and JSON-directory stream inputs, and the JSON output."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader, StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from marketlens.schemas import ORDERS, SESSION_DROPPED, SESSIONS

NULL_MARKER = "\\N"


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines with a given schema; an absent or null field is null."""
    return spark.read.schema(schema).json(path)


#: Column of `checked_records` that has the text of a line which is no record.
BAD_LINE = "bad_line"


def checked_records(lines: DataFrame, schema: StructType) -> DataFrame:
    """JSON lines (column `value`) as records, and the text of each line that is none in `bad_line`.

    A line is bad if it is no JSON object, or has a value that is not of its field's type; its fields are null then or as far
    as they could be read. Empty lines are left out. Other columns of `lines` stay, in front.
    """
    with_text = StructType([*schema, StructField(BAD_LINE, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}
    parsed = lines.where(F.trim("value") != "").withColumn("record", F.from_json("value", with_text, options))
    return parsed.select(*(name for name in lines.columns if name != "value"), "record.*")


def good_records(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(BAD_LINE).isNull()).drop(BAD_LINE)


def bad_lines(checked: DataFrame) -> DataFrame:
    """The other columns than those of the record, and the text of each bad line."""
    return checked.where(F.col(BAD_LINE).isNotNull())


def _lines_and_files(reader: DataFrameReader | DataStreamReader, path: str) -> DataFrame:
    return reader.text(path).select(F.col("_metadata.file_path").alias("file"), "value")


def read_json_checked(spark: SparkSession, path: str, schema: StructType, quarantine: str) -> tuple[DataFrame, int, int]:
    """The records of JSON lines, and how many lines are records and how many are not.

    The bad ones are added to the Parquet table at `quarantine` with the file they are in; they are counted as they are
    written.
    """
    checked = checked_records(_lines_and_files(spark.read, path), schema)
    seen = Observation()
    good = F.count_if(F.col(BAD_LINE).isNull()).alias("good")
    counted = checked.observe(seen, good, F.count_if(F.col(BAD_LINE).isNotNull()).alias("bad"))
    bad_lines(counted).select("file", BAD_LINE).write.mode("append").parquet(quarantine)
    return good_records(checked).drop("file"), seen.get["good"], seen.get["bad"]


def read_order_stream_checked(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """Stream of orders with the file of each line and `bad_line`; `good_records` and `bad_lines` tell them apart."""
    return checked_records(_lines_and_files(spark.readStream.options(**options), path), ORDERS)


def start_quarantine(
    checked: DataFrame, quarantine: str, checkpoint: str, trigger: Mapping[str, object] | None = None
) -> StreamingQuery:
    """Start writing the bad lines of `read_order_stream_checked` to Parquet files; each batch reports the counts `good` and
    `bad` as observed metrics named `lines`.
    """
    good = F.count_if(F.col(BAD_LINE).isNull()).alias("good")
    counted = checked.observe("lines", good, F.count_if(F.col(BAD_LINE).isNotNull()).alias("bad"))
    writer = bad_lines(counted).select("file", BAD_LINE).writeStream.format("parquet").option("path", quarantine)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "20 seconds"})).start()


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated session log without header, columns by position."""
    return spark.read.schema(SESSIONS).option("delimiter", "\t").csv(path)


def clean_sessions(sessions: DataFrame, null_marker: str = NULL_MARKER) -> DataFrame:
    """Drop the unused columns, turn the null marker into null, keep the rows that name a product."""
    kept = sessions.drop(*SESSION_DROPPED)
    return kept.na.replace(null_marker, None).where(F.col("product_id").isNotNull())


def require_non_empty(df: DataFrame) -> DataFrame:
    """`df` itself, or an error when it has no row. Looks for one row, does not count."""
    if df.isEmpty():
        raise ValueError("an empty input has no pairs to count")
    return df


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def parse_delimited(lines: DataFrame, schema: StructType = ORDERS, sep: str = ",") -> DataFrame:
    """Text lines (column `value`) to typed columns by position.

    A missing field or one that is not of the column's type is null.
    """
    parts = F.split(F.col("value"), f"\\Q{sep}\\E")
    return lines.select(
        *[
            F.get(parts, F.lit(position)).try_cast(field.dataType).alias(field.name)
            for position, field in enumerate(schema.fields)
        ]
    )


def read_order_stream(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """Stream of orders from a directory of JSON files."""
    return spark.readStream.schema(ORDERS).options(**options).json(path)


def write_json(df: DataFrame, path: str, single_file: bool = False) -> None:
    """JSON lines, replacing what is there. A single file makes the last stage one task: small results only."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").json(path)
