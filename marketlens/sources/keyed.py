"""A table with one row per key, kept as Parquet in buckets of keys that grow in number with the table.

The bucket of a key is a partition column, so an upsert reads and rewrites only the buckets of its own keys, by Spark's
dynamic partition overwrite. Buckets are numbered by linear hashing: with n of them, 2^k <= n < 2^(k+1), a key lies at its
hash modulo 2^(k+1) if that is a bucket, else modulo 2^k. A further bucket takes its rows from one other and leaves all
the rest as they are. The number of buckets is one more than the highest there is; where the highest ones are empty, their
keys' rows would lie at the lower number just as well, so nothing else has to be kept.

Spark deals a bucket out to several tasks if it is large. A reader takes a row only from the bucket its key belongs to,
so a bucket that an interrupted split has left behind counts for nothing. The merged rows are staged by Spark, beside
the buckets that they are still read from; a job that dies before Spark moves them into place leaves the table as it was,
and one that dies while it does can be run again. Running an upsert again gives the same table. One writer at a time; a reader should open the table
after the write.
"""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketlens.sources.scratch import new_folder, remove_folder

KEY, BUCKET = "key_column", "key_bucket"
#: Fewest buckets of a table, and the rows a bucket may have on average before there are more.
BUCKETS, BUCKET_ROWS = 64, 1_000_000
#: A table has few rows if an upsert brings more than this many times as many.
FEW = 10


def bucket_of(key: Column, buckets: int) -> Column:
    """The key's bucket among `buckets`, by linear hashing."""
    half = 1 << (buckets.bit_length() - 1)
    hashed = F.xxhash64(key.cast("string"))
    wide = F.pmod(hashed, F.lit(2 * half).cast("long"))
    return F.when(wide < buckets, wide).otherwise(F.pmod(hashed, F.lit(half).cast("long"))).cast("long")


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows as they lie, with the two partition columns; None where nothing is stored."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    # Partition values are read as text or numbers as they look.
    return stored.withColumns({KEY: F.col(KEY).cast("string"), BUCKET: F.col(BUCKET).cast("long")})


def _number_of_buckets(stored: DataFrame) -> tuple[int, int]:
    """Buckets and rows, from the files' footers."""
    most, rows = stored.agg(F.max(BUCKET), F.count(F.lit(1))).first()
    return most + 1, rows


def _valid(stored: DataFrame, key: str, buckets: int) -> DataFrame:
    """Without rows that have moved on to another bucket."""
    return stored.where(F.col(BUCKET) == bucket_of(F.col(key), buckets))


def read_keyed_table(spark: SparkSession, path: str, format: str | None = None, **options: object) -> DataFrame:
    """The current rows, with the schema as stored; `format` reads a store through its own connector instead.

    A table that never got a row is an error, as one that is not there.
    """
    if format:
        return spark.read.format(format).options(**options).load(path)
    stored = _stored(spark, path)
    if stored is None:
        raise ValueError(f"no keyed table under {path}")
    key = stored.select(KEY).first()[0]  # none where buckets are given, which never split
    return (stored if key is None else _valid(stored, key, _number_of_buckets(stored)[0])).drop(KEY, BUCKET)


def _written(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _checked(df: DataFrame, key: str, unique: bool, newer: str | None) -> DataFrame:
    """One row per key, each with a key."""
    missing = F.raise_error(F.lit(f"a row without {key} cannot be upserted"))
    rows = df.withColumn(key, F.coalesce(F.col(key), missing))
    if unique:
        return rows
    if newer is None:
        return rows.dropDuplicates([key])
    whole = F.max_by(F.struct(*rows.columns), F.col(newer)).alias("row")
    return rows.groupBy(F.col(key).alias("key of the row")).agg(whole).select("row.*")


def upsert_by_key(
    df: DataFrame,
    path: str,
    key: str,
    format: str | None = None,
    unique: bool = False,
    buckets: int = BUCKETS,
    bucket_rows: int = BUCKET_ROWS,
    bucket: Column | None = None,
    newer: str | None = None,
    add: Sequence[str] = (),
    **options: object,
) -> int:
    """Rows with a known key replace the stored row, others are added, stored rows without a new one stay.

    Of several new rows with one key any one is taken; `unique` says there are none such and saves that shuffle. With
    `newer`, a column that is never null, the row with the highest value stays, stored or new; of equals the new one.
    With `add` as well, these columns of the new row are summed with those of the stored row it takes the place of, once:
    a new row whose `newer` is not higher than the stored one's changes nothing, so a load that comes again does not count
    twice. Returns the number of rows brought in, one per key. `format` hands the rows to a store's own connector in append mode.

    A new table gets `buckets` buckets or more, so that none has over `bucket_rows` rows on average; an upsert splits as
    many buckets as the table has outgrown. `bucket` takes a whole number from the row itself instead (say, the day of
    the key), which has to follow from the key and to be the same expression every time; such buckets are never split.
    """
    if add and newer is None:
        raise ValueError("sums need a column that tells which load a row is of")
    spark = df.sparkSession
    seen = Observation()
    rows = _checked(df, key, unique, newer).observe(seen, F.count(F.lit(1)).alias("rows"))
    if format:
        rows.write.format(format).options(**options).mode("append").save(path)
        return seen.get["rows"]
    scratch = new_folder(spark, "upsert")
    # Written once, then read several times: for the buckets, for the keys to replace and for the rows.
    new = _written(rows, f"{scratch}/incoming")
    count = seen.get["rows"]
    stored = _stored(spark, path)
    before, held = (0, 0) if stored is None or bucket is not None else _number_of_buckets(stored)
    if bucket is None:
        after = max(before or buckets, -(-(held + count) // bucket_rows))
        place, named = bucket_of(F.col(key), after), F.lit(key)
    else:
        after, place, named = before, bucket.cast("long"), F.lit(None).cast("string")
    merged = new
    if stored is not None:
        old = place if bucket is not None else bucket_of(F.col(key), before)
        touched = {row[0] for row in new.select(old.alias(BUCKET)).distinct().collect()}  # numbers of buckets
        touched |= {_parent(number) for number in range(before, after)}
        old_rows = stored.where(F.col(BUCKET).isin(sorted(touched)))
        old_rows = old_rows if bucket is not None else _valid(old_rows, key, before)
        old_rows = old_rows.drop(KEY, BUCKET)
        merged = _added(old_rows, new, key, newer, add) if add else _merged(old_rows, new, key, newer, few=held * FEW < count)
    (
        # Spark cuts a large bucket for several tasks and puts small ones together.
        merged.withColumns({KEY: named, BUCKET: place})
        .hint("rebalance", BUCKET)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(KEY, BUCKET)
        .parquet(path)
    )
    remove_folder(spark, scratch)
    return count


def _parent(number: int) -> int:
    """The first bucket, of those there were before, that the rows of a new bucket come from."""
    return number - (1 << (number.bit_length() - 1))


def _merged(stored: DataFrame, new: DataFrame, key: str, newer: str | None, few: bool = False) -> DataFrame:
    if newer is None:
        keys = new.select(key)
        # Few stored rows: the new keys are cut down to theirs, for which they need not move where Spark sends the few.
        replaced = keys.join(stored.select(key), key, "left_semi") if few else keys
        return stored.join(replaced, key, "left_anti").unionByName(new)
    incoming = new.select(F.col(key).alias("incoming key"), F.col(newer).alias("incoming"))
    kept = stored.join(incoming, F.col(key) == F.col("incoming key"), "left")
    kept = kept.where(F.col("incoming key").isNull() | (F.col(newer) > F.col("incoming"))).select(stored.columns)
    return new.join(kept.select(key), key, "left_anti").unionByName(kept)


def _added(stored: DataFrame, new: DataFrame, key: str, newer: str, add: Sequence[str]) -> DataFrame:
    """All rows of both; where both have a key and the new row is of a later load, the sums of `add` and else the new row."""
    both = stored.alias("old").join(new.alias("new"), F.col(f"old.`{key}`") == F.col(f"new.`{key}`"), "full")
    known, comes = F.col(f"old.`{key}`").isNotNull(), F.col(f"new.`{key}`").isNotNull()
    later = comes & (~known | (F.col(f"new.`{newer}`") > F.col(f"old.`{newer}`")))

    def merged(name: str) -> Column:
        old, own = F.col(f"old.`{name}`"), F.col(f"new.`{name}`")
        total = F.when(known, old + own).otherwise(own) if name in add else own
        return F.when(later, total).otherwise(old).alias(name)

    return both.select(*(merged(name) for name in new.columns))
