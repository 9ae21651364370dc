"""What the text operators share: tables written on the way, Arrow batches, and whole groups of sorted rows."""

import functools
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType
from pyspark.sql.pandas.types import to_arrow_schema

from marketlens.sources.scratch import new_folder, remove_folder


@functools.cache
def _package() -> tuple[tempfile.TemporaryDirectory, str]:
    """This package as one archive, as Spark's --py-files takes it."""
    folder, root = tempfile.TemporaryDirectory(prefix="py-files-"), Path(__file__).resolve().parents[1]
    name = f"{folder.name}/{root.name}.zip"
    with zipfile.ZipFile(name, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    return folder, name


def shipped(spark: SparkSession) -> SparkSession:
    """The session, after its executors have been given this package."""
    spark.sparkContext.addPyFile(_package()[1])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The same rows, read from a table in the shared folder: cuts the lineage and survives lost executors."""
    return _write(df, new_folder(df.sparkSession, label))


def _write(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


class Rounds:
    """Tables of a loop, each made from the one before, which goes once nothing reads it any more."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.folders = spark, label, []

    def written(self, df: DataFrame) -> DataFrame:
        """The same rows from a table of their own."""
        self.folders.append(new_folder(self.spark, self.label))
        return _write(df, self.folders[-1])

    def keep(self, last: int = 1) -> None:
        """Remove all tables but the last ones."""
        while len(self.folders) > last:
            remove_folder(self.spark, self.folders.pop(0))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def map_rows(
    df: DataFrame,
    make: Callable[[pa.RecordBatch], dict[str, list | pa.Array]],
    schema: str,
    rows: int = 256,
) -> DataFrame:
    """Apply `make` to slices of at most `rows` rows; it gives the result's columns, as lists or Arrow arrays."""
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                columns = make(batch.slice(start, rows))
                arrays = [
                    own.cast(f.type) if isinstance(own := columns[f.name], pa.Array) else pa.array(own, f.type) for f in out
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=out)

    return df.mapInArrow(run, schema)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 8192) -> Iterator[pa.Table]:
    """Tables of at least `rows` rows (but for the last) that hold every row of their groups; input sorted by `keys`."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(part.num_rows for part in held) < rows:
            continue
        whole = pa.Table.from_batches(held)
        starts = group_starts(whole, keys)
        held = whole.slice(int(starts[-1])).combine_chunks().to_batches()
        if starts[-1]:
            yield whole.slice(0, int(starts[-1]))
    if held:
        yield pa.Table.from_batches(held)


def group_starts(rows: pa.Table, keys: list[str]) -> np.ndarray:
    """Where the groups of a sorted, non-empty table begin. Keys are integers without nulls."""
    change = np.zeros(rows.num_rows, bool)
    change[0] = True
    for key in keys:
        values = rows.column(key).to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(change)
