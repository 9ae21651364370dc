r"""Exact dedup: blocks of each text are sorted into integer names, names of neighbours are named again until one is left.

Two texts get the same last name if and only if they are equal: names come from comparing the blocks themselves, no hash
decides. Every round sorts by range, so a block that a third of all texts have is spread over tasks like any other.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from marketlens.llm.common import map_rows, shuffle_partitions, written

#: Bytes that do not count: space, and tab to carriage return.
SPACES = b" \t\n\v\f\r"
#: Bytes of a block.
BLOCK = 4096


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """A row for each block of each text; the first one also has the text's id, code points and digest."""

    def make(batch: pa.RecordBatch) -> dict[str, list]:
        found: dict[str, list] = {name: [] for name in ("row", "place", "blocks", "block", "id", "chars", "digest")}
        text = batch.column("text")
        chars, raw = pc.utf8_length(text).to_pylist(), text.cast(pa.binary()).to_pylist()
        for row, own_id, length, whole in zip(batch.column("row").to_pylist(), batch.column("id").to_pylist(), chars, raw):
            plain = whole.translate(None, SPACES)
            starts = range(0, max(len(plain), 1), size)
            rest = [None] * (len(starts) - 1)
            found["row"] += [row] * len(starts)
            found["place"] += range(len(starts))
            found["blocks"] += [len(starts)] * len(starts)
            found["block"] += [plain[start : start + size] for start in starts]
            found["id"] += [own_id, *rest]
            found["chars"] += [length, *rest]
            found["digest"] += [hashlib.sha256(plain).digest(), *rest]
        return found

    kind = rows.schema["id"].dataType.simpleString()
    return map_rows(rows, make, f"row long, place long, blocks long, block binary, id {kind}, chars long, digest binary")


def _named(rows: DataFrame, keys: list[str]) -> DataFrame:
    """`rows` with `name` in place of `keys`: the same number for the same values, another for any others.

    Rows are sorted by a hash of the values, by the values and by row, and numbered as the values change. A value may
    go on in the next partitions; then the first number it got counts everywhere. Ranges are cut by hash and row, so that a
    value that many rows have is spread, and samples for the ranges are small. Values whose hashes agree stay apart.
    """
    order = ["hash", *keys, "row", "place"]
    hashed = rows.withColumn("hash", F.xxhash64(*keys))
    dealt = hashed.repartitionByRange(shuffle_partitions(rows.sparkSession), "hash", "row").sortWithinPartitions(*order)
    kept = [field for field in rows.schema if field.name not in keys]
    out = StructType([*kept, *StructType.fromDDL("name long, edge binary")])
    arrow = to_arrow_schema(out)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, last = TaskContext.get().partitionId() << 40, None
        first_hash, edges = None, {}  # the values that have the first hash of the partition, then those with the last
        for batch in batches:
            n, names, hashes = batch.num_rows, [], batch.column("hash").to_pylist()
            for at, values in enumerate(zip(*(batch.column(key).to_pylist() for key in keys))):
                if values != last:
                    name, last = name + 1, values
                    if first_hash is None:
                        first_hash = hashes[at]
                    edges = {k: v for k, v in edges.items() if v[0] in (first_hash, hashes[at])}
                    edges[name] = hashes[at], repr(values).encode()
                names.append(name)
            columns = [batch.column(field.name) for field in kept]
            columns += [pa.array(names, pa.int64()), pa.nulls(n, pa.binary())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)
        none = {field.name: None for field in kept}
        more = [none | {"name": edge, "edge": value} for edge, (_, value) in edges.items()]
        yield pa.RecordBatch.from_pylist(more, schema=arrow)

    numbered = written(dealt.mapInArrow(number, out), "names")
    first = F.min("name").over(Window.partitionBy("edge"))
    edges = numbered.filter("edge IS NOT NULL").select("name", first.alias("first")).filter("name <> first")
    # Two rows for each partition at most, but for values whose hashes agree.
    whole = numbered.filter("edge IS NULL").join(F.broadcast(edges), "name", "left")
    return whole.select(*(field.name for field in kept), F.coalesce("first", "name").alias("name"))


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = BLOCK) -> DataFrame:
    r"""(doc_id, keep_id, group_size, kept, digest) for every row of `docs`.

    Texts are equal if they are the same after deleting every character of [\x20\x09-\x0D]; `digest` is the SHA-256 of
    what is left, in UTF-8. Of equal texts the one with the most code points stays, then the one with the smallest id;
    rows without id come last. A null text counts as empty; empty texts are equal to each other. Rows that repeat an id
    and its text are rows of their own, of which any one may stay. An empty table gives an empty result. Other columns
    are ignored. Ids may be of any type that can be sorted.
    """
    row = F.monotonically_increasing_id().alias("row")
    rows = docs.select(row, F.col(doc_id).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    return _grouped(rows, size).select(
        F.col("id").alias("doc_id"), F.col("first.id").alias("keep_id"), "group_size", "kept", "digest"
    )


def _grouped(rows: DataFrame, size: int) -> DataFrame:
    named = _named(_blocks(rows, size), ["block"])
    level = 0
    texts = named.filter("place = 0").withColumn("level", F.lit(level))
    left, ended = named.filter("blocks > 1").select("row", "place", "blocks", "name"), []
    while not left.isEmpty():
        level += 1
        side = [F.max(F.when(F.col("place") % 2 == k, F.col("name"))) for k in (0, 1)]
        pairs = left.groupBy("row", "blocks", F.expr("place div 2").alias("half")).agg(
            side[0].alias("one"), F.coalesce(side[1], F.lit(-1)).alias("other")
        )
        pairs = pairs.select("row", F.col("half").alias("place"), F.expr("(blocks + 1) div 2").alias("blocks"), "one", "other")
        left = _named(pairs, ["one", "other"])
        ended.append(left.filter("blocks = 1").select("row", F.lit(level).alias("to"), F.col("name").alias("last")))
        left = left.filter("blocks > 1")
    if ended:
        last = ended[0]
        for more in ended[1:]:
            last = last.union(more)
        texts = texts.join(last, "row", "left").withColumns(
            {"level": F.coalesce("to", "level"), "name": F.coalesce("last", "name")}
        )
    texts = written(texts.select("row", "id", "chars", "digest", "level", "name"), "identities")
    best = F.struct((-F.col("chars")).alias("chars"), F.col("id").isNull().alias("none"), "id", "row")
    groups = texts.groupBy("level", "name").agg(F.min(best).alias("first"), F.count(F.lit(1)).alias("group_size"))
    # Written, so that the join has two plain sides and Spark can split a group that holds a third of all rows.
    return texts.join(written(groups, "groups"), ["level", "name"]).withColumn("kept", F.col("row") == F.col("first.row"))


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = BLOCK) -> DataFrame:
    """The rows and columns of `docs` that `exact_groups` keeps, one for each different text."""
    number = "row of the table"
    numbered = written(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    rows = numbered.select(F.col(number).alias("row"), F.col(doc_id).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    kept = _grouped(rows, size).filter("kept").select(F.col("row").alias(number))
    return numbered.join(kept, number, "left_semi").select(docs.columns)
