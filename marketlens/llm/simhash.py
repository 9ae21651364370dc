"""SimHash near-duplicates: one 64-bit fingerprint a document, linked at few differing bits."""

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import group_starts, map_rows, shuffle_partitions, whole_groups, written
from marketlens.llm.components import components
from marketlens.llm.hamming import block_keys, in_chunks, linked

#: Shingles that are hashed and counted at once, so that very long texts stay in bounded memory.
AT_ONCE = 255 * 256


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of lower-cased (A-Z) word shingles as a signed 64-bit integer; 0 without words.

    A bit is set if it is set in over half the XXH64 values (seed 42) of the shingles, repeats included.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = max(1, len(words) - shingle + 1) if words else 0
    totals = np.zeros(64, np.int64)
    for start in range(0, n, AT_ONCE):
        part = words[start : min(start + AT_ONCE, n) + shingle - 1]
        shingles = map(b" ".join, zip(*(part[k:] for k in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), np.uint64)
        bits = np.zeros((-(-len(hashes) // 255) * 255, 64), np.uint8)
        bits[: len(hashes)] = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        totals += bits.reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * totals > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint as long) of every row; null and empty texts have fingerprint 0."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def make(batch: pa.RecordBatch) -> dict[str, list]:
        texts = batch.column("text").to_pylist()
        return {"doc_id": batch.column("doc_id"), "fingerprint": [fingerprint(text, shingle) for text in texts]}

    return map_rows(rows, make, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, fingerprint long")


def _links(distinct: DataFrame, radius: int, chunk: int) -> DataFrame:
    """(node, smaller): enough links between fingerprints to connect all that reach each other within a bucket."""
    rows = distinct.select("fingerprint", F.explode(block_keys(F.col("fingerprint"), radius + 2, 2)).alias("key"))
    rows = in_chunks(rows, "key", "fingerprint", chunk)
    keys = ["key", "first", "second"]
    sorted_rows = rows.repartition(shuffle_partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, keys):
            own = part.column("fingerprint").to_numpy()
            first = linked(own.view(np.uint64), group_starts(part, keys), radius)
            moved = first != np.arange(len(own))
            yield pa.RecordBatch.from_pydict({"node": own[moved], "smaller": own[first[moved]]})

    return sorted_rows.select(*keys, "fingerprint").mapInArrow(compare, "node long, smaller long").distinct()


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    radius: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    chunk: int = 2048,
) -> DataFrame:
    """(doc_id, fingerprint long, component_id): groups of documents that reach each other over close fingerprints.

    Fingerprints are close at `radius` or fewer differing bits. Equal ones are folded first. The 64 bits are cut into
    `radius` + 2 runs; close fingerprints agree in at least two runs, and every choice of two is a bucket key. Within
    a bucket, fingerprints are compared bit-sliced, each with blocks of 64 others at once. A bucket of over `chunk`
    fingerprints is spread over pairs of chunks. All links count; only what connects them leaves a task.

    `component_id` is the smallest id in the group. Texts without words share fingerprint 0 and are linked like any
    other. A row without an id gets its group's `component_id` (null if no row there has an id). Repeated rows come
    back as often as they were there. No documents give no rows. Other columns are ignored.
    """
    prints = written(fingerprints(docs, shingle, doc_id, text), "fingerprints")
    distinct = written(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct")
    groups = components(_links(distinct, radius, chunk))
    member = distinct.join(groups.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("component")
    )
    least = member.groupBy("component").agg(F.min("least").alias("component_id"))
    names = written(member.join(least, "component").select("fingerprint", "component_id"), "groups")
    return prints.join(names, "fingerprint").select("doc_id", "fingerprint", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, radius: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, that stand for their group: the one with the smallest id.

    Of repeated rows with that id one stays. A row without an id can't be told from others and stays. See
    `near_duplicates` for the rest.
    """
    groups = near_duplicates(docs, shingle, radius, doc_id, text)
    chosen = groups.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(doc_id)).distinct()
    kept = docs.join(chosen, doc_id).select(docs.columns).dropDuplicates([doc_id])
    return kept.unionByName(docs.filter(F.col(doc_id).isNull()))
