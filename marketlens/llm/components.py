"""Connected groups of a graph that is spread over the cluster."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import Rounds


def _mark(edges: DataFrame) -> tuple[int, int]:
    """Number of edges and an order-free checksum."""
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node", "smaller").cast("decimal(38,0)")).alias("sum")
    ).first()
    return row["n"], row["sum"]


def _oriented(edges: DataFrame) -> DataFrame:
    return (
        edges.filter(F.col("node") != F.col("smaller"))
        .select(F.greatest("node", "smaller").alias("node"), F.least("node", "smaller").alias("smaller"))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node that `edges` link to another (columns node, smaller; any order, repeats and loops allowed).

    The component is its smallest node. Stars are contracted in turn: each node's larger neighbours are hung on its
    smallest one, then its smaller neighbours are. Every round is written to the shared folder, and removed after the
    next; the number of rounds grows with the logarithm of the longest chain. Nulls are no nodes.
    """
    rounds = Rounds(edges.sparkSession, "edges")
    current = rounds.written(_oriented(edges.dropna()))
    mark = _mark(current)
    while mark[0]:
        both = current.union(current.select(F.col("smaller").alias("node"), F.col("node").alias("smaller")))
        least = both.groupBy("node").agg(F.least("node", F.min("smaller")).alias("least"))
        larger = both.filter(F.col("smaller") > F.col("node")).join(least, "node")
        hung = rounds.written(_oriented(larger.select(F.col("smaller").alias("node"), F.col("least").alias("smaller"))))
        least = hung.groupBy("node").agg(F.min("smaller").alias("least"))
        smaller = hung.join(least, "node").select(F.col("smaller").alias("node"), F.col("least").alias("smaller"))
        current = rounds.written(_oriented(smaller.union(least.select("node", F.col("least").alias("smaller")))))
        rounds.keep()
        before, mark = mark, _mark(current)
        if mark == before:
            break
    named = current.select("node", F.col("smaller").alias("component"))
    return named.union(current.select("smaller", "smaller").distinct())
