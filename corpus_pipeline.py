"""Documents to token ids in five stages; each works on what the one before has kept and written."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import bpe, decontaminate, fuzzy_lines, quality, simhash
from marketlens.llm.common import shipped, table, written

#: No SQL: a fitted model, SimHash and byte-pair merges; the stages are tested against brute force instead.
ORACLE_SQL = None


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier document or line has; documents that consist of such lines go."""
    shorter = fuzzy_lines.without_repeated_lines(docs)
    return shorter.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    return simhash.one_of_each(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of what they decode to."""
    coder = bpe.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.encoded(docs, coder)


def _stage(run):
    return lambda spark, docs, sf_dir: run(shipped(spark), docs, sf_dir)


STAGES = [
    ("quality classifier", _stage(reject_low_quality)),
    ("line dedup", _stage(remove_repeated_lines)),
    ("SimHash near-dedup", _stage(keep_one_of_near_copies)),
    ("benchmark decontamination", _stage(remove_contaminated)),
    ("byte-level BPE", _stage(encode)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each result written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
