"""The registered queries of the text operators, and the SQL that must agree with them."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import (
    block_names,
    bpe,
    decontaminate,
    divergence,
    fuzzy_lines,
    link_graph,
    quality,
    quotes,
    rules,
    simhash,
    substrings,
    token_files,
    variants,
)
from marketlens.llm.common import shipped, table
from marketlens.sources.scratch import new_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: build(shipped(spark), sf_dir)
        if sql:
            ORACLES[name] = sql
        return build

    return register


# --- 10: benchmark decontamination ---------------------------------------------------------------------------

PASSAGES = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), item_starts AS (
  SELECT item_id, words, least(len(words), 10) AS size,
         unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS start
  FROM item_words WHERE len(words) > 0
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(list_slice(words, start, start + size - 1), ' ') AS passage
  FROM item_starts
), sizes AS (
  SELECT DISTINCT size FROM windows
), doc_starts AS (
  SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS start
  FROM doc_words CROSS JOIN sizes WHERE len(words) >= size
), found AS (
  SELECT d.doc_id, d.start, d.size, w.item_id
  FROM (SELECT doc_id, start, size, array_to_string(list_slice(words, start, start + size - 1), ' ') AS passage
        FROM doc_starts) d
  JOIN windows w ON d.size = w.size AND d.passage = w.passage
), hits AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(start, start + size)) AS word FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query("op10_decontaminate", PASSAGES)
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


# --- 7: SimHash near-duplicates ------------------------------------------------------------------------------


@query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


# --- 1: line dedup -------------------------------------------------------------------------------------------


@query("op1_line_dedup")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    removed = fuzzy_lines.repeated_lines(docs)
    breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    lines = F.when(F.octet_length("text") > 0, breaks + 1).otherwise(0)
    return (
        docs.select("doc_id", lines.alias("n_lines"))
        .join(removed, "doc_id", "left")
        .select("doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"), "removed")
    )


# --- 6: quality classifier -----------------------------------------------------------------------------------


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).select(
        "doc_id",
        quality.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


# --- 3: byte-level BPE ---------------------------------------------------------------------------------------


@query("op3_bpe")
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coder = bpe.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.encoded(table(spark, sf_dir, "documents"), coder, ids=False)


# --- 9: token-ID output --------------------------------------------------------------------------------------


@query("op9_token_files")
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as vocabulary:
        content = vocabulary.read()
    folder = new_folder(spark, "token-files")
    shards = token_files.write_tokens(table(spark, sf_dir, "documents"), folder, content)
    return token_files.read_tokens(spark, folder, shards)


# --- 8: quality rules ----------------------------------------------------------------------------------------


@query("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return rules.judged(docs, rules.log_ratios(docs, table(spark, sf_dir, "labels")))


# --- 5: substring dedup --------------------------------------------------------------------------------------

REPEATS = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, start, array_to_string(list_slice(words, start, start + 12), ' ') AS passage
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS start FROM doc_words WHERE len(words) >= 13)
), firsts AS (
  SELECT passage, min(doc_id) AS first_id FROM starts GROUP BY passage
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(start, start + 13)) AS place
  FROM starts JOIN firsts USING (passage) WHERE first_id < doc_id
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS kept
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM doc_words)
  ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM doc_words LEFT JOIN kept USING (doc_id)"""


@query("op5_substring_dedup", REPEATS)
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.without_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


# --- 4: URL filters ------------------------------------------------------------------------------------------

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


@query("op4_link_graph")
def op4_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_graph.judged(table(spark, sf_dir, "pages"), RULES)


# --- 2: chat formatting --------------------------------------------------------------------------------------


@query("op2_quotes")
def op2_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.linked(table(spark, sf_dir, "conversations"))


# --- 13: exact dedup -----------------------------------------------------------------------------------------

COPIES = r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY plain) AS group_size,
       row_number() OVER best = 1 AS kept, sha256(plain) AS text_sha256
FROM texts WINDOW best AS (PARTITION BY plain ORDER BY chars DESC, doc_id)"""


@query("op13_exact_dedup", COPIES)
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = block_names.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


# --- 12: source divergence audit -----------------------------------------------------------------------------

SHARES = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents
), uses AS (
  SELECT row_no, lang, source, unnest(words) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS total FROM uses GROUP BY lang, term HAVING count(DISTINCT row_no) >= 3
), sizes AS (
  SELECT lang, count(*) AS v, sum(total) AS n_lang FROM kept GROUP BY lang
), counts AS (
  SELECT lang, source, term, count(*) AS times FROM uses JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), group_sizes AS (
  SELECT lang, source, coalesce(sum(times), 0) AS n FROM groups LEFT JOIN counts USING (lang, source) GROUP BY lang, source
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.times, 0) AS times,
         1 + 1000000000::HUGEINT * (coalesce(c.times, 0) + 1) // (g.n + s.v) AS p,
         1 + 1000000000::HUGEINT * (k.total + 1) // (s.n_lang + s.v) AS q
  FROM group_sizes g JOIN kept k USING (lang) JOIN sizes s USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE times > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= 200"""


@query("op12_source_divergence", SHARES)
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


# --- 11: spelling variant grouping ---------------------------------------------------------------------------


@query("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))
