"""Quality rules: counts over a text, and how much its n-grams look like trusted text rather than the raw corpus.

DataFrame functions only. The n-grams (words and pairs of words) are hashed to a fixed number of buckets. Two
multinomials are counted over all rows, one for the documents with a trusted label and one for the whole corpus; a
document's score is the sum of the log ratios of its n-grams over their number. Ratios are whole millionths, so that a
score does not depend on the order of additions and every document is judged the same at each run.
"""

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
BUCKETS = 1 << 14
MILLION = 1_000_000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Runs of characters without white space; none for null."""
    return F.coalesce(F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), ""), F.array().cast("array<string>"))


def _occurrences(text: Column, chars: str) -> Column:
    """How often any of some ASCII characters occur."""
    bare = [F.octet_length(F.replace(text, F.lit(char), F.lit(""))) for char in chars]
    total = len(chars) * F.octet_length(text) - sum(bare[1:], bare[0])
    return F.coalesce(total, F.lit(0)).cast("long")


def _repeated_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    return F.coalesce(_let(lines, lambda own: F.size(own) - F.size(F.array_distinct(own))), F.lit(0)).cast("long")


def _windows(own: Column, size: int) -> Column:
    """Hash of each window of `size` words, for at least that many words."""
    starts = F.sequence(F.lit(0), F.size(own) - size)
    return F.transform(starts, lambda at: F.xxhash64(*(F.get(own, at + k) for k in range(size))))


def _covered(hashes: Column, size: int) -> Column:
    """Words in windows whose hash is there twice: sorted hashes show the windows, sorted places the words."""
    placed = F.sort_array(F.transform(hashes, lambda value, at: F.struct(value.alias("hash"), at.alias("at"))))

    def starts(own: Column) -> Column:
        def twice(entry: Column, k: Column) -> Column:
            near = (F.get(own, k - 1)["hash"], F.get(own, k + 1)["hash"])
            return near[0].eqNullSafe(entry["hash"]) | near[1].eqNullSafe(entry["hash"])

        return F.sort_array(F.transform(F.filter(own, twice), lambda entry: entry["at"]))

    def total(own: Column) -> Column:
        steps = F.transform(own, lambda at, k: F.least(F.coalesce(F.get(own, k + 1) - at, F.lit(size)), F.lit(size)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda sum_, step: sum_ + step)

    return _let(placed, lambda own: _let(starts(own), total))


def repeated_words(own: Column, size: int = 5) -> Column:
    """How many words lie in a window of `size` words that the text has twice or more, the first included."""
    none = F.lit(0).cast("long")
    found = _let(
        _windows(own, size),
        lambda all_: F.when(F.size(F.array_distinct(all_)) == F.size(all_), none).otherwise(_covered(all_, size)),
    )
    return F.when(F.size(own) < size, none).otherwise(found)


def grams(own: Column) -> Column:
    """Buckets of all words and all pairs of neighbouring words, repeats included."""
    single = F.transform(own, lambda word: F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.size(own) - 2),
        lambda at: F.pmod(F.xxhash64(F.get(own, at), F.get(own, at + 1)), F.lit(BUCKETS)).cast("int"),
    )
    return F.when(F.size(own) < 2, single).otherwise(F.concat(single, pairs))


def log_ratios(
    docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text"
) -> list[int]:
    """For each bucket ln(share among trusted documents / share in the corpus), in millionths; one is added to counts.

    Trusted are the documents with a `label` of 1 (any, if there are several). All rows count. Without trusted text all
    ratios are 0. The result has `BUCKETS` numbers at any size of the corpus.
    """
    trusted = labels.filter(F.col(label) == 1).select(F.col(doc_id).alias("doc_id")).dropna().distinct()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked = rows.join(trusted.withColumn("trusted", F.lit(1)).hint("merge"), "doc_id", "left")
    buckets = marked.select("trusted", F.explode(_let(words(F.col("text")), grams)).alias("bucket"))
    counts = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("trusted").alias("trusted"))
    raw, good = [1] * BUCKETS, [1] * BUCKETS
    for row in counts.collect():  # at most BUCKETS rows
        raw[row["bucket"]] += row["raw"]
        good[row["bucket"]] += row["trusted"]
    if sum(good) == BUCKETS:
        return [0] * BUCKETS
    shift = math.log(sum(raw)) - math.log(sum(good))
    return [round(MILLION * (math.log(a) - math.log(b) + shift)) for a, b in zip(good, raw)]


def judged(
    docs: DataFrame,
    ratios: list[int],
    least: float = -0.1,
    least_words: int = 10,
    most_repeated: int = 20,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Counts and verdict of every row, each from its whole text and without a shuffle.

    Returns doc_id, n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines with a word that equal an
    earlier one), n_repeat_words, base_failed (under `least_words` words, or over `most_repeated` per cent of them repeated),
    score (mean log ratio of the n-grams, in nats; 0 without any) and kept: not base_failed and a score of `least` or
    more. A null text has no words. Repeated rows are judged one by one; other columns are ignored.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<bigint>")
    own = docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"))
    found = _let(
        words(F.col("text")),
        lambda all_: F.struct(
            F.size(all_).cast("long").alias("n_words"),
            repeated_words(all_).alias("n_repeat_words"),
            _let(
                grams(all_),
                lambda buckets: F.struct(
                    F.aggregate(
                        buckets, F.lit(0).cast("long"), lambda sum_, bucket: sum_ + F.get(table, bucket)
                    ).alias("total"),
                    F.size(buckets).alias("n"),
                ),
            ).alias("ratio"),
        ),
    )
    counted = own.select(
        "doc_id",
        found.alias("found"),
        (F.char_length("text").cast("long") - _occurrences(F.col("text"), SPACES)).alias("word_chars"),
        _occurrences(F.col("text"), SYMBOLS).alias("n_symbols"),
        _repeated_lines(F.col("text")).alias("n_dup_lines"),
    )
    n, repeated = F.col("found.n_words"), F.col("found.n_repeat_words")
    failed = (n < least_words) | (100 * repeated > most_repeated * n)
    score = F.when(F.col("found.ratio.n") > 0, F.col("found.ratio.total") / F.col("found.ratio.n") / MILLION).otherwise(0.0)
    return counted.select(
        "doc_id",
        n.alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        repeated.alias("n_repeat_words"),
        failed.alias("base_failed"),
        score.alias("score"),
        (~failed & (score >= least)).alias("kept"),
    )
