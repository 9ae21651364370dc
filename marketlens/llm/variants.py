r"""Spelling variant grouping: words that differ by one code point, linked to the form that is much more frequent.

Candidates come from a variable-length gram index. A gram starts at every code point of a word and is as long as it has
to be: grams that are frequent in the vocabulary are extended, rare ones stay short. One edit touches only the grams that
lie over its place; the most it can touch, worked out for each word, says how many grams two near words must share. So of
each word only its rarest grams, one more than an edit can touch, have to be looked up.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import written

_RUN = re.compile("[a-zÀ-ÿ]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: A run whose checksum this divides loses a code point.
SLIPS = 199
#: Words of a task that are counted before it hands them on.
HELD = 300_000
#: Code points of the shortest and the longest gram. The longest must be shorter than the shortest word: then any edit
#: leaves a gram untouched.
SHORTEST, LONGEST = 2, 5
#: Grams that occur more often in the vocabulary than the first are extended, but no more than the second, which are the
#: most frequent ones; all tasks get them.
OFTEN, FREQUENT = 50, 60_000
#: Marks the end of a word; no word has it.
_END = "$"


def runs(doc_id: object, text: str) -> Counter:
    """How often each word occurs in a document, some runs with a code point less; a null id counts as empty."""
    words: Counter = Counter()
    begun = zlib.crc32(("" if doc_id is None else f"{doc_id}").encode() + b":")
    for run, times in Counter(_RUN.findall(text.encode().translate(_LOWER).decode())).items():
        checksum = zlib.crc32(run.encode(), begun)
        if checksum % SLIPS == 0:
            place = checksum % len(run)
            run = run[:place] + run[place + 1 :]
        words[run] += times
    return words


def counted_words(docs: DataFrame, least_length: int, least_times: int) -> DataFrame:
    """(word, n) of the words that are long and frequent enough; `docs` has doc_id and text without nulls."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for word, times in runs(doc_id, text).items():
                    if len(word) >= least_length:
                        held[word] += times
                if len(held) > HELD:
                    yield flushed()
        if held:
            yield flushed()

    words = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_times)


def frequent_grams(words: DataFrame, most: int = FREQUENT) -> frozenset[str]:
    """Grams that occur over `OFTEN` times, the `most` most frequent ones at most (ties: the shorter, then by code point).

    With a gram all that begin it are in, too, as these are at least as frequent and come first. A word ends with a mark.
    """
    word = F.concat("word", F.lit(_END))
    grams = [
        F.transform(F.sequence(F.lit(1), F.char_length(word) - size + 1), lambda k, size=size: F.substring(word, k, F.lit(size)))
        for size in range(SHORTEST, LONGEST)
    ]
    counts = words.select(F.explode(F.concat(*grams)).alias("gram")).groupBy("gram").count().filter(F.col("count") > OFTEN)
    top = counts.orderBy(F.desc("count"), F.char_length("gram"), "gram").limit(most)
    return frozenset(row["gram"] for row in top.select("gram").collect())


def grams(word: str, frequent: frozenset[str]) -> list[str]:
    """The gram that starts at each code point: extended while it is frequent, up to `LONGEST` or the word's end mark."""
    marked, found = word + _END, []
    for start in range(len(word)):
        stop = start + SHORTEST
        while stop - start < LONGEST and stop < len(marked) and marked[start:stop] in frequent:
            stop += 1
        found.append(marked[start:stop])
    return found


def affected(sizes: list[int]) -> int:
    """The most grams that one edit can touch: those over a code point or over the gap before it."""
    over = [0] * (len(sizes) + 2)
    for start, size in enumerate(sizes):
        for place in range(start, min(start + size, len(over))):
            over[place] += 1
    return max(over)


def _decomposed(words: DataFrame, frequent: frozenset[str]) -> DataFrame:
    """(word, n, gram, place, touched): the grams of each word."""
    shared = words.sparkSession.sparkContext.broadcast(frequent)

    def decompose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                own = grams(word, shared.value)
                most = affected([len(gram) for gram in own])
                for column, values in zip(columns, ([word] * len(own), [n] * len(own), own, range(len(own)), [most] * len(own))):
                    column.extend(values)
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int32())
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["word", "n", "gram", "place", "touched"])

    return words.mapInArrow(decompose, "word string, n long, gram string, place int, touched int")


def near_words(words: DataFrame, frequent: frozenset[str] | None = None) -> DataFrame:
    """(word, n, near, near_n): every two of the given words (word, n; no repeats) that one edit parts, both ways round.

    A word of `k` grams of which an edit touches `t` at most shares `k - t` with any near word. Both being so, the rarest
    gram that two near words share is among the `t + 1` rarest of each, wherever ties are broken alike; only these lists
    are merged. The place of a gram moves by one at most, as does the length.
    """
    frequent = frequent_grams(words) if frequent is None else frequent
    every = written(_decomposed(words, frequent), "grams")
    sizes = every.groupBy("gram").agg(F.count(F.lit(1)).alias("size"))
    by_rarity = Window.partitionBy("word").orderBy("size", "gram", "place")
    rare = every.join(sizes, "gram").withColumn("nth", F.row_number().over(by_rarity)).filter("nth <= touched + 1")
    rare = written(rare.select("gram", "place", "word", "n", F.char_length("word").alias("length")), "rare-grams")
    a = rare.select("gram", *(F.col(name).alias(f"{name}_a") for name in ("place", "word", "n", "length")))
    # Neighbouring places and lengths as keys: a list is merged with few others, however long all lists of a gram are.
    near = F.explode(F.expr("transform(sequence(-1, 1), k -> k + place)"))
    b = rare.select("gram", near.alias("place_a"), *(F.col(name).alias(f"{name}_b") for name in ("place", "word", "n", "length")))
    pairs = a.join(b, ["gram", "place_a"]).filter(
        (F.col("word_a") < F.col("word_b"))
        & (F.abs(F.col("length_a") - F.col("length_b")) <= 1)
        & (F.levenshtein("word_a", "word_b", 1) == 1)
    )
    pairs = written(pairs.select("word_a", "n_a", "word_b", "n_b").distinct(), "near-words")
    forth = pairs.toDF("word", "n", "near", "near_n")
    return forth.union(pairs.select("word_b", "n_b", "word_a", "n_a"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last. Steps double, so rounds grow with the log of a chain.

    A chain is short: each form is at least as many times as frequent as the word as is asked for.
    """
    reached = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = reached.join(further, "root", "left")
        longer = longer.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        longer = written(longer, "roots")
        reached = longer.select("word", "root")
        if longer.filter("moved").isEmpty():
            return reached


def spelling_variants(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_length: int = 6,
    least_times: int = 5,
    times_over: int = 5,
) -> DataFrame:
    r"""(word, form, root, n, n_near, form_n) of each word of the corpus.

    Words are the runs `[A-Za-zÀ-ÿ]+`, A-Z lower-cased, with at least `least_length` (6 or more) code points and
    `least_times` occurrences (`n`). Where 199 divides the crc32 of "<id>:<run>", the run has lost the code point at
    crc32 % length, a slip that stands for typing errors. Near words (`n_near`) differ by one code point inserted, deleted
    or replaced. A word's form is its most frequent near word, the first in code-point order of several, if it occurs
    at least `times_over` (2 or more) times as often as the word; else null, as is `form_n`. Its root is the last of the
    chain of forms, the word itself without one.

    Null texts have no words; a null id is read as empty. Repeated rows count again. An empty table gives an empty result.
    Other columns are ignored.
    """
    if least_length <= LONGEST or times_over < 2:
        raise ValueError(f"words need more than {LONGEST} code points, forms at least twice the occurrences")
    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    words = written(counted_words(rows, least_length, least_times), "words")
    best = F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word"))
    known = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(best).alias("best"))
    known = words.join(known, "word", "left").withColumn("often", F.col("n") * times_over <= -F.col("best.less"))
    form, form_n = F.when(F.col("often"), F.col("best.word")), F.when(F.col("often"), -F.col("best.less"))
    known = known.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), form.alias("form"), form_n.alias("form_n"))
    known = written(known, "forms")
    roots = _roots(known.filter("form IS NOT NULL"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.col("n_near").cast("long").alias("n_near"), "form_n"
    )
