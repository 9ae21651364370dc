"""Source divergence audit: how far the words of a source are from those of its language and of its other sources.

Terms with the same pair of counts get the same value, so values are worked out once for each pair of counts (a cell).
Cells are ranked by value with their number of terms; only the cells that reach the wanted ranks are spelled out again.
"""

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import written

#: ASCII letters and all other characters that are not ASCII; of the former, capitals are lower-cased.
_TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Terms that a task holds before it hands their counts on.
HELD = 300_000
#: Shares are counted in parts of this.
SCALE = 1_000_000_000

_COUNTS = "lang string, source string, term string, times long, docs long"
_COUNTS_ARROW = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("times", pa.int64()), ("docs", pa.int64())]
)


def terms(text: str) -> list[str]:
    """The terms of a text in order, repeats included."""
    return _TERM.findall(text.encode().translate(_LOWER).decode())


def _counted(texts: DataFrame) -> DataFrame:
    """(lang, source, term, times, docs): partial counts of the terms; `texts` has lang, source and text without nulls."""

    def flushed(groups: dict[tuple[str, str], list[Counter]]) -> pa.RecordBatch:
        columns: list[list] = [[], [], [], [], []]
        for (lang, source), (times, docs) in groups.items():
            for column, values in zip(
                columns, ([lang] * len(times), [source] * len(times), times, times.values(), map(docs.get, times))
            ):
                column.extend(values)
        groups.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _COUNTS_ARROW)], schema=_COUNTS_ARROW)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], list[Counter]] = {}
        held = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(k).to_pylist() for k in ("lang", "source", "text"))):
                times, docs = groups.setdefault((lang, source), [Counter(), Counter()])
                held -= len(docs)
                own = Counter(terms(text))
                times.update(own)
                docs.update(own.keys())
                held += len(docs)
                if held > HELD:
                    yield flushed(groups)
                    held = 0
        if held:
            yield flushed(groups)

    return texts.select("lang", "source", "text").mapInArrow(count, _COUNTS)


def kept_terms(texts: DataFrame, least_docs: int = 3) -> DataFrame:
    """(lang, term, total, profile): terms in at least `least_docs` documents of the language.

    `profile` has (source, times) for each source that has the term, by source; it is no longer than the language has
    sources.
    """
    by_source = _counted(texts).groupBy("lang", "source", "term").agg(F.sum("times").alias("times"), F.sum("docs").alias("docs"))
    profile = F.sort_array(F.collect_list(F.struct("source", "times")))
    found = by_source.groupBy("lang", "term").agg(F.sum("times").alias("total"), F.sum("docs").alias("docs"), profile.alias("profile"))
    return found.filter(F.col("docs") >= least_docs).drop("docs")


def _share(times: str, n: str, v: str = "v") -> Column:
    """1 + floor(SCALE * (times + 1) / (n + v)), exact at every size."""
    return F.expr(f"1 + CAST({SCALE} AS DECIMAL(38,0)) * ({times} + 1) div ({n} + {v})")


def _value(p: str, q: str) -> str:
    """floor((p - q)^2 / q); shares are little more than SCALE, so the square fits a long."""
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


def _cells_of_pairs(kept: DataFrame) -> DataFrame:
    """(lang, a, b, x, y, m): m terms that source a has x times and b has y times, both at least once, a before b.

    Terms with the same profile are one row before any pair is made.
    """
    alike = kept.groupBy("lang", "profile").agg(F.count(F.lit(1)).alias("m")).filter("size(profile) > 1")
    one = alike.select("lang", "m", "profile", F.posexplode("profile").alias("place", "one"))
    rest = F.slice("profile", F.col("place") + 2, F.size("profile"))
    both = one.select("lang", "m", "one", F.explode(rest).alias("other"))
    keys = [F.col("one.source").alias("a"), F.col("other.source").alias("b"), F.col("one.times").alias("x"), F.col("other.times").alias("y")]
    return both.groupBy("lang", *keys).agg(F.sum("m").alias("m"))


def _pair_values(kept: DataFrame, groups: DataFrame, cells: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language.

    The sum over all terms is taken apart: f(x, y) = f(0, 0) + [f(x, 0) - f(0, 0)] + [f(0, y) - f(0, 0)] + what is left,
    and nothing is left unless both sources have the term.
    """
    forth = _cells_of_pairs(kept)
    back = forth.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), F.col("y").alias("x"), F.col("x").alias("y"), "m")
    a = groups.select("lang", F.col("source").alias("a"), F.col("n").alias("n_a"), "v", "p0")
    b = groups.select("lang", F.col("source").alias("b"), F.col("n").alias("n_b"), F.col("p0").alias("q0"))
    p, q, none = _share("x", "n_a"), _share("y", "n_b"), _value("p0", "q0")
    joint = forth.unionByName(back).join(a, ["lang", "a"]).join(b, ["lang", "b"]).withColumns({"p": p, "q": q})
    extra = F.expr(f"m * ({_value('p', 'q')} - {_value('p', 'q0')} - {_value('p0', 'q')} + {none})")
    joint = joint.groupBy("lang", "a", "b").agg(F.sum(extra.cast("decimal(38,0)")).alias("extra"))
    # Counts that a source has, with their number of terms: as many rows as it has different counts.
    own = cells.groupBy("lang", "source", "g").agg(F.sum("m").alias("m")).withColumnsRenamed({"source": "a", "g": "x"})
    one = own.join(a, ["lang", "a"]).withColumn("p", p).join(b, "lang").filter("a <> b")
    one = one.groupBy("lang", "a", "b").agg(F.sum(F.expr(f"CAST(m * ({_value('p', 'q0')} - {none}) AS DECIMAL(38,0))")).alias("first"))
    other = own.withColumnsRenamed({"a": "b", "x": "y"}).join(b, ["lang", "b"]).join(groups.select("lang", "v").distinct(), "lang")
    other = other.withColumn("q", q).join(a.drop("v"), "lang").filter("a <> b")
    other = other.groupBy("lang", "a", "b").agg(F.sum(F.expr(f"CAST(m * ({_value('p0', 'q')} - {none}) AS DECIMAL(38,0))")).alias("second"))
    every = a.join(b, "lang").filter("a <> b")
    for part in (joint, one, other):
        every = every.join(part, ["lang", "a", "b"], "left")
    parts = [F.coalesce(name, F.lit(0)) for name in ("extra", "first", "second")]
    value = F.expr(f"CAST(v AS DECIMAL(38,0)) * {none}") + parts[0] + parts[1] + parts[2]
    return every.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), value.cast("long").alias("value"))


def _ranked(rows: DataFrame, most: int | None = None) -> DataFrame:
    """With `rank` within language and source, by value, then item as UTF-8; each task cuts to `most` before the shuffle."""
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    return ranked if most is None else ranked.filter(F.col("rank") <= most)


def _top_terms(kept: DataFrame, groups: DataFrame, cells: DataFrame, most: int) -> DataFrame:
    """(lang, source, item, value, rank) of the terms that a source has more often than its language."""
    lang_n = kept.groupBy("lang").agg(F.sum("total").alias("n_lang"))
    valued = cells.join(groups, ["lang", "source"]).join(lang_n, "lang")
    valued = valued.withColumns({"p": _share("g", "n"), "q": _share("l", "n_lang")}).filter("p > q")
    valued = written(valued.select("lang", "source", "g", "l", "m", F.expr(_value("p", "q")).alias("value")), "cells")
    # Cells of equal value are one; the most different values that can be needed is `most`.
    merged = valued.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    first = merged.withColumn("nth", F.row_number().over(by_value)).filter(F.col("nth") <= most)
    before = F.sum("m").over(by_value.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("m")
    reached = first.withColumn("before", before).filter(F.col("before") < most).select("lang", "source", "value")
    wanted = valued.join(reached, ["lang", "source", "value"]).select("lang", "source", "g", "l", "value")
    each = kept.select("lang", "term", F.col("total").alias("l"), F.explode("profile").alias("own"))
    each = each.select("lang", F.col("own.source").alias("source"), F.col("own.times").alias("g"), "l", F.col("term").alias("item"))
    return _ranked(each.join(wanted, ["lang", "source", "g", "l"]).select("lang", "source", "item", "value"), most)


def divergence(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = 3, most: int = 200
) -> DataFrame:
    """(lang, source, part, item, value, rank): what sets each source of a language apart.

    A term's share in a group is p = 1 + floor(10^9 (count + 1) / (all counts + number of terms)), over the terms in at
    least `least_docs` documents of the language; its divergence from another share q is floor((p - q)^2 / q). Part
    `pair` has each other source of the language with the divergence summed over all terms; part `term` has the first
    `most` terms that the source has and has more often than the language. Ranks go by value, largest first, then by
    item as UTF-8, from 1. Sums are of whole numbers, so results don't depend on the order of rows.

    Null text, lang and source are read as empty text. Each row is a document of its own, repeated ones too. A source
    without terms takes part with a count of 0; a language with a single source has no pairs; an empty table gives an
    empty result. Other columns are ignored.
    """
    named = {"lang": lang, "source": source, "text": text}
    rows = docs.select(*(F.coalesce(F.col(own).cast("string"), F.lit("")).alias(name) for name, own in named.items()))
    kept = written(kept_terms(rows, least_docs), "kept-terms")
    cells = kept.select("lang", F.col("total").alias("l"), F.explode("profile").alias("own"))
    cells = cells.groupBy("lang", F.col("own.source").alias("source"), F.col("own.times").alias("g"), "l")
    cells = written(cells.agg(F.count(F.lit(1)).alias("m")), "cells")
    sizes = cells.groupBy("lang", "source").agg(F.sum(F.col("g") * F.col("m")).alias("n"))
    terms_of = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    groups = rows.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(terms_of, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"))
    # Without terms nothing is summed, so any share will do there.
    groups = written(groups.withColumn("p0", F.when(F.col("v") > 0, _share("0", "n")).otherwise(F.lit(1))), "groups")
    pairs = _ranked(_pair_values(kept, groups, cells)).withColumn("part", F.lit("pair"))
    tops = _top_terms(kept, groups, cells, most).withColumn("part", F.lit("term"))
    return pairs.unionByName(tops).select("lang", "source", "part", "item", "value", "rank")
