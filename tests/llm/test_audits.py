"""Spelling variants, source divergence and exact dedup against plain code, with odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlens.llm import block_names, divergence, variants
from marketlens.llm.queries import COPIES, QUERIES, SHARES
from tests.test_oracle import SF_DIR, plain_rows

SCHEMA = "doc_id long, text string, lang string, source string, word string, n long, row string, kept string, m int"
ODD = [None, "", " \n\t\x0b", "a", "×÷", "Ünïcode çafé 漢字かな 🤦🏼", "x" * 30_000, "word " * 9_000, "lone\x00mark \x1c\x85  end"]


def docs(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    rows = [(i, text, lang, source, "w", 7, "r", "k", 1) for i, text, lang, source in rows]
    return spark.createDataFrame(rows, SCHEMA)


def some_rows(seed, n=120):
    """Random texts with copies, copies but for white space, and near words; odd texts, nulls, repeated rows and ids."""
    own = random.Random(seed)
    stems = ["station", "Änderung", "naïveté", "keyboard", "seldomly", "garçonne", "entirely"]
    words = [*stems, "the", "of", "1st", "x-y"]
    words += [w[:k] + own.choice(["", "q", "é", w[k] * 2]) + w[k + 1 :] for w in stems for k in (0, 2, len(w) - 1)]
    weights = [20] * 7 + [9] * 4 + [own.choice([1, 1, 2, 5]) for _ in words[11:]]
    texts = []
    for k in range(n):
        texts.append(" ".join(own.choices(words, weights, k=own.randint(1, 40))))
        if k % 4 == 1:
            texts[k] = texts[own.randrange(k)]
        if k % 4 == 2:
            texts[k] = texts[own.randrange(k)].replace(" ", own.choice(["", "  ", "\n", "\t "]))
    texts += ODD + ODD
    rows = [(k, text, own.choice(["en", "en", "de", None]), own.choice(["a", "b", "c", "", None])) for k, text in enumerate(texts)]
    return rows + [rows[3], rows[3], (rows[5][0], "other text", "en", "a"), (None, texts[0], "en", "b"), (None, None, None, None)]


# --- 11 ------------------------------------------------------------------------------------------------------


def plain_variants(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {word: times for word, times in n.items() if times >= 5 and len(word) >= 6}
    return n, {word: plain_variant(word, n) for word in n}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(a == b[:k] + b[k + 1 :] for k in range(len(b)))


def plain_variant(word, n):
    near = [other for other in n if one_apart(word, other)]
    best = min(near, key=lambda other: (-n[other], other), default=None)
    form = best if best and n[best] >= 5 * n[word] else None
    root = plain_variant(form, n)[1] if form else word
    return form, root, n[word], len(near), n[form] if form else None


def variants_of(df):
    return {row["word"]: (row["form"], row["root"], row["n"], row["n_near"], row["form_n"]) for row in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_variants(spark, seed):
    rows = some_rows(seed, 300)
    got = variants.spelling_variants(docs(spark, rows))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    n, want = plain_variants([row[:2] for row in rows])
    assert variants_of(got) == want and any(value[0] for value in want.values())
    assert got.count() == len(n)


@pytest.mark.skipif(not SF_DIR.exists(), reason="bundled tables are not here")
def test_variants_of_the_table(spark):
    rows = duckdb.execute(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'").fetchall()
    assert variants_of(QUERIES["op11_spelling_variants"](spark, str(SF_DIR))) == plain_variants(rows)[1]


def test_chains_of_forms(spark):
    """Forms lead on: each word is followed to the last, over more steps than one doubling reaches."""
    steps = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb"]
    text = " ".join(" ".join([word] * 5 ** (k + 1)) for k, word in enumerate(steps))
    got = variants_of(variants.spelling_variants(docs(spark, [(1, text, "en", "a")])))
    assert got == plain_variants([(1, text)])[1]
    assert {value[1] for value in got.values()} == {"aabbbb"}


@pytest.mark.parametrize("often", [0, 2, 10**9])
def test_near_words_whatever_grams_are_extended(spark, often, monkeypatch):
    """All grams short, all long and some of each find the same pairs: the bound holds for every dictionary."""
    monkeypatch.setattr(variants, "OFTEN", often)
    own = random.Random(often)
    words = {"".join(own.choices("abé", k=own.randint(6, 9))) for _ in range(400)}
    got = variants.near_words(spark.createDataFrame([(word, 1) for word in words], "word string, n long"))
    pairs = [(row["word"], row["near"]) for row in got.collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in words for b in words if one_apart(a, b)}


def test_grams_are_bounded(spark):
    words = spark.createDataFrame([("abcdef" + "g" * k, 1) for k in range(60)], "word string, n long")
    assert len(variants.frequent_grams(words, most=3)) == 3
    assert variants.affected([2, 2, 2]) == 2 and variants.affected([5, 5, 5, 5, 3, 2]) == 5
    assert variants.grams("abcdef", frozenset(["bc", "bcd", "f$"])) == ["ab", "bcde", "cd", "de", "ef", "f$"]


def test_variants_of_nothing(spark):
    assert variants.spelling_variants(docs(spark, [])).collect() == []
    assert variants.spelling_variants(docs(spark, [(1, None, None, None), (None, "", "", "")])).collect() == []
    with pytest.raises(ValueError):
        variants.spelling_variants(docs(spark, []), least_length=5)


# --- 12 and 13: their SQL over odd rows ----------------------------------------------------------------------


def in_duckdb(rows, sql):
    duck = duckdb.connect()
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source"]).astype({"doc_id": "Int64"})
    duck.register("documents", frame)
    return duck.execute(sql).df()


@pytest.mark.parametrize("seed", [1, 2])
def test_divergence(spark, seed):
    rows = some_rows(seed)
    got = divergence.divergence(docs(spark, rows)).toPandas()
    assert plain_rows(got) == plain_rows(in_duckdb(rows, SHARES)) and set(got["part"]) == {"pair", "term"}


def test_divergence_of_many_equal_values(spark):
    """More terms of one value than there are ranks: the first in UTF-8 order get them."""
    words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}é" for k in range(600)]
    rows = [(k, " ".join(words[k % 2 :: 2]), "en", "ab"[k % 2]) for k in range(6)] + [(9, None, "en", "none"), (10, "a", "fr", "b")]
    got = divergence.divergence(docs(spark, rows)).toPandas()
    assert plain_rows(got) == plain_rows(in_duckdb(rows, SHARES))
    terms = got[(got.part == "term") & (got.source == "a")]
    assert len(terms) == 200 and terms["value"].nunique() == 1 and list(terms.sort_values("rank")["item"]) == sorted(words[::2])[:200]


def test_divergence_with_large_counts(spark):
    """Shares stay exact where a long would overflow on the way."""
    cells = spark.createDataFrame([(30_000_000_000_000, 70_000_000_000_001, 3)], "c long, n long, v long")
    got = cells.select(divergence._share("c", "n").alias("p")).first()["p"]
    assert got == 1 + 10**9 * (30_000_000_000_000 + 1) // (70_000_000_000_001 + 3)


def test_divergence_of_nothing(spark):
    assert divergence.divergence(docs(spark, [])).collect() == []
    rows = [(1, None, "en", "a"), (2, "once", "en", "b"), (3, "", None, None)]
    assert plain_rows(divergence.divergence(docs(spark, rows)).toPandas()) == plain_rows(in_duckdb(rows, SHARES))


def plain_copies(rows):
    plain = [re.sub("[\x20\x09-\x0d]", "", text or "") for _, text, *_ in rows]
    return {text: [k for k, other in enumerate(plain) if other == text] for text in plain}


@pytest.mark.parametrize("size", [1, 7, block_names.BLOCK])
def test_exact_dedup(spark, size):
    rows = some_rows(3)
    got = block_names.exact_groups(docs(spark, rows), size=size).collect()
    assert len(got) == len(rows)
    want = []
    for text, members in plain_copies(rows).items():
        ranked = sorted(members, key=lambda k: (-len(rows[k][1] or ""), rows[k][0] is None, rows[k][0] or 0))
        digest = hashlib.sha256(text.encode()).digest()
        want += [(rows[k][0], rows[ranked[0]][0], len(members), k == ranked[0], digest) for k in members]
    assert sorted(map(repr, (tuple(map(_plain, row)) for row in got))) == sorted(map(repr, (tuple(map(_plain, row)) for row in want)))


def _plain(value):
    return bytes(value) if isinstance(value, bytearray) else value


def test_exact_dedup_equals_sql(spark):
    rows = list({row[0]: row for row in some_rows(4) if row[0] is not None}.values())
    got = block_names.exact_groups(docs(spark, rows)).selectExpr(
        "doc_id", "keep_id", "group_size", "kept", "lower(hex(digest)) AS text_sha256"
    )
    assert plain_rows(got.toPandas()) == plain_rows(in_duckdb(rows, COPIES))


@pytest.mark.parametrize("collide", [False, True])
def test_names(spark, monkeypatch, collide):
    """Equal blocks get one name also where partitions end within them, others another, even if all hashes agree."""
    if collide:
        monkeypatch.setattr(block_names.F, "xxhash64", lambda *keys: F.lit(7).cast("long"))
    own = random.Random(5)
    values = [b"same"] * 500 + [own.randbytes(own.randint(0, 3)) for _ in range(500)]
    rows = spark.createDataFrame([(k, 0, 1, value) for k, value in enumerate(values)], "row long, place long, blocks long, block binary")
    named = [(row["name"], values[row["row"]]) for row in block_names._named(rows, ["block"]).collect()]
    assert len(named) == 1000 and len({name for name, _ in named}) == len(set(named)) == len(set(values))


def test_without_copies(spark):
    rows = some_rows(6)
    table = docs(spark, rows)
    left = block_names.without_copies(table)
    assert left.columns == table.columns
    kept = [re.sub("[\x20\x09-\x0d]", "", row["text"] or "") for row in left.collect()]
    assert sorted(kept) == sorted(plain_copies(rows))


def test_exact_dedup_of_nothing(spark):
    assert block_names.exact_groups(docs(spark, [])).collect() == []
    names = docs(spark, [(1, "a", "", ""), (2, "b", "", "")]).selectExpr("cast(doc_id AS string) AS doc_id", "text")
    assert {row["keep_id"] for row in block_names.exact_groups(names).collect()} == {"1", "2"}
