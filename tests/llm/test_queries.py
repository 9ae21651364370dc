"""The registered text queries and the pipeline on the smallest tables, against their SQL or plain code."""

import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
import xxhash
from tiktoken.load import load_tiktoken_bpe
from tokenizers import Tokenizer

import corpus_pipeline
from marketlens.llm import quality, rules
from marketlens.llm.queries import ORACLES, PASSAGES, QUERIES
from tests.llm.test_operators import grouped, plain_fingerprint, plain_removed
from tests.test_oracle import SF_DIR, plain_rows

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="bundled tables are not here")


@pytest.fixture(scope="module")
def documents():
    frame = duckdb.execute(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall()
    return dict(frame)


@pytest.fixture(scope="module")
def library():
    ranks = load_tiktoken_bpe(str(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def answers(spark, name, key="doc_id"):
    return {row[key]: row for row in QUERIES[name](spark, str(SF_DIR)).collect()}


def plain_contaminated(texts):
    duck = duckdb.connect()
    duck.register("documents", pd.DataFrame({"doc_id": list(texts), "text": list(texts.values())}))
    duck.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF_DIR}/benchmark.parquet'")
    return {i for (i,) in duck.execute(f"SELECT doc_id FROM ({PASSAGES}) WHERE contaminated").fetchall()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    got, expected = QUERIES[name](spark, str(SF_DIR)).toPandas(), duck.execute(ORACLES[name]).df()
    assert len(got) > 0 and plain_rows(got) == plain_rows(expected)


def test_line_dedup(spark, documents):
    got, want = answers(spark, "op1_line_dedup"), plain_removed(list(documents.items()))
    assert got.keys() == documents.keys() and want
    assert {i: row["removed"] for i, row in got.items() if row["removed"]} == want


def test_quotes_and_links(spark):
    pages = duckdb.execute(f"SELECT page_id, url FROM '{SF_DIR}/pages.parquet'").fetchall()
    got = answers(spark, "op4_link_graph", "page_id")
    assert got.keys() == {i for i, _ in pages}
    assert all(row["verdict"] == ("block" if row["rule"] in ("net/", "example.com/de/") else "allow") for row in got.values())
    said = duckdb.execute(f"SELECT conv_id, turn, text FROM '{SF_DIR}/conversations.parquet'").fetchall()
    shown = QUERIES["op2_quotes"](spark, str(SF_DIR)).collect()
    assert len(shown) == len(said) and not any(">" in (text or "") for _, _, text in said)
    assert sorted((row["conv_id"], row["turn"], row["text"]) for row in shown) == sorted((c, t, (x or "").strip("\n")) for c, t, x in said)
    assert all(row["parent_turn"] is None and row["root_turn"] == row["turn"] and row["depth"] == 0 for row in shown)


def test_encoders(spark, documents, library):
    got, files = answers(spark, "op3_bpe"), answers(spark, "op9_token_files")
    plain, start = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json"))), 0
    assert got.keys() == files.keys() == documents.keys()
    for i, text in documents.items():
        ids = library.encode_ordinary(text or "")
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        assert (files[i]["start"], files[i]["n_tokens"]) == (start, len(ids))
        assert files[i]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


@pytest.fixture(scope="module")
def qualities():
    """Labels of each document; those that contradict each other are none."""
    found = {}
    for i, label in duckdb.execute(f"SELECT doc_id, quality FROM '{SF_DIR}/labels.parquet'").fetchall():
        if i is not None and label is not None:
            found.setdefault(i, set()).add(label)
    return found


def plain_rules(texts, trusted):
    """Score and verdict of each text by counts of hashed words and pairs of words."""

    def buckets(text):
        words = [word.encode() for word in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        hashes = [xxhash.xxh64_intdigest(word, 42) for word in words]
        hashes += [xxhash.xxh64_intdigest(b, xxhash.xxh64_intdigest(a, 42)) for a, b in zip(words, words[1:])]
        return [(h - (1 << 64) if h >> 63 else h) % rules.BUCKETS for h in hashes]

    every = {i: buckets(text) for i, text in texts.items()}
    raw, good = ([1] * rules.BUCKETS for _ in range(2))
    for i, own in every.items():
        for bucket in own:
            raw[bucket] += 1
            good[bucket] += i in trusted
    ratio = [math.log(g / sum(good)) - math.log(r / sum(raw)) for g, r in zip(good, raw)]
    return {i: sum(ratio[bucket] for bucket in own) / len(own) if own else 0.0 for i, own in every.items()}


def test_rules(spark, documents, qualities):
    got = answers(spark, "op8_quality_rules")
    want = plain_rules(documents, {i for i, labels in qualities.items() if 1 in labels})
    assert got.keys() == want.keys() and len({round(score, 3) for score in want.values()}) > 50
    for i, row in got.items():
        assert row["score"] == pytest.approx(want[i], abs=1e-6)
        assert row["kept"] == (not row["base_failed"] and want[i] >= -0.1)


def plain_quality(texts, labels):
    """Scores of a model that is fitted by plain loops to the documents that are not held out."""
    known = sorted(i for i, own in labels.items() if len(own) == 1 and i in texts and zlib.crc32(str(i).encode()) % 5)
    grams = {i: quality.ngrams(text).tolist() for i, text in texts.items()}
    late, early = known[4::5], [i for k, i in enumerate(known) if k % 5 != 4]
    sign = {i: 1 if labels[i] == {1} else -1 for i in known}
    counts = {1: {}, -1: {}}
    for i in early:
        for gram in grams[i]:
            counts[sign[i]][gram] = counts[sign[i]].get(gram, 0) + 1
    totals = {y: quality.SIZE + sum(own.values()) for y, own in counts.items()}
    ratio = [math.log((counts[1].get(g, 0) + 1) / totals[1]) - math.log((counts[-1].get(g, 0) + 1) / totals[-1]) for g in range(quality.SIZE)]

    def vector(i):
        norm = math.sqrt(sum(ratio[g] ** 2 for g in grams[i]))
        return {g: ratio[g] / norm for g in grams[i]} if norm else {}

    vectors, weights, bias = {i: vector(i) for i in known}, {}, 0.0
    duals = dict.fromkeys(early, 0.0)
    share = {y: sum(sign[i] == y for i in early) for y in (1, -1)}
    order = np.random.default_rng(0)
    for _ in range(15):
        for k in order.permutation(len(early)):
            i = early[k]
            margin = sum(weights.get(g, 0.0) * value for g, value in vectors[i].items()) + bias
            length = sum(value**2 for value in vectors[i].values()) + 1
            dual = min(max(duals[i] - (sign[i] * margin - 1) / length, 0.0), len(early) / (2 * share[sign[i]]))
            step, duals[i] = (dual - duals[i]) * sign[i], dual
            bias += step
            for g, value in vectors[i].items():
                weights[g] = weights.get(g, 0.0) + step * value

    def margin(i):
        return sum(weights.get(g, 0.0) * value for g, value in vector(i).items()) + bias

    slope, height = 2.0, 0.0
    tried = [(margin(i), sign[i] > 0) for i in late]
    for _ in range(60):  # Newton's steps on the logistic loss and the pull towards (2, 0)
        p = [1 / (1 + math.exp(-(slope * m + height))) for m, _ in tried]
        down = (sum((q - y) * m for q, (m, y) in zip(p, tried)) + 0.1 * (slope - 2), sum(q - y for q, (_, y) in zip(p, tried)) + 0.1 * height)
        a, b, c = (sum(q * (1 - q) * m**k for q, (m, _) in zip(p, tried)) + (0.1 if k != 1 else 0) for k in (2, 1, 0))
        slope, height = slope - (c * down[0] - b * down[1]) / (a * c - b * b), height - (a * down[1] - b * down[0]) / (a * c - b * b)
    if slope <= 0:
        slope, height = 2.0, 0.0
    gap = 0.5 * (sum(w * w for w in weights.values()) + bias**2)
    loss = sum(len(early) / (2 * share[sign[i]]) * max(0.0, 1 - sign[i] * margin(i)) for i in early)
    return {i: 1 / (1 + math.exp(-(slope * margin(i) + height))) for i in texts}, (gap + loss, sum(duals.values()) - gap)


def test_quality(spark, documents, qualities):
    got = answers(spark, "op6_quality")
    want, (primal, dual) = plain_quality(documents, qualities)
    assert 0 < primal - dual < 0.05 * primal  # the descent has come close to the one optimum
    assert got.keys() == want.keys() and len({round(score, 3) for score in want.values()}) > 20
    for i, row in got.items():
        assert row["score"] == pytest.approx(want[i], abs=1e-6)
        assert (row["held_out"], row["predicted"]) == (zlib.crc32(str(i).encode()) % 5 == 0, int(row["score"] >= 0.3))


def test_simhash(spark, documents):
    got = answers(spark, "op7_simhash")
    prints = {i: plain_fingerprint(text) for i, text in documents.items()}
    assert {i: int(row["fingerprint"], 16) for i, row in got.items()} == prints
    label = grouped(list(documents), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert {i: row["component_id"] for i, row in got.items()} == label and len(set(label.values())) < len(label)


URLS = r"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages
), rules(verdict, rule, name, start) AS (
  VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
         ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')
), fits AS (
  SELECT page_id, rule, verdict FROM parts, rules
  WHERE (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC) = 1
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, verdict FROM parts LEFT JOIN fits USING (page_id)"""


def test_urls_equal_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF_DIR}/pages.parquet'")
    want = {i: rest for i, *rest in duck.execute(URLS).fetchall()}
    got = answers(spark, "op4_link_graph", "page_id")
    assert got.keys() == want.keys() and any(rest[2] for rest in want.values())
    for i, (host, path, rule, verdict) in want.items():
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] == (verdict or "allow")  # these pages have no links


def test_pipeline(spark, documents, library):
    scores = answers(spark, "op6_quality")
    texts = {i: text for i, text in documents.items() if scores[i]["score"] >= 0.3}
    removed = plain_removed(list(texts.items()))
    for i, numbers in removed.items():
        left = [line for k, line in enumerate(texts[i].split("\n")) if k not in numbers]
        texts[i] = "\n".join(left) if left else None
    texts = {i: text for i, text in texts.items() if i not in removed or text is not None}
    prints = {i: plain_fingerprint(text) for i, text in texts.items()}
    label = grouped(list(texts), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    texts = {i: text for i, text in texts.items() if label[i] == i}
    contaminated = plain_contaminated(texts)
    texts = {i: text for i, text in texts.items() if i not in contaminated}
    got = {row["doc_id"]: row for row in corpus_pipeline.run(spark, str(SF_DIR)).collect()}
    assert got.keys() == texts.keys() and removed and contaminated
    for i, text in texts.items():
        assert list(got[i]["ids"]) == library.encode_ordinary(text or "")
        assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
