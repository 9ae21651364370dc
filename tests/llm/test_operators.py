"""The text operators against brute force, with nulls, empty and long texts, ties, repeats, empty tables and clashing names."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
import zlib
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketlens.llm import (
    bpe,
    decontaminate,
    fuzzy_lines,
    hamming,
    hashing,
    link_graph,
    quality,
    quotes,
    rules,
    simhash,
    substrings,
    token_files,
)
from marketlens.llm.components import components
from marketlens.llm.hashing import word_hashes
from marketlens.llm.queries import QUERIES, RULES

SCHEMA = "doc_id long, text string, found string, fingerprint string, removed int, kept string, n_words string"
LONG = " ".join(f"w{k % 977}" for k in range(30_000))


def table(spark, rows, schema=SCHEMA):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, text, "x", "y", 1, "z", "w") for i, text in rows], schema)


def some_texts(seed, n=60):
    """Random texts with copies, near copies, shared passages, nulls, empty and odd ones."""
    own = random.Random(seed)
    words = ["ab", "cd", "Ef", "gh", "é", "the", "of", "x1", "!", "q."]
    texts = []
    for k in range(n):
        lines = [" ".join(own.choice(words) for _ in range(own.randint(1, 40))) for _ in range(own.randint(1, 4))]
        texts.append("\n".join(lines))
        if k % 5 == 1:
            texts[k] = texts[own.randrange(k)]
        if k % 5 == 2:
            other = texts[own.randrange(k)].split(" ")
            other[own.randrange(len(other))] = "new"
            texts[k] = " ".join(other)
        if k % 5 == 3:
            texts[k] += " " + " ".join(texts[own.randrange(k)].split()[:20])
    return [*texts, None, "", " \n\t", LONG, "a", texts[0]]


def documents(spark, seed):
    rows = list(enumerate(some_texts(seed)))
    return table(spark, [*rows, rows[3], (None, rows[0][1])]), rows


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


# --- groups --------------------------------------------------------------------------------------------------


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 200), (300, 200), (7, 7), (None, 1), (500, 500)] + [(900, k) for k in range(901, 950)]
    got = {row["node"]: row["component"] for row in components(spark.createDataFrame(edges, "node long, smaller long")).collect()}
    want = {k: 0 for k in range(41)} | {100: 100, 200: 100, 300: 100} | {k: 900 for k in range(900, 950)}
    assert got == want
    assert components(spark.createDataFrame([], "node long, smaller long")).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_bit_sliced_links(radius):
    own = np.random.default_rng(radius)
    prints = []
    for base in own.integers(0, 2**63, 40, dtype=np.uint64):
        for _ in range(own.integers(1, 9)):
            value = int(base)
            for bit in own.integers(0, 64, own.integers(0, radius + 3)):
                value ^= 1 << int(bit)
            prints.append(value)
    prints = np.array(prints, np.uint64)
    own.shuffle(prints)
    starts = np.unique(np.concatenate(([0], own.integers(0, len(prints), 5))))
    want = np.arange(len(prints))
    for start, end in zip(starts, np.append(starts[1:], len(prints))):
        for _ in range(end - start):
            for a in range(start, end):
                for b in range(start, a):
                    if bin(int(prints[a] ^ prints[b])).count("1") <= radius:
                        want[a] = want[b] = min(want[a], want[b])
    assert (hamming.linked(prints, starts, radius) == want).all()


def plain_fingerprint(text):
    text = "".join(char.lower() if "A" <= char <= "Z" else char for char in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(one.encode(), 42) for one in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(value >> bit & 1 for value in hashes) > len(hashes))


def grouped(keys, near):
    """Smallest key reachable over near pairs."""
    label = {key: key for key in keys}
    changed = True
    while changed:
        changed = False
        for a in keys:
            for b in keys:
                if label[a] != label[b] and near(a, b):
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


@pytest.mark.parametrize("chunk", [2048, 2])
def test_simhash(spark, chunk):
    docs, rows = documents(spark, 1)
    prints = {i: plain_fingerprint(text) for i, text in rows}
    want = grouped(list(prints), lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 2)
    got = simhash.near_duplicates(docs, chunk=chunk).collect()
    assert len(got) == len(rows) + 2
    for row in got:
        key = 0 if row["doc_id"] is None else row["doc_id"]
        assert row["fingerprint"] % (1 << 64) == prints[key] and row["component_id"] == want[key]
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(row["doc_id"] for row in kept.dropna(subset="doc_id").collect()) == sorted(set(want.values()))
    assert kept.filter("doc_id IS NULL").count() == 1


def test_simhash_of_nothing(spark, empty):
    assert simhash.near_duplicates(empty).count() == simhash.one_of_each(empty).count() == 0


# --- lines ---------------------------------------------------------------------------------------------------


def edits(a, b):
    row = list(range(len(b) + 1))
    for k, x in enumerate(a, 1):
        new = [k]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_similarity():
    own = random.Random(5)
    for _ in range(2000):
        a, b = ("".join(own.choice("ab c") for _ in range(own.randint(0, 14))) for _ in range(2))
        if own.random() < 0.6:
            b = a[: own.randint(0, 14)] + own.choice("abcd") + a[own.randint(0, 14) :]
        longest = max(len(a), len(b))
        assert fuzzy_lines.similar(a, b, 0.8) == (edits(a, b) <= int(0.2 * longest + 1e-9))
        if a and b:
            assert fuzzy_lines._edits(a, b) == edits(a, b)


def plain_blocks(line):
    """The blocks of a normalised line that has only words between spaces, each with its number, and its SimHash."""
    words = {word: int(word_hashes([word.encode()])[0]) for word in line.split()}
    found = set()
    for number in range(8):
        run, size = [], 0
        for step in range(8):
            own = [word for word, value in words.items() if (value >> 40) % 8 == (number + step) % 8]
            if not own and not step:
                break
            run, size = run + own, size + sum(len(word.encode()) for word in own)
            if size >= 12:
                break
        if run:
            bits = sum(1 << bit for bit in range(3, 64) if 2 * sum(words[word] >> bit & 1 for word in run) > len(run))
            found.add((number, bits))
    return found, sum(1 << bit for bit in range(64) if 2 * sum(value >> bit & 1 for value in words.values()) > len(words))


def plain_line_links(different):
    """Groups of lines that agree in a block and are similar."""
    blocks = {line: plain_blocks(line) for line in different}

    def linked(a, b):
        longest = max(len(a), len(b))
        (own, a_print), (others, b_print) = blocks[a], blocks[b]
        if own.isdisjoint(others) or (a_print ^ b_print).bit_count() > 16 or min(len(a), len(b)) < 0.8 * longest - 1e-6:
            return False
        return edits(a, b) <= int(0.2 * longest + 1e-9)

    return grouped(different, linked)


def plain_removed(rows):
    """Numbers of the lines to remove, by id; lines of rows without id stay."""
    lines = {}
    for i, text in rows:
        for number, line in enumerate((text or "").split("\n") if i is not None else []):
            norm = fuzzy_lines.normalised(line).decode()
            if norm:
                lines[i, number] = norm
    label = plain_line_links(sorted(set(lines.values())))
    first = {}
    for place, norm in lines.items():
        first[label[norm]] = min(place, first.get(label[norm], place))
    removed = {}
    for (i, number), norm in lines.items():
        if first[label[norm]] != (i, number):
            removed.setdefault(i, []).append(number)
    return removed


@pytest.mark.parametrize("chunk", [2048, 2])
def test_repeated_lines(spark, chunk):
    docs, rows = documents(spark, 2)
    long_line = " ".join(f"word{k}" for k in range(80))
    more = [(1000, long_line), (1001, long_line.replace("word7 ", "word8 ")), (1002, f"Title\n{long_line.upper()}!!\nfoot")]
    docs, rows = docs.union(table(spark, more)), rows + more
    want = plain_removed(rows)
    got = {row["doc_id"]: row["removed"] for row in fuzzy_lines.repeated_lines(docs, chunk=chunk).collect()}
    assert got == want and got[1001] == [0] and got[1002] == [1]
    if chunk == 2048:
        shorter = fuzzy_lines.without_repeated_lines(docs)
        assert shorter.columns == docs.columns
        texts = {row["doc_id"]: row["text"] for row in shorter.collect() if row["doc_id"] is not None}
        for i, text in rows:
            left = [line for k, line in enumerate((text or "").split("\n")) if k not in want.get(i, [])]
            assert texts.get(i, "gone") == (text if i not in want else "\n".join(left) if left else "gone")


@pytest.mark.parametrize("chunk", [2048, 7])
def test_lines_with_a_word_changed(spark, chunk):
    """A word replaced or inserted: with eight words or more, a block of the others is found."""
    own = random.Random(11)
    rows = []
    for k, size in enumerate([8, 9, 10, 11, 12, 13, 14, 16, 20, 25, 30, 40]):
        words = ["".join(own.choice("abcdefghijklmnop") for _ in range(own.randint(3, 8))) for _ in range(size)]
        changed, inserted = list(words), list(words)
        changed[size // 2] = "zz"
        inserted.insert(size // 3, "yy")
        rows += [(3 * k, " ".join(words)), (3 * k + 1, f"Other, {k}!\n" + " ".join(changed)), (3 * k + 2, " ".join(inserted))]
    want = plain_removed(rows)
    assert len(want) >= 22
    found = fuzzy_lines.repeated_lines(table(spark, rows), chunk=chunk).collect()
    assert {row["doc_id"]: row["removed"] for row in found} == want


def test_lines_of_few_words_and_without_spaces(spark):
    """Repeats go whatever their words; in scripts without spaces a few characters may differ."""
    chinese = "".join(chr(0x4E00 + 37 * k) for k in range(114))
    rows = [
        (1, f"Contents\n{chinese}\n***\n\na b"),
        (2, f"contents!\n{chinese}\n***\n\nA  B"),
        (3, f"{chinese[:50]}{chinese[51:]}\nContent"),
        (4, f"\u0e2a\u0e27\u0e31\u0e2a\u0e14\u0e35 {chinese[::-1]}"),
    ]
    found = fuzzy_lines.repeated_lines(table(spark, rows)).collect()
    assert {row["doc_id"]: row["removed"] for row in found} == {2: [0, 1, 4], 3: [0]}


def test_lines_with_one_opening(spark):
    """Many long lines that begin alike but are not similar: only a few pairs of them are compared."""
    own = random.Random(12)
    opening = " ".join(f"common{k}" for k in range(17))
    lines = [f"{opening} " + " ".join(str(own.random())[2:8] for _ in range(24)) for _ in range(20_000)]
    prints = fuzzy_lines.fingerprints([fuzzy_lines.normalised(line) for line in lines]).view(np.uint64)
    pairs = 0
    for number in range(8):
        for block in np.unique(prints[:, number]):
            own = prints[(prints[:, number] == block) & (block != 0), 8]
            pairs += sum(int((np.bitwise_count(own[:k] ^ own[k]) <= 16).sum()) for k in range(1, len(own)))
    assert pairs < 3 * len(lines)
    rows = [(k, "\n".join(lines[k::50][:60])) for k in range(50)]
    assert fuzzy_lines.repeated_lines(table(spark, rows)).count() == 0


def test_line_of_very_many_words():
    """More words of one class than a counter holds."""
    line = " ".join(f"w{k % 5000}" for k in range(9000))
    *blocks, whole = (int(value) & ((1 << 64) - 1) for value in fuzzy_lines.fingerprints([line.encode()])[0])
    assert ({(number, value & ~7) for number, value in enumerate(blocks)}, whole) == plain_blocks(line)


def test_no_lines(empty):
    assert fuzzy_lines.repeated_lines(empty).count() == fuzzy_lines.without_repeated_lines(empty).count() == 0


# --- passages ------------------------------------------------------------------------------------------------


def plain_cut(rows, window=13):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", text or "") for i, text in rows}
    first = {}
    for i, own in words.items():
        for k in range(len(own) - window + 1):
            key = tuple(own[k : k + window])
            first[key] = min(i, first.get(key, i))
    found = {}
    for i, own in words.items():
        gone = set()
        for k in range(len(own) - window + 1):
            if first[tuple(own[k : k + window])] < i:
                gone |= set(range(k, k + window))
        found[i] = (len(own), len(gone), " ".join(word for k, word in enumerate(own) if k not in gone))
    return found


@pytest.mark.parametrize("groups", [None, 1])
def test_substrings(spark, groups):
    docs, rows = documents(spark, 3)
    want = plain_cut(rows)
    assert sum(n > 0 for _, n, _ in want.values()) > 5
    got = substrings.without_repeats(docs, groups=groups).collect()
    assert len(got) == len(rows) + 2
    for row in got:
        if row["doc_id"] is not None:
            assert (row["n_words"], row["n_removed"], row["kept"]) == want[row["doc_id"]]
        else:
            assert row["n_removed"] == 0 and row["kept"] == " ".join(rows[0][1].split())


def test_no_substrings(empty):
    assert substrings.without_repeats(empty).count() == 0


def test_a_window_shares_an_anchor():
    for a in range(7):
        for b in range(7):
            assert any((a + k) % 7 in substrings.COVER and (b + k) % 7 in substrings.COVER for k in range(7))


# --- benchmark -----------------------------------------------------------------------------------------------


def fold(text):
    text = "".join(char.lower() if "A" <= char <= "Z" else char for char in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


@pytest.mark.parametrize("block_bytes", [8_000_000, 40])
def test_passages(spark, block_bytes):
    docs, rows = documents(spark, 4)
    items = [(f"i{k}", " ".join(fold(text)[3:17]).upper()) for k, (_, text) in enumerate(rows[:25])]
    items += [("short", "The, OF"), ("none", " .. "), (None, "ab cd"), ("null", None), ("i1", items[1][1])]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    windows = {}
    for name, text in items:
        own = fold(text) if name else []
        for k in range(max(1, len(own) - 9) if own else 0):
            windows.setdefault(tuple(own[k : k + 10]), set()).add(name)
    for row in decontaminate.find_passages(docs, benchmark, block_bytes=block_bytes).collect():
        text = rows[row["doc_id"] or 0][1]
        own, hit, names = fold(text), set(), set()
        for size in {len(one) for one in windows}:
            for k in range(len(own) - size + 1):
                if (found := windows.get(tuple(own[k : k + size]))) is not None:
                    hit |= set(range(k, k + size))
                    names |= found
        assert (row["n_words"], row["n_hit"], row["items"]) == (len(own), len(hit), sorted(names))
        covered = sum(len(fold((text or "")[start:end])) for start, end in zip(row["starts"], row["ends"]))
        assert covered == len(hit)
    clean = decontaminate.decontaminated(docs, benchmark, block_bytes=block_bytes)
    hits = decontaminate.find_passages(docs, benchmark).filter("n_hit = 0")
    assert clean.columns == docs.columns and clean.count() == hits.count()


def test_empty_benchmark(spark, empty):
    nothing = spark.createDataFrame([], "item_id string, text string")
    docs, _ = documents(spark, 4)
    assert decontaminate.find_passages(docs, nothing).filter("n_hit > 0").count() == 0
    assert decontaminate.decontaminated(docs, nothing).count() == docs.count()
    assert decontaminate.find_passages(empty, nothing).count() == 0


# --- quality -------------------------------------------------------------------------------------------------


def test_rules(spark):
    docs, rows = documents(spark, 6)
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, 1), (None, 1), (5, None), (999, 1)], "doc_id long, quality int")
    ratios = rules.log_ratios(docs, labels)
    assert len(ratios) == rules.BUCKETS and any(ratios)
    for row in rules.judged(docs, ratios).collect():
        text = rows[row["doc_id"] or 0][1] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\f\r")]
        times = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        twice = {k + j for k in range(len(words) - 4) if times[tuple(words[k : k + 5])] > 1 for j in range(5)}
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        want = len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(twice)
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == want
        assert row["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert row["kept"] == (not row["base_failed"] and row["score"] >= -0.1)
    assert rules.log_ratios(docs, labels.filter("false")) == [0] * rules.BUCKETS


def test_classifier(spark, empty):
    good = [(k, " ".join(f"fine{(k * j) % 50}" for j in range(1, 30))) for k in range(1, 120)]
    bad = [(k, " ".join(f"junk{(k * j) % 50} |" for j in range(1, 30))) for k in range(200, 320)]
    docs = table(spark, [*good, *bad, good[0], (None, None), (400, ""), (401, LONG)])
    labels = spark.createDataFrame([(k, int(k < 200)) for k, _ in [*good, *bad]] + [(1, 1), (2, 0), (None, 1), (5, None)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    scores = {row["doc_id"]: row["score"] for row in quality.scored(docs, model).collect()}
    assert len(scores) == 242 and all(0 <= score <= 1 for score in scores.values())
    out = [k for k, _ in [*good, *bad] if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all((scores[k] >= 0.5) == (k < 200) for k in out)
    kept = quality.accepted(docs, model, 0.5)
    assert kept.columns == docs.columns and kept.filter("doc_id BETWEEN 200 AND 320").count() == 0
    again = quality.fit(docs.repartition(3), labels)
    assert np.allclose(again.weights, model.weights)
    nothing = quality.fit(docs, labels.filter("false"))
    assert {row["score"] for row in quality.scored(docs, nothing).collect()} == {0.5}
    assert quality.scored(empty, model).count() == 0


def test_labels_of_the_held_out_part_are_not_learnt(spark):
    docs = table(spark, [(k, f"word{k % 7} " * 9) for k in range(60)])
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    flipped = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(quality.fit(docs, labels).weights, quality.fit(docs, flipped).weights)


# --- tokens --------------------------------------------------------------------------------------------------

ALPHABET = ["a", "b", "aa", " ", "  ", "\n", "\t", "é", "ß", "'s", "1", "23", "!", "...", "\xa0", "　", "the", " The", " élan", "÷", "ÀÖ", " don't", "word.", ",", "\x85", "\x1c", "՘", "😀", "<|endoftext|>"]


def odd_texts(n=400):
    own = random.Random(8)
    made = ["".join(own.choice(ALPHABET) for _ in range(own.randint(0, 40))) for _ in range(n)]
    return [*made, "", " ", "a" * 20_000, " " * 9_000, "ab" * 9_000, LONG]


@pytest.fixture(autouse=True)
def _small_generations(monkeypatch):
    """What was met before is forgotten soon, so that tests see that too."""
    monkeypatch.setattr(bpe.Codec, "KEPT", 40)
    monkeypatch.setattr(token_files.Tokens, "KEPT", 40)


@pytest.fixture(scope="module")
def coder():
    return bpe.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def test_bpe(spark, coder, empty):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    texts = odd_texts()
    for text, ids in zip(texts, coder.encode_all(texts)):
        assert ids.tolist() == library.encode_ordinary(text) and coder.decode(ids.tolist()).decode() == text
    docs, rows = documents(spark, 7)
    for row in bpe.encoded(docs, coder).collect():
        text = rows[row["doc_id"] or 0][1] or ""
        ids = library.encode_ordinary(text)
        assert row["ids"] == ids and row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encoded(empty, coder).count() == 0


def test_rank_queue():
    own, queue, held = random.Random(9), bpe.RankQueue(), {}
    for _ in range(3000):
        rank = own.randrange(60_000)
        if rank in queue.buckets:
            queue.buckets[rank].append(own.randrange(99))
        else:
            queue.mark(rank, [own.randrange(99)])
        held[rank] = sorted(queue.buckets[rank])
    assert [queue.pop() for _ in range(len(held))] == sorted(held.items()) and not queue.summary


def test_token_files(spark, tmp_path, empty):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        vocabulary = file.read()
    library = Tokenizer.from_str(vocabulary)
    texts = odd_texts(200)
    got = token_files.Tokens(vocabulary, 2).encode_all(texts)
    assert [own.tolist() for own in got] == [library.encode(text, add_special_tokens=False).ids + [2] for text in texts]
    docs, rows = documents(spark, 7)
    folder = f"file://{tmp_path}/files"
    shards = token_files.write_tokens(docs, folder, vocabulary)
    found = sorted(map(tuple, token_files.read_tokens(spark, folder, shards).collect()), key=lambda row: row[1])
    start, want = 0, []
    for i, text in [(None, rows[0][1]), *sorted([*rows, rows[3]], key=lambda row: row[0])]:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert found == want
    one = [ids.tolist() for k in range(shards) for ids in token_files.Reader(folder, k).find(5)]
    assert one == [library.encode(rows[5][1], add_special_tokens=False).ids + [2]]
    none = f"file://{tmp_path}/none"
    assert token_files.read_tokens(spark, none, token_files.write_tokens(empty, none, vocabulary)).count() == 0


def test_token_files_know_added_tokens(spark, tmp_path):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        vocabulary = file.read()
    library = Tokenizer.from_str(vocabulary)
    texts = ["foo <|endoftext|> bar", "foo", "<|endoftext|>", "a<|endoftext|><|endoftext|>b. c", "<|endoftext", LONG + "<|endoftext|>", None, ""]
    want = [library.encode(text or "", add_special_tokens=False).ids + [2] for text in texts]
    assert want[0] == [21943, 220, 50256, 2318, 2]
    got = token_files.Tokens(vocabulary, 2).encode_all(texts)
    assert [own.tolist() for own in got] == want
    folder = f"file://{tmp_path}/files"
    shards = token_files.write_tokens(table(spark, list(enumerate(texts))), folder, vocabulary)
    rows = sorted(map(tuple, token_files.read_tokens(spark, folder, shards).collect()))
    starts = np.cumsum([0] + [len(ids) for ids in want]).tolist()
    assert rows == [(k, starts[k], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for k, ids in enumerate(want)]


def test_token_files_keep_rows_without_id(spark, tmp_path):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        vocabulary = file.read()
    library = Tokenizer.from_str(vocabulary)
    rows = [(None, "b c"), (7, "one"), (-(2**63), "least"), (None, "a"), (3, "two words"), (None, None)]
    folder, start, want = f"file://{tmp_path}/files", 0, []
    shards = token_files.write_tokens(table(spark, rows), folder, vocabulary)
    for i, text in sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0, row[1] or "")):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = map(tuple, token_files.read_tokens(spark, folder, shards).collect())
    assert sorted(got, key=lambda row: row[1]) == want
    least = [ids.tolist() for k in range(shards) for ids in token_files.Reader(folder, k).find(-(2**63))]
    assert least == [library.encode("least", add_special_tokens=False).ids + [2]]


# --- pages and messages --------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, host string, trust string, verdict string"


def pages(spark, rows):
    return spark.createDataFrame([(*row, "a", "b", "c") for row in rows], PAGES)


def test_links(spark):
    rows = [
        (0, "http://bad.net/x", None),
        (1, "HTTP://Friend.com/en?x", '<a href="http://bad.net/y">'),
        (2, "https://friend.com/fr#x", "<a href='//bad.net'><a href=\"/local\">"),
        (3, "http://good.example.net/en/1", '<a href="http://www.fine.com/">'),
        (4, "http://www.fine.com/a", '<a href="http://friend.com/">'),
        (5, "http://x.org/fr/1", ""),
        (6, None, '<a href="http://bad.net/">'),
        (7, "no scheme/net/", None),
        (8, "http://example.com/de/1", None),
        (9, "http://notnet/x", None),
        (1, "HTTP://Friend.com/en?x", '<a href="http://bad.net/y">'),
    ]
    got = {row["page_id"]: row for row in link_graph.judged(pages(spark, rows), RULES).collect()}
    assert link_graph.judged(pages(spark, rows), RULES).count() == len(rows)
    fits = {k: (got[k]["host"], got[k]["path"], got[k]["rule"], got[k]["verdict"]) for k in got}
    assert fits == {
        0: ("bad.net", "/x", "net/", "block"),
        1: ("friend.com", "/en", None, "block"),
        2: ("friend.com", "/fr", None, "block"),
        3: ("good.example.net", "/en/1", "example.net/en/", "allow"),
        4: ("www.fine.com", "/a", None, "allow"),
        5: ("x.org", "/fr/1", "org/fr/", "allow"),
        6: ("", "", None, "allow"),
        7: ("", "", None, "allow"),
        8: ("example.com", "/de/1", "example.com/de/", "block"),
        9: ("notnet", "/x", None, "allow"),
    }
    assert link_graph.judged(pages(spark, []), RULES).count() == 0


def test_mass_is_that_of_plain_page_rank(spark):
    own = random.Random(4)
    names = [f"h{k}" for k in range(12)]
    links = sorted({(a, b) for a, b in ((own.choice(names), own.choice(names)) for _ in range(30)) if a != b})
    seeds = {name: (own.randrange(3), own.randrange(3)) for name in names}
    hosts = spark.createDataFrame([(name, *seeds[name]) for name in names], "host string, allowed long, blocked long")
    got = {row["host"]: row for row in link_graph.spread(hosts, spark.createDataFrame(links, "source string, target string")).collect()}
    totals = [sum(seed[k] for seed in seeds.values()) for k in (0, 1)]
    for kind, k, edges in (("trust", 0, links), ("distrust", 1, [(b, a) for a, b in links])):
        out = Counter(a for a, _ in edges)
        mass = start = {name: seeds[name][k] / totals[k] for name in names}
        for _ in range(200):
            mass = {name: 0.15 * start[name] + 0.85 * sum(mass[a] / out[a] for a, b in edges if b == name) for name in names}
        for name in names:
            assert got[name][kind] / link_graph.MASS == pytest.approx(mass[name], abs=1e-3 / len(names))  # a hundredth of the threshold


def test_distrust_goes_down_a_long_chain(spark):
    """110 hosts, judged by the threshold that ten million hosts would have: settled mass decides up to the end."""
    size, hosts = 110, 10**7
    share = 10 * size / hosts
    urls = [f"http://h{k}.com/" for k in range(size - 1)] + ["http://bad.net/"]
    rows = [(k, url, f'<a href="{after}">') for k, (url, after) in enumerate(zip(urls, [*urls[1:], "/"]))]
    got = {row["page_id"]: row for row in link_graph.judged(pages(spark, rows), RULES, share=share).collect()}
    for k in range(size):
        mass = 0.15 * 0.85 ** (size - 1 - k)  # settled: each host passes 85% on to the only one that links to it
        assert got[k]["distrust"] / link_graph.MASS == pytest.approx(mass, abs=1e-3 / hosts)
        assert got[k]["verdict"] == ("block" if mass > 0.1 / hosts else "allow")
    verdicts = [got[k]["verdict"] for k in range(size)]
    assert verdicts.index("block") == size - 1 - 101
    with pytest.raises(RuntimeError):
        link_graph.judged(pages(spark, rows), RULES, rounds=3)


def test_a_hub_with_many_links(spark):
    """One page that links to thousands of hosts, each of which links to a blocked one: mass is shared, not copied."""
    n = 3000
    hub = " ".join(f'<a href="http://s{k}.com/">' for k in range(n))
    rows = [(0, "http://hub.com/", hub), (1, "http://bad.net/", None)]
    rows += [(k + 2, f"http://s{k}.com/", '<a href="http://bad.net/">') for k in range(n)]
    got = {row["page_id"]: row for row in link_graph.judged(pages(spark, rows), RULES).collect()}
    each = 0.15 * 0.85 / n  # of the blocked host's distrust, for each that links to it; the hub gets theirs
    assert got[2]["distrust"] / link_graph.MASS == pytest.approx(each, rel=1e-9)
    assert got[0]["distrust"] / link_graph.MASS == pytest.approx(0.15 * 0.85**2, rel=1e-6)
    assert {got[k]["verdict"] for k in (0, 1, 2, n + 1)} == {"block"}


def test_quotes(spark):
    schema = "conv_id long, turn long, role string, text string, level int, hash int, depth string"
    rows = [
        (1, 0, "user", "Hello  World\nHow are you?"),
        (1, 1, "assistant", "Hi!\nfine"),
        (1, 2, "user", "> hello world\n\nNice"),
        (1, 3, "user", "> > How are you?\n> Fine\nme too"),
        (1, 4, "user", "> nice\n> unknown"),
        (1, 5000, "user", ">hi!\nlate"),
        (1, 6, "user", None),
        (2, 0, "user", "> hello world\nother talk"),
        (2, 1, "user", ""),
        (None, 1, "user", "> fine\nx"),
        (2, 1, "user", ""),
    ]
    got = quotes.linked(spark.createDataFrame([(*row, 1, 1, "d") for row in rows], schema))
    found = {(row["conv_id"], row["turn"]): row for row in got.collect()}
    assert got.count() == len(rows)
    shown = {key: (row["text"], row["n_quoted"], row["n_linked"], row["parent_turn"], row["root_turn"], row["depth"]) for key, row in found.items()}
    assert shown[1, 0] == ("Hello  World\nHow are you?", 0, 0, None, 0, 0)
    assert shown[1, 2] == ("Nice", 1, 1, 0, 0, 1)
    assert shown[1, 3] == ("me too", 2, 2, 1, 1, 1) and found[1, 3]["levels"] == 2
    assert shown[1, 4] == ("", 2, 1, 2, 0, 2)
    assert shown[1, 5000] == ("late", 1, 1, 1, 1, 1)
    assert shown[1, 6] == ("", 0, 0, None, 6, 0)
    assert shown[2, 0] == ("other talk", 1, 0, None, 0, 0)
    assert shown[None, 1] == ("x", 1, 0, None, 1, 0)
    assert quotes.linked(spark.createDataFrame([], schema)).count() == 0


def test_wrapped_and_partial_quotes(spark):
    said = "The harbour opens at six. Boats from the north come in by eight, those from the south later. Bring ropes!"
    rows = [
        (1, 0, "user", said),
        (1, 1, "assistant", "No idea.\nAsk them (today). Then write\nto me again when you know more about the\nropes and the boats."),
        (1, 2, "user", "> The harbour opens at\n> six. Boats from the north come in\n> by eight, those from the\n> south later. Bring ropes!\n\nI see"),
        (1, 3, "user", "> Bring ropes!\nhow many"),
        (1, 4, "user", "> from the north come in by eight, those from\nall of them?"),
        (1, 5, "user", "> Then write to me again when you know more about the ropes and\n> the boats.\nyes"),
        (1, 6, "user", ">> Bring\n>> ropes!\n> how\n> many\nthree"),
        (1, 7, "user", "> Boats from the\n\n> south later\nwhich?"),
        (2, 0, "user", "> Bring ropes!\nelsewhere"),
        (3, 0, "user", LONG),
        (3, 1, "user", "\n".join("> " + " ".join(LONG.split()[at : at + 11]) for at in range(500, 600, 11))),
    ]
    schema = "conv_id long, turn long, role string, text string"
    got = {(row["conv_id"], row["turn"]): row for row in quotes.linked(spark.createDataFrame(rows, schema)).collect()}
    parents = {key: row["parent_turn"] for key, row in got.items()}
    assert parents == {(1, 0): None, (1, 1): None, (1, 2): 0, (1, 3): 0, (1, 4): 0, (1, 5): 1, (1, 6): 3, (1, 7): None, (2, 0): None, (3, 0): None, (3, 1): 0}
    assert got[1, 6]["root_turn"] == 0 and got[1, 6]["depth"] == 2 and got[1, 6]["n_linked"] == 2


def plain_links(rows):
    """parent, root, depth and position of every message, passages compared as texts."""

    def passages(text):
        """Level to the set of passages."""
        found = {}
        lines = []
        for line in (text or "").split("\n"):
            marks = re.match(r"((?:[ \t]*>)*)[ \t]?", line) if re.match(r"[ \t]*>", line) else re.match("", line)
            lines.append((marks[0].count(">"), " ".join(line[marks.end() :].split()).lower()))
        for level in {level for level, _ in lines}:
            own, run = found.setdefault(level, set()), []
            for here, norm in [*lines, (None, "")]:
                if here == level and norm:
                    run.append(norm)
                    own.add(norm)
                    continue
                joined, run = " ".join(run), []
                own |= set(re.split(r"(?<=[.!?]) ", joined)) - {""}
                words = joined.split()
                own |= {" ".join(words[k : k + 8]) for k in range(len(words) - 7)}
        return found

    known = {key: passages(text) for *key, _, text in ((c, t, r, x) for c, t, r, x in rows) for key in [tuple(key)]}
    parent = {}
    for (conv, turn), own in known.items():
        sources = [max((t for c, t in known if c == conv and t < turn and passage in known[c, t].get(0, ())), default=None) for passage in own.get(1, ())]
        parent[conv, turn] = max((source for source in sources if source is not None), default=None)
    root, depth = {}, {}
    for conv, turn in sorted(parent):
        above = parent[conv, turn]
        root[conv, turn], depth[conv, turn] = (turn, 0) if above is None else (root[conv, above], depth[conv, above] + 1)
    threads = {}
    for key in sorted(parent, key=lambda key: (key[0], root[key], depth[key], key[1])):
        threads.setdefault((key[0], root[key]), []).append(key)
    position = {key: k for thread in threads.values() for k, key in enumerate(thread)}
    return {key: (parent[key], root[key], depth[key], position[key]) for key in parent}


@pytest.mark.parametrize("stretch", [1024, 3])
def test_random_threads_against_plain_code(spark, stretch, monkeypatch):
    """Branching threads: quotes of whole messages, sentences, wrapped and nested ones, in shuffled order of rows."""
    monkeypatch.setattr(quotes, "STRETCH", stretch)
    own = random.Random(stretch)
    words = [f"word{k}" for k in range(30)]
    rows = []
    for conv in range(4):
        said = []
        for turn in range(25):
            text = ". ".join(" ".join(own.choice(words) for _ in range(own.randint(1, 12))) for _ in range(own.randint(1, 3))) + "."
            if said and own.random() < 0.8:
                source = own.choice(said)
                quote = own.choice([source, own.choice(source.split(". ")), " ".join(source.split()[1:11])])
                if own.random() < 0.5:  # wrapped anew
                    parts = quote.split()
                    quote = "\n".join(" ".join(parts[k : k + 5]) for k in range(0, len(parts), 5))
                mark = own.choice(["> ", ">", "> > "])
                text = "\n".join(mark + line for line in quote.split("\n")) + "\n" + text
            said.append(text.split("\n")[-1])
            rows.append((conv, turn, own.choice(["user", "assistant"]), text))
    own.shuffle(rows)
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(row["conv_id"], row["turn"]): (row["parent_turn"], row["root_turn"], row["depth"], row["position"]) for row in quotes.linked(messages).collect()}
    want = plain_links(rows)
    assert got == want and max(depth for _, _, depth, _ in want.values()) > 2
    threads = {(row["conv_id"], row["root_turn"]): [one["turn"] for one in row["messages"]] for row in quotes.conversations(messages).collect()}
    expected = {}
    for (conv, turn), (_, root, _, position) in sorted(want.items(), key=lambda item: (item[0][0], item[1][1], item[1][3])):
        expected.setdefault((conv, root), []).append(turn)
    assert threads == expected


# --- registered queries --------------------------------------------------------------------------------------


def test_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_word_hashes_keep_little_however_long_the_texts_are():
    line = b"several words " * 220_000
    hashing._powers.cache_clear()
    tracemalloc.start()
    try:
        found = word_hashes([line])
        del found
        assert tracemalloc.get_traced_memory()[0] < 8_000_000
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_words_have_the_same_hash_wherever_they_stand(monkeypatch, size):
    """Across the ends of stretches, before and after words longer than one, and empty ones."""
    words = [b"", b"a", b"bc" * 9, b"", b"d" * 2500, b"ef", b"g" * 1001, b"\xff\x00", b"h" * 999, b""] * 3

    def plain(word):
        total = sum((byte + 1) * pow(0x9E3779B97F4A7C15, at, 1 << 64) for at, byte in enumerate(word)) % (1 << 64)
        return int(hashing.mixed(np.array([total], np.uint64))[0])

    expected = [plain(word) for word in words]
    monkeypatch.setattr(hashing, "AT_ONCE", size)
    hashing._powers.cache_clear()
    try:
        assert word_hashes([b" ".join(words)]).tolist() == word_hashes(words).tolist() == expected
    finally:
        hashing._powers.cache_clear()
