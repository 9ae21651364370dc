"""Line dedup: lines of the whole corpus that are the same but for small edits; one occurrence of each group stays."""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import group_starts, map_rows, shuffle_partitions, whole_groups, written
from marketlens.llm.components import components
from marketlens.llm.hamming import dealt_in_chunks
from marketlens.llm.hashing import word_hashes

#: ASCII characters but letters, digits and line ends become spaces; bytes of other characters stay.
_FOLD = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 or b == 10 else 32 for b in range(256))
#: Scripts that are written without spaces: there each character is a word. Thai to Lao, Myanmar, Khmer, Han, kana.
_UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")


def normalised(line: str) -> bytes:
    """Lower case, ASCII punctuation and white space as single spaces, trimmed."""
    return b" ".join(line.lower().encode("utf-8", "surrogatepass").translate(_FOLD).split())


def _normalised_lines(text: str | None) -> list[bytes]:
    folded = (text or "").lower().encode("utf-8", "surrogatepass").translate(_FOLD)
    return [b" ".join(line.split()) for line in folded.split(b"\n")]


def _spaced(line: bytes) -> bytes:
    """The line with one space between its words, also where its script has none."""
    return b" ".join(_UNSPACED.sub(r" \1 ", line.decode("utf-8", "surrogatepass")).encode("utf-8", "surrogatepass").split())


#: Blocks of a line's fingerprint. The last bits of a block are its number.
BLOCKS = 8
_NUMBER = BLOCKS - 1
#: Bytes of words that a block has at least.
LEAST_BYTES = 12
#: Names of the columns that hold them.
_COLUMNS = [f"block_{number}" for number in range(BLOCKS)]
#: Words and lines that are hashed together; lines times blocks stay under 2^16.
WORDS, LINES = 50_000, 2_000


def fingerprints(lines: list[bytes]) -> np.ndarray:
    """The blocks of each line, then the SimHash of all its words, as rows of 64-bit integers; 0 where there is no block.

    Lines have at least one word. The different words of a line fall into classes by their hash. A block is the SimHash of the words of its class and, as
    long as these have under `LEAST_BYTES` bytes, of the classes after it, the first after the last; a line that is shorter
    than that has equal blocks for all its classes. A class without words begins no block.
    """
    if np.frombuffer(b"".join(lines), np.uint8).max(initial=0) >= 0xE0:  # a character of three bytes
        lines = [_spaced(line) if max(line) >= 0xE0 else line for line in lines]
    sizes = np.array([line.count(b" ") + 1 for line in lines], np.int64)
    found = np.empty((len(lines), BLOCKS + 1), np.int64)
    # Sums of bits are kept modulo 2^8 for lines of fewer words, modulo 2^64 for the others.
    for rows, kind in ((np.flatnonzero(sizes < 256), np.uint8), (np.flatnonzero(sizes >= 256), np.int64)):
        start = 0
        while start < len(rows):
            held = np.cumsum(sizes[rows[start : start + LINES]])
            own = rows[start : start + max(1, int(np.searchsorted(held, WORDS)))]
            found[own] = _blocks([lines[row] for row in own], sizes[own], kind)
            start += len(own)
    return found


def _blocks(lines: list[bytes], sizes: np.ndarray, kind: type) -> np.ndarray:
    n = len(lines)
    hashes = word_hashes(lines)
    ends = np.append(np.flatnonzero(np.frombuffer(b" ".join(lines), np.uint8) == 32), sum(map(len, lines)) + n - 1)
    lengths = np.diff(ends, prepend=-1) - 1
    slot = np.repeat(np.arange(n), sizes) * BLOCKS + ((hashes >> np.uint64(40)) % np.uint64(BLOCKS)).astype(np.int64)
    # By slot, then by as many bits of the hash as there is room for.
    key = (slot.astype(np.uint64) << np.uint64(48)) | (hashes >> np.uint64(16))
    order = np.argsort(key)
    order = order[np.append(True, np.diff(key[order]) != 0)]  # each word once
    slot, lengths = slot[order], lengths[order]
    bits = np.unpackbits(hashes[order].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    firsts = np.flatnonzero(np.diff(slot, prepend=-1))
    ones = np.zeros((n * BLOCKS, 64), kind)
    if kind is np.uint8:  # eight counters at once
        ones[slot[firsts]] = np.add.reduceat(bits.view(np.uint64), firsts, axis=0).view(np.uint8)
    else:
        ones[slot[firsts]] = np.add.reduceat(bits, firsts, axis=0, dtype=kind)
    words, size = (np.bincount(slot, weights, n * BLOCKS).astype(np.int64).reshape(n, BLOCKS) for weights in (None, lengths))
    before_ones, before_words, before_size = (_twice_round(own) for own in (ones.reshape(n, BLOCKS, 64), words, size))
    found, numbers = np.zeros((n, BLOCKS + 1), np.int64), np.arange(BLOCKS)
    # Where each class's block ends: the first class by which there are enough bytes, or the class before its own.
    enough = np.stack([before_size[:, k + 1 : k + BLOCKS + 1] for k in numbers], axis=1) - before_size[:, :BLOCKS, None] >= LEAST_BYTES
    enough[:, :, -1] = True
    stop = np.arange(n)[:, None], numbers + 1 + enough.argmax(axis=2)
    value = _majority(before_ones[stop] - before_ones[:, :BLOCKS], before_words[stop] - before_words[:, :BLOCKS])
    found[:, :BLOCKS] = np.where(words > 0, value & ~_NUMBER | numbers, 0)
    # The block of number 0 may by chance have no other bit; it must not look like none.
    found[:, 0] = np.where((found[:, 0] == 0) & (words[:, 0] > 0), _NUMBER + 1, found[:, 0])
    found[:, BLOCKS] = _majority(before_ones[:, BLOCKS], before_words[:, BLOCKS])
    return found


def _twice_round(own: np.ndarray) -> np.ndarray:
    """Sums over the classes before each, the classes taken twice."""
    sums = np.zeros((len(own), 2 * BLOCKS + 1, *own.shape[2:]), own.dtype)
    np.cumsum(own, axis=1, out=sums[:, 1 : BLOCKS + 1])
    np.add(sums[:, 1 : BLOCKS + 1], sums[:, BLOCKS, None], out=sums[:, BLOCKS + 1 :])
    return sums


def _majority(ones: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The bits that over half of the words have."""
    packed = np.packbits(ones > (words // 2).astype(ones.dtype)[..., None], axis=-1, bitorder="little")
    return np.ascontiguousarray(packed).view("<i8")[..., 0]


def _edits(a: str, b: str, most: int | None = None) -> int:
    """Edit distance, all cells of a column at once as the bits of one number; over `most`, any number over it."""
    masks: dict[str, int] = {}
    for place, char in enumerate(a):
        masks[char] = masks.get(char, 0) | 1 << place
    every, last, distance = (1 << len(a)) - 1, 1 << len(a) >> 1, len(a)
    up, down = every, 0
    left = len(b) + (len(a) + len(b) if most is None else most)
    for char in b:
        same = masks.get(char, 0)
        vertical = same | down
        flat = (((same & up) + up) ^ up) | same
        rise, fall = down | ~(flat | up), up & flat
        distance += bool(rise & last) - bool(fall & last)
        left -= 1
        if distance > left:  # what is left of `b` cannot take it back to `most`
            return distance
        rise, fall = rise << 1 | 1, fall << 1
        up, down = (fall | ~(vertical | rise)) & every, rise & vertical & every
    return distance


def _rewritten(words: list[str], others: list[str], most: int) -> bool:
    """Whether writing words anew surely takes at most `most` edits, going on at the nearest word that both have again."""
    i = j = edits = 0
    while i < len(words) and j < len(others):
        if words[i] == others[j]:
            i, j = i + 1, j + 1
            continue
        for step, other in _STEPS:
            if i + step < len(words) and j + other < len(others) and words[i + step] == others[j + other]:
                break
        else:
            step = other = 1
        edits += max(sum(map(len, words[i : i + step])) + step, sum(map(len, others[j : j + other])) + other)
        if edits > most:
            return False
        i, j = i + step, j + other
    left = [*words[i:], *others[j:]]
    return edits + sum(map(len, left)) + len(left) <= most


#: Words to pass over on either side, fewest first.
_STEPS = sorted(((i, j) for i in range(5) for j in range(5) if i + j), key=lambda step: (max(step), sum(step)))


def similar(a: str, b: str, least: float) -> bool:
    """Whether 1 - edits / length of the longer text is at least `least`."""
    most = int((1 - least) * max(len(a), len(b)) + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    short = min(len(a), len(b))
    head = next((k for k in range(short) if a[k] != b[k]), short)
    tail = next((k for k in range(short - head) if a[-1 - k] != b[-1 - k]), short - head)
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    if _rewritten(a.split(" "), b.split(" "), most):
        return True
    return max(len(a), len(b)) <= most or (bool(a) and bool(b) and _edits(a, b, most) <= most)


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line, size, block_0 and so on) of each line that is not empty: a 128-bit hash of its normal form,
    its number of characters, and the blocks of its fingerprint.
    """

    def make(batch: pa.RecordBatch) -> dict[str, list]:
        ids, numbers, lines = [], [], []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            for number, line in enumerate(_normalised_lines(text)):
                if line:
                    ids.append(doc_id)
                    numbers.append(number)
                    lines.append(line)
        blocks = fingerprints(lines)
        return {
            "doc_id": ids,
            "line_no": numbers,
            "line": [xxhash.xxh3_128_digest(line) for line in lines],
            "size": [len(line.decode("utf-8", "surrogatepass")) for line in lines],
        } | {name: pa.array(blocks[:, number]) for number, name in enumerate(_COLUMNS)}

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, line_no int, line binary, size int, " + ", ".join(f"{name} long" for name in _COLUMNS)
    return map_rows(docs, make, schema)


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(line, doc_id, line_no, text): the normal form of the `wanted` line numbers (an array) of each document."""

    def make(batch: pa.RecordBatch) -> dict[str, list]:
        ids, places, texts = [], [], []
        for doc_id, text, numbers in zip(*(batch.column(name).to_pylist() for name in ("doc_id", "text", "numbers"))):
            lines = _normalised_lines(text)
            numbers = [number for number in numbers if number < len(lines)]
            ids += [doc_id] * len(numbers)
            places += numbers
            texts += [lines[number] for number in numbers]
        hashes = [xxhash.xxh3_128_digest(text) for text in texts]
        return {"line": hashes, "doc_id": ids, "line_no": places, "text": [text.decode("utf-8", "surrogatepass") for text in texts]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    made = map_rows(docs.join(wanted, "doc_id"), make, f"line binary, doc_id {kind}, line_no int, text string")
    return made.dropDuplicates(["line"])  # rows may share an id


def _bags(texts: list[str]) -> np.ndarray:
    """How many characters of each of 64 kinds each text has."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4") & np.uint32(63)
    rows = np.repeat(np.arange(len(texts)) * 64, [len(text) for text in texts])
    return np.bincount(rows + codes, minlength=64 * len(texts)).reshape(-1, 64).astype(np.int32)


def _verified(
    texts: list[str], starts: np.ndarray, numbers: np.ndarray, least: float, radius: int
) -> list[tuple[int, int]]:
    """Pairs of close and similar rows of one bucket: enough to connect all that such pairs connect.

    `starts` says where the buckets begin, `numbers` the bucket's number of each row. Pairs that agree in a block of a
    lower number meet there.
    """
    n = len(texts)
    labels, links = np.arange(n), []
    sizes, bags = np.array([len(text) for text in texts]), _bags(texts)
    blocks = fingerprints([text.encode("utf-8", "surrogatepass") for text in texts])
    blocks, prints = blocks[:, :BLOCKS], blocks[:, BLOCKS].view(np.uint64)
    first = np.repeat(starts, np.diff(np.append(starts, n)))
    todo = np.cumsum(np.arange(n) - first)
    begin = 0
    while begin < n:
        stop = max(begin + 1, int(np.searchsorted(todo, (todo[begin - 1] if begin else 0) + 50_000)))
        before = np.arange(begin, stop) - first[begin:stop]
        rows = np.repeat(np.arange(begin, stop), before)
        others = first[rows] + np.arange(len(rows)) - np.repeat(np.cumsum(before) - before, before)
        most = ((1 - least) * np.maximum(sizes[rows], sizes[others]) + 1e-9).astype(np.int64)
        close = np.bitwise_count(prints[rows] ^ prints[others]) <= radius
        left = np.flatnonzero(close & (np.abs(sizes[rows] - sizes[others]) <= most) & (labels[rows] != labels[others]))
        rows, others, most = rows[left], others[left], most[left]
        # An edit takes away or brings at most one character.
        beyond = bags[rows] - bags[others]
        left = np.flatnonzero(np.maximum(np.maximum(beyond, 0).sum(axis=1), np.maximum(-beyond, 0).sum(axis=1)) <= most)
        rows, others = rows[left], others[left]
        lowest = ((blocks[rows] == blocks[others]) & (blocks[rows] != 0)).argmax(axis=1)
        left = lowest >= numbers[rows]
        for row, other in zip(rows[left].tolist(), others[left].tolist()):
            if labels[row] != labels[other] and similar(texts[row], texts[other], least):
                links.append((row, other))
                group = labels[first[row] : stop]
                group[group == labels[row]] = labels[other]
        begin = stop
    return links


def _links(
    docs: DataFrame, distinct: DataFrame, least: float, radius: int, chunk: int
) -> tuple[DataFrame, DataFrame]:
    """(node, smaller): verified links between distinct lines that agree in a block; and (node, line, doc_id, line_no)."""
    # The hash of a line and, in the last 20 bits, its size: one number for what the buckets need.
    short = F.xxhash64("line").bitwiseAND(F.lit(-1 << 20)).bitwiseOR(F.least("size", F.lit((1 << 20) - 1)).cast("long"))
    lines = distinct.withColumn("short", short)
    rows = lines.select("short", F.explode(F.array(*_COLUMNS)).alias("key")).filter("key <> 0")
    one, other = (F.col(f"{side}.short").bitwiseAND(F.lit((1 << 20) - 1)) for side in "ab")
    near = (
        (F.col("a.key") == F.col("b.key"))
        & (F.col("a.short") != F.col("b.short"))
        & ((F.greatest(one, other) == (1 << 20) - 1) | (F.least(one, other) >= least * F.greatest(one, other) - 1e-6))
    )
    # Blocks are hashes of words that are seldom together, so most lines end here.
    found = written(rows.alias("a").join(rows.alias("b"), near, "left_semi"), "near-lines")
    # Buckets with the same lines: the one of the lowest number is enough.
    sets = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("short")).alias("members"))
    lowest = F.min_by("key", F.col("key").bitwiseAND(F.lit(_NUMBER)))
    sets = sets.groupBy("n", "members").agg(lowest.alias("key")).select("key", F.col("n").alias("count"))
    found = written(dealt_in_chunks(found.join(sets, "key"), "short", chunk), "near-lines")
    places = lines.select("short", "doc_id", "line_no").join(found.select("short"), "short", "left_semi")
    wanted = places.groupBy("doc_id").agg(F.collect_set("line_no").alias("numbers"))
    size = F.least(F.char_length("text"), F.lit((1 << 20) - 1)).cast("long")
    texts = _texts(docs, wanted).withColumn("short", F.xxhash64("line").bitwiseAND(F.lit(-1 << 20)).bitwiseOR(size))
    texts = written(texts.withColumn("node", F.monotonically_increasing_id()), "near-texts")
    order = ["key", "first", "second"]
    dealt = found.join(texts, "short").select(*order, "node", "text")
    dealt = dealt.repartition(shuffle_partitions(docs.sparkSession), *order).sortWithinPartitions(*order)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, order, rows=2048):
            starts, number = group_starts(part, order), part.column("key").to_numpy() & _NUMBER
            links = np.array(_verified(part.column("text").to_pylist(), starts, number, least, radius), np.int64)
            nodes = part.column("node").to_numpy()[links.reshape(-1, 2)]
            yield pa.RecordBatch.from_arrays([pa.array(nodes[:, side]) for side in (0, 1)], ["node", "smaller"])

    places = texts.select("node", "line", "doc_id", "line_no")
    return dealt.mapInArrow(verify, "node long, smaller long").distinct(), places


def repeated_lines(
    docs: DataFrame, least: float = 0.8, radius: int = 16, doc_id: str = "doc_id", text: str = "text", chunk: int = 2048
) -> DataFrame:
    r"""(doc_id, removed): numbers (from 0, ascending) of the lines to remove, for each document that has some.

    Lines are split at \n and normalised: lower case, ASCII punctuation and white space as single spaces. Lines of which
    nothing is left stay; of all others equal ones are folded, whatever their length. A line's fingerprint has 8 blocks
    (`fingerprints`), each the SimHash of another part of its words. An edit of one word touches two blocks at most, so
    lines that are nearly the same agree in one, and those that do are compared. They are linked if the SimHashes of all
    their words differ in `radius` bits or fewer and their edit similarity, 1 - edits / characters of the longer one, is
    `least` or more. Of each connected group the occurrence with the smallest (doc_id, line number) stays.

    So a link is: a block in common, close SimHashes, and the similarity. Which similar lines fail the first two is a matter
    of chance; see the README for figures. In scripts without spaces each character is a word.

    Lines of rows without id always stay, as they have no place in the order. Rows that repeat an id are judged alike: the
    same lines go from each. Null and empty texts and empty tables remove nothing. Other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter("doc_id IS NOT NULL")
    lines = written(_lines(rows), "lines")
    place = F.struct("doc_id", "line_no")
    known = [F.first(name).alias(name) for name in ("size", *_COLUMNS)]
    distinct = lines.groupBy("line").agg(F.min(place).alias("place"), *known, F.count(F.lit(1)).alias("times"))
    distinct = written(distinct.select("line", "place.*", "size", "times", *_COLUMNS), "distinct-lines")
    links, places = _links(rows, distinct, least, radius, chunk)
    member = places.select("node", "line", place.alias("place")).join(components(links), "node")
    member = written(member.select("line", "place", "component"), "members")
    first = member.groupBy("component").agg(F.min("place").alias("first"))
    grouped = member.join(first, "component").select("line", "first")
    alone = distinct.filter("times > 1").select("line", place.alias("first")).join(member, "line", "left_anti")
    firsts = grouped.unionByName(alone)
    copies = lines.select("doc_id", "line_no", "line").join(firsts, "line")
    extra = copies.filter(place != F.col("first"))
    return extra.groupBy("doc_id").agg(F.sort_array(F.collect_set("line_no")).alias("removed"))


def without_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options: object) -> DataFrame:
    """The rows and columns of `docs`, texts without the lines that `repeated_lines` names.

    A document that had only such lines is left out; one that was null or empty before stays as it is.
    """
    removed = written(repeated_lines(docs, doc_id=doc_id, text=text, **options), "removed-lines")
    # Under names of their own the columns clash with nothing here, and each goes through the join once.
    names = {name: f"column {number}" for number, name in enumerate(docs.columns)}
    own_id, own_text = F.col(names[doc_id]), F.col(names[text])
    kept = F.filter(F.split(own_text, "\n"), lambda line, number: ~F.array_contains(F.col("removed"), number))
    named = docs.toDF(*names.values()).join(removed, own_id == F.col("doc_id"), "left")
    named = named.withColumn("kept", F.when(F.col("removed").isNotNull(), kept)).filter("kept IS NULL OR size(kept) > 0")
    shorter = F.when(F.col("kept").isNull(), own_text).otherwise(F.array_join("kept", "\n"))
    return named.withColumn(names[text], shorter).select(*(F.col(own).alias(name) for name, own in names.items()))
