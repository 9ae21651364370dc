"""Substring dedup: words of passages that an earlier document has too are removed, wherever the passage lies.

Hashing every window of a corpus moves a hash a word. A difference cover modulo a period needs three positions in
seven: of two equal passages, however they lie, some position in the first seven words is in the cover in both, so they
share an anchor there, a hash of seven words. Anchors that come twice lead to the windows around them, and only these
are hashed in full and compared.

Documents are dealt into groups by a hash of their id, and what a group sends is folded first: one anchor and one window
each, however many of its documents have it. So what meets at a common passage is one entry a group, not one a document.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import shuffle_partitions
from marketlens.llm.hashing import mixed, word_hashes

#: A perfect difference cover: every difference modulo 7 is one of two of these positions.
PERIOD, COVER = 7, (0, 1, 3)
LOW48 = np.uint64((1 << 48) - 1)
#: Characters of text whose words are held at once.
AT_ONCE = 4_000_000


def _rolled(values: np.ndarray, size: int, base: int) -> np.ndarray:
    """A hash of each run of `size` values."""
    n = len(values) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * np.uint64(base) + values[k : k + n]
    return mixed(total)


class _Words:
    """Hashed words of some documents in a row: `place` is a word's number in its document, `left` how many follow it."""

    def __init__(self, texts: list[list[bytes]]):
        sizes = np.array([len(words) for words in texts], np.int64)
        everything = [word for words in texts for word in words]
        self.hashes = word_hashes(everything) if everything else np.empty(0, np.uint64)
        self.doc = np.repeat(np.arange(len(texts)), sizes)
        self.place = np.arange(len(self.doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.left = np.repeat(sizes, sizes) - self.place

    def anchors(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the anchors and their hashes."""
        at = np.flatnonzero(np.isin(self.place % PERIOD, COVER) & (self.left >= size))
        return at, _rolled(self.hashes, size, 0x9E3779B97F4A7C15)[at]

    def windows(self, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """96 bits for the window at each position, as a long and a short number."""
        long = _rolled(self.hashes, size, 0xD6E8FEB86659FD93)
        short = _rolled(mixed(self.hashes + np.uint64(1)), size, 0xC2B2AE3D27D4EB4F)
        return long[at], (short[at] >> np.uint64(32)).astype(np.uint32)


def _parts(group: pa.Table):
    """(first row, words of each row) for some rows of a group at a time."""
    texts = group.column("text").to_pylist()
    start = 0
    while start < len(texts):
        stop, held = start, 0
        while stop < len(texts) and (stop == start or held + len(texts[stop] or "") < AT_ONCE):
            held += len(texts[stop] or "")
            stop += 1
        yield start, [(text or "").encode("utf-8", "surrogatepass").split() for text in texts[start:stop]]
        start = stop


def _bytes48(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from48(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view("<u8")[:, 0]


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(48)) % np.uint64(buckets)).astype(np.int64)


def _runs(buckets: np.ndarray):
    """(bucket, start, end) of each run of equal buckets."""
    cuts = np.flatnonzero(np.diff(buckets, prepend=-1))
    return zip(buckets[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(buckets)])


def _keyed(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and low bits: what is known of an anchor after its way through a bucket."""
    return (_bucket(hashes, buckets).astype(np.uint64) << np.uint64(48)) | (hashes & LOW48)


def _table(columns: dict[str, tuple[list, pa.DataType]]) -> pa.Table:
    return pa.table({name: pa.array(values, kind) for name, (values, kind) in columns.items()})


def _send_anchors(group: pa.Table, size: int, buckets: int) -> pa.Table:
    """The group's anchors, sorted and folded, one row a bucket: those it has once and those it has more often."""
    found = [_keyed(_Words(words).anchors(size)[1], buckets) for _, words in _parts(group)]
    keys, counts = np.unique(np.concatenate(found or [np.empty(0, np.uint64)]), return_counts=True)
    rows = [], [], []
    for bucket, start, end in _runs((keys >> np.uint64(48)).astype(np.int64)):
        own, more = keys[start:end], counts[start:end] > 1
        for column, value in zip(rows, (bucket, _bytes48(own[~more]), _bytes48(own[more]))):
            column.append(value)
    deal = [group.column("deal")[0].as_py()] * len(rows[0])
    kinds = (deal, pa.int32()), (rows[0], pa.int32()), (rows[1], pa.binary()), (rows[2], pa.binary())
    return _table(dict(zip(("deal", "bucket", "once", "more"), kinds)))


def _repeated_anchors(rows: pa.Table) -> pa.Table:
    """For each group the anchors of this bucket that come at least twice in the corpus."""
    once = [_from48(data) for data in rows.column("once").to_pylist()]
    more = [_from48(data) for data in rows.column("more").to_pylist()]
    every, counts = np.unique(np.concatenate(once + more), return_counts=True)
    common = np.union1d(every[counts > 1], np.concatenate(more))
    sent = [_bytes48(own[np.isin(own, common)]) for own in map(np.concatenate, zip(once, more))]
    bucket = rows.column("bucket").to_pylist()
    return _table(
        {"deal": (rows.column("deal").to_pylist(), pa.int32()), "bucket": (bucket, pa.int32()), "anchors": (sent, pa.binary())}
    )


def _candidates(words: _Words, common: np.ndarray, size: int, window: int, buckets: int) -> np.ndarray:
    """Positions of the windows with a repeated anchor among their first `PERIOD` words."""
    at, hashes = words.anchors(size)
    at = at[np.isin(_keyed(hashes, buckets), common)]
    change = np.zeros(len(words.doc) + 1, np.int64)
    np.add.at(change, at - np.minimum(words.place[at], PERIOD - 1), 1)
    np.add.at(change, at + 1, -1)
    return np.flatnonzero((np.cumsum(change)[:-1] > 0) & (words.left >= window))


def _least(long: np.ndarray, short: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of each window's first entry by document, and for every entry the place among these."""
    order = np.lexsort((doc, short, long))
    new = np.append(True, (np.diff(long[order]) != 0) | (np.diff(short[order]) != 0))[: len(order)]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def _send_windows(group: pa.Table, anchors: pa.Table, size: int, window: int, buckets: int) -> pa.Table:
    """The group's windows with repeated anchors, each with the smallest id that has it, one row a bucket."""
    ids = group.column("doc_id").to_numpy()
    common = [
        _from48(data) | np.uint64(bucket << 48)
        for bucket, data in zip(anchors.column("bucket").to_pylist(), anchors.column("anchors").to_pylist())
    ]
    common = np.concatenate(common) if common else np.empty(0, np.uint64)
    found = []
    for first, texts in _parts(group) if len(common) else ():
        words = _Words(texts)
        at = _candidates(words, common, size, window, buckets)
        long, short = words.windows(at, window)
        own = ids[first + words.doc[at]]
        kept, _ = _least(long, short, own)
        found.append((long[kept], short[kept], own[kept]))
    rows = [], [], [], []
    if found:
        long, short, own = (np.concatenate(column) for column in zip(*found))
        kept, _ = _least(long, short, own)
        kept = kept[np.argsort(_bucket(long[kept], buckets), kind="stable")]
        long, short, own = long[kept], short[kept], own[kept]
        for bucket, start, end in _runs(_bucket(long, buckets)):
            part = slice(start, end)
            values = bucket, long[part].tobytes(), short[part].tobytes(), own[part].astype(np.int64).tobytes()
            for column, value in zip(rows, values):
                column.append(value)
    deal = [group.column("deal")[0].as_py() if group.num_rows else 0] * len(rows[0])
    kinds = (deal, pa.int32()), (rows[0], pa.int32()), *((column, pa.binary()) for column in rows[1:])
    return _table(dict(zip(("deal", "bucket", "long", "short", "ids"), kinds)))


def _unpacked(rows: pa.Table) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    kinds = (("long", np.uint64), ("short", np.uint32), ("ids", np.int64))
    columns = [[np.frombuffer(data, kind) for data in rows.column(name).to_pylist()] for name, kind in kinds]
    return list(zip(*columns))


def _earlier_windows(rows: pa.Table) -> pa.Table:
    """For each group those of its windows that another group has in a document with a smaller id, and that id."""
    parts = _unpacked(rows)
    long, short, ids = (np.concatenate(column) for column in zip(*parts))
    kept, number = _least(long, short, ids)
    least = ids[kept][number]
    sent, start = ([], [], []), 0
    for own in parts:
        part = slice(start, start + len(own[0]))
        start = part.stop
        less = least[part] < own[2]
        for column, values in zip(sent, (long[part], short[part], least[part])):
            column.append(values[less].tobytes())
    deal = rows.column("deal").to_pylist()
    kinds = (deal, pa.int32()), *((column, pa.binary()) for column in sent)
    return _table(dict(zip(("deal", "long", "short", "ids"), kinds)))


def _cut(group: pa.Table, earlier: pa.Table, window: int) -> pa.Table:
    """Each document without the words of windows that start in a document with a smaller id, of any group."""
    ids = group.column("doc_id").to_numpy()
    parts = list(_parts(group))
    held = [_Words(texts) for _, texts in parts]
    ats = [np.flatnonzero(words.left >= window) for words in held]
    own = [(*words.windows(at, window), ids[first + words.doc[at]]) for (first, _), words, at in zip(parts, held, ats)]
    every = [*own, *_unpacked(earlier)]
    long, short, doc = (np.concatenate(column) for column in zip(*every))
    kept, number = _least(long, short, doc)
    late = doc[kept][number] < doc
    n_words, n_removed, texts, start = [], [], [], 0
    for (_, lists), words, at in zip(parts, held, ats):
        change = np.zeros(len(words.doc) + 1, np.int64)
        begins = at[late[start : start + len(at)]]
        start += len(at)
        np.add.at(change, begins, 1)
        np.add.at(change, begins + window, -1)
        gone, first = np.cumsum(change)[:-1] > 0, 0
        for own_words in lists:
            mask = gone[first : first + len(own_words)]
            first += len(own_words)
            left = own_words if not mask.any() else [own_words[k] for k in np.flatnonzero(~mask)]
            n_words.append(len(own_words))
            n_removed.append(len(own_words) - len(left))
            texts.append(b" ".join(left).decode("utf-8", "surrogatepass"))
    return pa.table(
        {
            "doc_id": group.column("doc_id"),
            "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "kept": pa.array(texts, pa.string()),
        }
    )


def without_repeats(
    docs: DataFrame, window: int = 13, doc_id: str = "doc_id", text: str = "text", groups: int | None = None
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row: its words without those of repeated windows, spaces between.

    Words are runs without white space, as written. A window is `window` (at least 7) words in a row of one document;
    all words of a window go if the same words also start in a document with a smaller id. Windows are judged on the
    input. A null or empty text has no words; rows that repeat an id are judged alike; a row without id has no place in
    the order, so it loses nothing and takes nothing. An empty table gives no rows. Other columns are ignored. Ids are whole
    numbers; what cannot be cast to one is an error.

    Texts are shuffled once, into `groups` (twice the shuffle partitions unless given) by a hash of the id; a group's
    texts must fit in a task. Later steps move hashes only: folded anchors, the repeated ones back, folded windows, and
    those with an earlier document back. Windows are compared by 96 bits.
    """
    if window < PERIOD:
        raise ValueError(f"a window must have at least {PERIOD} words")
    size = window - PERIOD + 1
    spark = docs.sparkSession
    buckets = min(2 * shuffle_partitions(spark), 1 << 16)
    deals = groups or 2 * shuffle_partitions(spark)
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    dealt = own.filter("doc_id IS NOT NULL")
    dealt = dealt.select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(deals)).cast("int").alias("deal"))
    texts = dealt.repartition(shuffle_partitions(spark), "deal").groupBy("deal")

    anchors = texts.applyInArrow(
        lambda group: _send_anchors(group, size, buckets), "deal int, bucket int, once binary, more binary"
    )
    common = anchors.groupBy("bucket").applyInArrow(_repeated_anchors, "deal int, bucket int, anchors binary")
    windows = texts.cogroup(common.groupBy("deal")).applyInArrow(
        lambda group, known: _send_windows(group, known, size, window, buckets),
        "deal int, bucket int, long binary, short binary, ids binary",
    )
    earlier = windows.groupBy("bucket").applyInArrow(_earlier_windows, "deal int, long binary, short binary, ids binary")
    schema = "doc_id long, n_words long, n_removed long, kept string"
    cut = texts.cogroup(earlier.groupBy("deal")).applyInArrow(lambda group, known: _cut(group, known, window), schema)
    bare = own.filter("doc_id IS NULL")
    whole = F.array_remove(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), "")
    rest = bare.select("doc_id", F.size(whole).cast("long"), F.lit(0).cast("long"), F.array_join(whole, " "))
    return cut.union(rest)
