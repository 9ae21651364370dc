"""Benchmark decontamination: one Aho-Corasick automaton over all test passages, one pass over each text."""

import re
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import map_rows, written

#: Byte by byte: A-Z become a-z, every other ASCII character but digits and letters a space.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

FOUND = ("n_words", "n_hit", "items", "firsts", "lasts", "starts", "ends")
HITS = (
    "n_words long, n_hit long, items array<string>, firsts array<int>, lasts array<int>, "
    "starts array<int>, ends array<int>"
)


def _words(text: str | None) -> list[bytes]:
    """Normalised words. Other characters stay as they are, byte by byte."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _spaced(words: list[bytes]) -> str:
    """Words with a space on each side, one character a byte."""
    return " " + b" ".join(words).decode("latin-1") + " " if words else ""


def _windows(words: list[bytes], size: int) -> Iterator[str]:
    for start in range(max(1, len(words) - size + 1) if words else 0):
        yield _spaced(words[start : start + size])


class Scanner:
    """The automaton, built once per Python worker from (item, text) pairs."""

    def __init__(self, items: list[tuple[str, str]], size: int):
        self.items, self.size, self.automaton = items, size, None

    def __getstate__(self) -> dict:
        return {"items": self.items, "size": self.size, "automaton": None}

    def _build(self) -> None:
        owners: dict[str, set[str]] = {}
        for item, text in self.items:
            for window in _windows(_words(text), self.size):
                owners.setdefault(window, set()).add(item)
        self.automaton = ahocorasick.Automaton()
        for window, names in owners.items():
            self.automaton.add_word(window, (len(window), tuple(names)))
        self.automaton.make_automaton()

    def scan(self, text: str | None, before: tuple = ((), (), ())) -> tuple:
        """The values of FOUND. `before` has items, firsts and lasts that other automata have found in this text."""
        if self.automaton is None:
            self._build()
        words = _words(text)
        known, firsts, lasts = before
        seen = self.automaton.iter(_spaced(words)) if words and len(self.automaton) else ()
        found = [(end - size + 1, end, names) for end, (size, names) in seen]
        if not found and not len(known):
            return len(words), 0, [], [], [], [], []
        begins = np.fromiter(accumulate((len(word) + 1 for word in words), initial=0), np.int64, len(words) + 1)
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, np.searchsorted(begins, [first for first, _, _ in found]), 1)
        np.add.at(change, np.searchsorted(begins, [end for _, end, _ in found]), -1)
        np.add.at(change, np.asarray(firsts, np.int64), 1)
        np.add.at(change, np.asarray(lasts, np.int64) + 1, -1)
        hit = np.cumsum(change)[:-1] > 0
        edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
        firsts, lasts = edges[::2].tolist(), (edges[1::2] - 1).tolist()
        wanted = {*firsts, *lasts}
        spans = {k: m.span() for k, m in enumerate(_WORD.finditer(text)) if k in wanted}
        items = sorted({name for _, _, names in found for name in names} | {*known})
        starts, ends = [spans[k][0] for k in firsts], [spans[k][1] for k in lasts]
        return len(words), int(hit.sum()), items, firsts, lasts, starts, ends


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The benchmark in blocks of at most `block_bytes` of text (or one item), read partition by partition."""
    block: list[tuple[str, str]] = []
    held = 0
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).dropna()
    for row in rows.toLocalIterator():
        size = len(row["text"])
        if block and held + size > block_bytes:
            yield block
            block, held = [], 0
        block.append((row["item"], row["text"]))
        held += size
    yield block


def _automata(benchmark: DataFrame, item: str, text: str, window: int, block_bytes: int) -> Iterator[Broadcast]:
    context = benchmark.sparkSession.sparkContext
    for block in _blocks(benchmark, item, text, block_bytes):
        yield context.broadcast(Scanner(block, window))


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = 8_000_000,
) -> DataFrame:
    """Which words of each document lie inside a benchmark window.

    Texts are lower-cased (A-Z) and cut into words of letters, digits and non-ASCII characters. A window is `window`
    consecutive words of an item; an item of fewer words is one window. Returns per document row: `doc_id`, n_words,
    n_hit, items (found, sorted as text), firsts and lasts (hit spans as word numbers), starts and ends (the same spans
    as character offsets into the original text).

    The benchmark, the stated query set, is taken in blocks of `block_bytes` characters; each is one broadcast of
    bounded size and one automaton, and scans whole documents once. No row is shuffled; between blocks the rows and
    spans so far are written to the shared folder, so that one automaton is in memory at a time.

    A null or empty text has no words; a null item or item text is no item; repeated items are reported under each
    name, repeated documents row by row; an empty benchmark finds nothing; other columns are ignored.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    for k, automaton in enumerate(_automata(benchmark, item_id, item_text, window, block_bytes)):

        def scan(batch: pa.RecordBatch, automaton: Broadcast = automaton, k: int = k) -> dict[str, list]:
            scanner, texts = automaton.value, batch.column("text").to_pylist()
            if k:
                before = zip(*(batch.column(name).to_pylist() for name in ("items", "firsts", "lasts")))
                found = [scanner.scan(*row) for row in zip(texts, before)]
            else:
                found = [scanner.scan(text) for text in texts]
            columns = {name: [row[at] for row in found] for at, name in enumerate(FOUND)}
            return columns | {"doc_id": batch.column("doc_id"), "text": batch.column("text")}

        rows = written(rows, "scanned") if k else rows
        rows = map_rows(rows, scan, f"doc_id {kind}, text string, {HITS}")
    return rows.drop("text")


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = 8_000_000,
) -> DataFrame:
    """The rows of `docs`, with all their columns, in which no benchmark window occurs; see `find_passages`."""
    for automaton in _automata(benchmark, item_id, item_text, window, block_bytes):

        def keep(batches: Iterator[pa.RecordBatch], automaton: Broadcast = automaton) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [automaton.value.scan(value)[1] == 0 for value in batch.column(text).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
