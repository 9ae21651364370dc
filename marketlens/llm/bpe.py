"""Byte-level BPE: texts to token ids by a file of merge ranks, and back."""

import base64
import hashlib
from collections.abc import Callable, Iterable
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import map_rows
from marketlens.llm.unit_ids import PLAIN, Known, ids_of, packed_parts

#: Parts the pre-tokens that are merged together: a byte that no text in UTF-8 has.
BARRIER = "\xff"


class RankQueue:
    """Positions queued by rank; the lowest rank comes first.

    Each rank has a bucket. A bitmap in words of 64 ranks says which buckets hold something; a bitmap over these words,
    one long number, says which of them are not zero. The lowest set bit of the one leads to the word, the lowest set
    bit of the word to the rank.
    """

    __slots__ = ("buckets", "words", "summary")

    def __init__(self) -> None:
        self.buckets: dict[int, list[int]] = {}
        self.words: dict[int, int] = {}
        self.summary = 0

    def mark(self, rank: int, positions: list[int]) -> None:
        """A rank that has no bucket yet gets one."""
        self.buckets[rank] = positions
        at = rank >> 6
        word = self.words.get(at, 0)
        if not word:
            self.summary |= 1 << at
        self.words[at] = word | 1 << (rank & 63)

    def pop(self) -> tuple[int, list[int]]:
        """The lowest rank and its whole bucket in order of position; only while `summary` is not zero."""
        summary = self.summary
        at = (summary & -summary).bit_length() - 1
        word = self.words[at]
        lowest = word & -word
        self.words[at] = word = word ^ lowest
        if not word:
            self.summary = summary & (summary - 1)
        rank = at << 6 | lowest.bit_length() - 1
        bucket = self.buckets.pop(rank)
        bucket.sort()
        return rank, bucket


def _merged(raw: str, rank_of: Callable[[str], int | None], first: np.ndarray, single: np.ndarray) -> np.ndarray:
    """Ids of the tokens of pre-tokens with barriers between them, each where its token begins; -1 elsewhere.

    In each pre-token the pair of neighbours with the lowest rank is merged again and again, the leftmost first.
    `first` has the rank of each pair of bytes, `single` that of each byte, -1 for none.
    """
    n, queue = len(raw), RankQueue()
    buckets, mark = queue.buckets, queue.mark
    after, before = list(range(1, n + 2)), list(range(-1, n))
    codes = np.frombuffer(raw.encode("latin-1"), np.uint8).astype(np.int64)
    ranks = np.append(first[codes[:-1] * 256 + codes[1:]], [-1, -1])
    pair = ranks.tolist()  # rank of the token at a position with the next one
    token = single[codes].tolist()
    order = np.argsort(ranks, kind="stable")
    starts = np.flatnonzero(np.diff(ranks[order], prepend=-1))
    for start, end in pairwise([*starts.tolist(), n + 1]):
        mark(pair[order[start]], order[start:end].tolist())
    while queue.summary:
        now, bucket = queue.pop()
        wait, later = -1, []
        for at in bucket:
            if pair[at] != now:
                continue  # one of its tokens has been merged meanwhile
            if at < wait:
                later.append(at)  # its pre-token has got a pair of lower rank
                continue
            gone = after[at]
            after[at] = end = after[gone]
            before[end] = at
            left = before[at]
            token[at] = now
            token[gone] = pair[gone] = pair[at] = -1
            rank = rank_of(raw[at : after[end]]) if end < n else None
            if rank is not None:
                pair[at] = rank
                if rank in buckets:
                    buckets[rank].append(at)
                else:
                    mark(rank, [at])
                if rank < now:
                    wait = raw.find(BARRIER, at) % (n + 1)
            if left >= 0:
                rank = rank_of(raw[left:end])
                pair[left] = -1 if rank is None else rank
                if rank is not None:
                    if rank in buckets:
                        buckets[rank].append(left)
                    else:
                        mark(rank, [left])
                    if rank < now:
                        wait = raw.find(BARRIER, at) % (n + 1)
        if later:
            mark(now, later)
    return np.array(token, np.int64)


class Codec:
    """Encodes and decodes by merge ranks (token bytes to id) and the pattern that cuts texts into pre-tokens.

    `stand_ins` replaces, for cutting only, characters that this pattern engine has in other classes than the one
    whose cuts are wanted.
    """

    #: Characters of pre-tokens that are merged in one queue, and pieces of a generation that are remembered.
    TOGETHER, KEPT = 200_000, 120_000

    def __init__(self, ranks: dict[bytes, int], pattern: str, stand_ins: dict[int, str] | None = None):
        self.ranks, self.pattern, self.stand_ins = ranks, pattern, stand_ins or {}
        self._ready = False

    def __getstate__(self) -> dict:
        own = {"ranks": self.ranks, "pattern": self.pattern, "stand_ins": self.stand_ins}
        return own | {"_ready": False}

    def _prepare(self) -> None:
        self._by_text = {
            token.decode("latin-1"): rank for token, rank in self.ranks.items() if len(token) == 1 or b"\xff" not in token
        }
        self._tokens = [b""] * (max(self.ranks.values(), default=0) + 1)
        for token, rank in self.ranks.items():
            self._tokens[rank] = token
        self._decimal = [str(number) for number in range(len(self._tokens))]
        self._find = regex.compile(self.pattern).findall
        self._odd = {chr(point) for point in self.stand_ins}
        self._first = np.full(1 << 16, -1, np.int64)
        for token, rank in self.ranks.items():
            if len(token) == 2 and b"\xff" not in token:
                self._first[token[0] * 256 + token[1]] = rank
        self._single = np.full(256, -1, np.int64)
        for value in range(255):
            self._single[value] = self.ranks[bytes([value])]
        self._known = Known(self.KEPT)
        self._ready = True

    def _split(self, unit: str) -> list[str]:
        if unit.isascii() or self._odd.isdisjoint(unit):
            return self._find(unit)
        cuts = [0, *accumulate(map(len, self._find(unit.translate(self.stand_ins))))]
        return [unit[start:end] for start, end in pairwise(cuts)]

    def _merge(self, pieces: Iterable[bytes]) -> dict[bytes, bytes]:
        """The ids of pre-tokens, packed; many of them are merged in one queue."""
        whole_rank, done, left = self.ranks.get, {}, []
        for piece in pieces:
            whole = whole_rank(piece)
            if whole is None:
                left.append(piece)
            else:
                done[piece] = whole.to_bytes(4, "little")
        start = 0
        while start < len(left):
            stop, size = start, 0
            while stop < len(left) and size < self.TOGETHER:
                size += len(left[stop]) + 1
                stop += 1
            part = left[start:stop]
            together = BARRIER.join([piece.decode("latin-1") for piece in part])
            token = _merged(together, self._by_text.get, self._first, self._single)
            at = np.flatnonzero(token >= 0)
            ends = np.cumsum([len(piece) + 1 for piece in part])
            done.update(zip(part, packed_parts(token[at], np.append(0, np.searchsorted(at, ends)))))
            start = stop
        return done

    def _look_up(self, wanted: list[bytes]) -> list[bytes]:
        found = self._known.find(wanted)
        missing = [unit for unit, ids in zip(wanted, found) if ids is None]
        cut = {
            unit: [piece.encode("utf-8", "surrogatepass") for piece in self._split(unit.decode("utf-8", "surrogatepass"))]
            for unit in missing
            if not PLAIN(unit)
        }
        pieces = list(set(chain.from_iterable(cut.values())))
        new = {piece: ids for piece, ids in zip(pieces, self._known.find(pieces)) if ids is not None}
        fresh = self._merge({*(unit for unit in missing if unit not in cut), *pieces}.difference(new))
        new |= fresh
        for unit, own in cut.items():
            fresh[unit] = new[unit] = b"".join(map(new.__getitem__, own))
        self._known.keep(fresh)
        return [new[unit] if ids is None else ids for unit, ids in zip(wanted, found)]

    def encode_all(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """Ids of each whole text, unsigned 32-bit; none for a null or empty one. Special tokens are ordinary text."""
        if not self._ready:
            self._prepare()
        return ids_of(texts, self._look_up)

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: Iterable[int]) -> bytes:
        if not self._ready:
            self._prepare()
        return b"".join(map(self._tokens.__getitem__, ids))

    def listed(self, ids: Iterable[int]) -> str:
        """Decimal ids with commas between them."""
        if not self._ready:
            self._prepare()
        return ",".join(map(self._decimal.__getitem__, ids))


def _members(kind: str, matcher: Callable[[str], str]) -> set[str]:
    """The characters that `matcher` finds in the class `kind`."""
    every = "".join(chr(point) for point in range(0x110000) if not 0xD800 <= point < 0xE000)
    return set(matcher(every))


def _stand_ins() -> dict[int, str]:
    """For each character that the two pattern engines class differently, one that both class as tiktoken does."""
    bytes_only = {bytes([value]): value for value in range(256)}
    odd: dict[int, str] = {}
    members = {}
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        other = tiktoken.Encoding("probe", pat_str=kind, mergeable_ranks=bytes_only, special_tokens={})
        members[kind] = _members(kind, lambda text: bytes(other.encode_ordinary(text)).decode())
        for char in members[kind] ^ _members(kind, lambda text: "".join(regex.findall(kind, text))):
            odd[ord(char)] = "¡"
    for kind, stand_in in ((r"\p{L}", "é"), (r"\p{N}", "²"), (r"\s", "\u2003")):
        odd |= {point: stand_in for point in odd if chr(point) in members[kind]}
    return odd


def codec(path: str, pattern: str) -> Codec:
    """From a rank file: one token in base64 and its rank a line. Read by the driver, sent along with the tasks."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return Codec(ranks, pattern, _stand_ins())


def encoded(docs: DataFrame, own: Codec, doc_id: str = "doc_id", text: str = "text", ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256) of every row; the ids themselves only on request.

    ids_sha256 is of the decimal ids with commas between them, decoded_sha256 of the bytes the ids decode to. A null
    text counts as empty: no ids, digests of nothing. Rows come back one by one, repeated ones too; other columns are
    ignored. The vocabulary, of fixed size, is broadcast.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(own)

    def make(batch: pa.RecordBatch) -> dict[str, list]:
        coder = shared.value
        texts = batch.column("text").to_pylist()
        found = coder.encode_all(texts)
        columns = {
            "doc_id": batch.column("doc_id"),
            "n_tokens": [len(own) for own in found],
            "ids_sha256": [hashlib.sha256(coder.listed(own.tolist()).encode()).hexdigest() for own in found],
            "decoded_sha256": [hashlib.sha256(coder.decode(own.tolist())).hexdigest() for own in found],
        }
        return columns | ({"ids": [own.astype(np.int32) for own in found]} if ids else {})

    kind = docs.schema[doc_id].dataType.simpleString()
    listed = "ids array<int>, " if ids else ""
    return map_rows(rows, make, f"doc_id {kind}, n_tokens long, {listed}ids_sha256 string, decoded_sha256 string", 1024)
