"""Token ids of many texts at once, from the ids of the different pieces they consist of."""

import re
from collections.abc import Callable, Iterable
from itertools import pairwise

import numpy as np

from marketlens.llm.hashing import span_hashes

#: Bytes of text that are cut and looked up together.
TOGETHER = 4_000_000
#: White space that is not ASCII, or that not all pattern engines take for such. Texts with it are not cut.
_RARE_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LETTER = np.isin(np.arange(256) | 32, np.arange(97, 123)) & (np.arange(256) < 128)
_MARK = np.isin(np.arange(256), list(b".,;:!?"))
#: A word that byte-level patterns leave whole: letters, all but the first in lower case, after a space or none.
PLAIN = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])(?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf])*").fullmatch


class Known:
    """Ids of pieces met lately, packed. There are two generations: once the younger is full, the older is forgotten.

    So pieces that come again and again stay, and those that came once go.
    """

    #: The longest piece that is kept: longer ones seldom come again.
    LONGEST = 128

    def __init__(self, size: int) -> None:
        self.size = size
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def find(self, wanted: list[bytes]) -> list[bytes | None]:
        found = list(map(self.young.get, wanted))
        if self.old:
            young, old = self.young, self.old.get
            for k, piece in enumerate(wanted):
                if found[k] is None:
                    ids = old(piece)
                    if ids is not None:
                        young[piece] = found[k] = ids
        return found

    def keep(self, new: dict[bytes, bytes]) -> None:
        self.young.update(item for item in new.items() if len(item[0]) <= self.LONGEST)
        if len(self.young) > self.size:
            self.old, self.young = self.young, {}


def packed_parts(ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """The ids between each two bounds, as little-endian bytes."""
    packed, at = ids.astype("<u4").tobytes(), (4 * bounds).tolist()
    return [packed[start:end] for start, end in pairwise(at)]


def _cuts(text: np.ndarray, starts: np.ndarray, uncut: list[tuple[int, int]]) -> np.ndarray:
    """Where pieces begin within texts: at lone spaces, and at marks after a letter. No byte-level pre-token spans these."""
    cut = np.zeros(len(text), bool)
    if len(text) > 2:
        space = _SPACE[text]
        cut[1:-1] = (text[1:-1] == 32) & ~space[:-2] & ~space[2:]
        cut[1:] |= _MARK[text[1:]] & _LETTER[text[:-1]]
    for start, end in uncut:
        cut[start:end] = False
    cut[starts[starts < len(text)]] = False
    return np.flatnonzero(cut)


def _ids_of(raw: list[bytes], uncut: list[bool], look_up: Callable[[list[bytes]], list[bytes]]) -> list[np.ndarray]:
    sizes = np.array([len(one) for one in raw], np.int64)
    starts = np.cumsum(sizes) - sizes
    together = b"".join(raw)
    text = np.frombuffer(together, np.uint8)
    whole = [(int(start), int(start + size)) for start, size, out in zip(starts, sizes, uncut) if out]
    begins = np.sort(np.concatenate((_cuts(text, starts, whole), starts[sizes > 0])))
    if not len(begins):
        return [np.empty(0, np.uint32)] * len(raw)
    ends = np.append(begins[1:], len(text))
    hashes = span_hashes(text, begins, ends)
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    check = span_hashes(text, begins, ends, 0xD6E8FEB86659FD93)
    if (check[first][which] != check).any():  # two pieces with the same hash: every piece is looked up by itself
        first = which = np.arange(len(begins))
    pieces = [together[begin:end] for begin, end in zip(begins[first].tolist(), ends[first].tolist())]
    packed = look_up(pieces)
    lengths = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
    offsets = np.cumsum(lengths) - lengths
    own = lengths[which]
    before = np.cumsum(own) - own
    ids = np.frombuffer(b"".join(packed), np.uint32)
    flat = ids[np.repeat(offsets[which] - before, own) + np.arange(int(own.sum()))]
    bounds = np.append(before, len(flat))[np.searchsorted(begins, np.append(starts, len(text)))]
    return [flat[start:end] for start, end in zip(bounds[:-1], bounds[1:])]


def ids_of(texts: Iterable[str | None], look_up: Callable[[list[bytes]], list[bytes]]) -> list[np.ndarray]:
    """Ids of each text, unsigned 32-bit. `look_up` gives the ids of pieces, packed; a null text has none."""
    found: list[np.ndarray] = []
    raw: list[bytes] = []
    uncut: list[bool] = []
    held = 0
    for text in texts:
        raw.append((text or "").encode("utf-8", "surrogatepass"))
        uncut.append(bool(text) and _RARE_SPACE.search(text) is not None)
        held += len(raw[-1])
        if held >= TOGETHER:
            found += _ids_of(raw, uncut, look_up)
            raw, uncut, held = [], [], 0
    return found + _ids_of(raw, uncut, look_up) if raw else found
