"""Hashes of many words at once."""

import functools

import numpy as np

#: Bytes of text that have running sums at once. A worker keeps powers for as many, however long its texts are.
AT_ONCE = 1 << 18


def word_hashes(lines: list[bytes]) -> np.ndarray:
    """64-bit hashes of the words of all lines; one space parts words.

    A hash is a polynomial of the word's bytes, taken from running sums over all lines, then mixed.
    """
    text = np.frombuffer(b" ".join(lines), np.uint8)
    spaces = np.flatnonzero(text == 32)
    return span_hashes(text, np.append(0, spaces + 1), np.append(spaces, len(text)))


def span_hashes(text: np.ndarray, begins: np.ndarray, ends: np.ndarray, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """64-bit hashes of spans of the bytes of `text`, which follow one another."""
    sums, hashes, start = np.zeros(AT_ONCE + 1, np.uint64), np.empty(len(begins), np.uint64), 0
    power, inverse = _powers(base)
    while start < len(begins):
        low = int(begins[start])
        stop = int(np.searchsorted(ends, low + AT_ONCE, "right"))
        if stop <= start:
            hashes[start] = _long_hash(text[low : int(ends[start])], base)
            start += 1
            continue
        part = text[low : int(ends[stop - 1])]
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[: len(part)], out=sums[1 : len(part) + 1])
        begin, end = begins[start:stop] - low, ends[start:stop] - low
        hashes[start:stop] = (sums[end] - sums[begin]) * inverse[begin]
        start = stop
    return mixed(hashes)


def _long_hash(span: np.ndarray, base: int) -> int:
    """The polynomial of a span longer than `AT_ONCE`, before it is mixed."""
    power, _ = _powers(base)
    total = 0
    for start in range(0, len(span), AT_ONCE):
        part = span[start : start + AT_ONCE]
        own = int(((part.astype(np.uint64) + np.uint64(1)) * power[: len(part)]).sum(dtype=np.uint64))
        total = (total + own * pow(base, start, 1 << 64)) % (1 << 64)
    return total


@functools.lru_cache(maxsize=4)
def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    steps = (np.full(AT_ONCE + 1, number, np.uint64) for number in (base, pow(base, -1, 1 << 64)))
    ones = []
    for step in steps:
        step[0] = 1
        ones.append(np.cumprod(step))
    return ones[0], ones[1]


def mixed(values: np.ndarray) -> np.ndarray:
    """Each 64-bit value spread over all its bits."""
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xA0761D6478BD642F)):
        values = (values ^ (values >> np.uint64(shift))) * np.uint64(factor)
    return values ^ (values >> np.uint64(32))
