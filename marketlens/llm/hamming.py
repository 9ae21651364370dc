"""Fingerprints that differ in few bits: pigeonhole buckets, and a bit-sliced comparison within them."""

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pairs of a fingerprint and a block of 64 that are compared at once.
STRIP = 1 << 17
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def block_masks(blocks: int, equal: int) -> list[int]:
    """Bits of each choice of `equal` of `blocks` runs of bits.

    Fingerprints that differ in at most `blocks - equal` bits agree in all bits of at least one choice.
    """
    bounds = [round(k * 64 / blocks) for k in range(blocks + 1)]
    return [sum((1 << bounds[k + 1]) - (1 << bounds[k]) for k in chosen) for chosen in combinations(range(blocks), equal)]


def _bits(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def block_keys(fingerprint: Column, blocks: int, equal: int) -> Column:
    """Array of bucket keys, one for each of `block_masks`; the last four bits are the number of the choice."""
    masks = enumerate(block_masks(blocks, equal))
    hashes = [(number, F.xxhash64(F.lit(number), fingerprint.bitwiseAND(_bits(mask)))) for number, mask in masks]
    return F.array(*(value.bitwiseAND(F.lit(-16)).bitwiseOR(F.lit(number)) for number, value in hashes))


def first_shared(a: Column, b: Column, blocks: int, equal: int) -> Column:
    """Number of the first choice of runs in which both fingerprints agree."""
    differ = a.bitwiseXOR(b)
    cases = F
    for number, mask in enumerate(block_masks(blocks, equal)):
        cases = cases.when(differ.bitwiseAND(_bits(mask)) == 0, number)
    return cases


def in_chunks(rows: DataFrame, key: str, member: str, size: int) -> DataFrame:
    """Rows of each bucket with at least two, dealt into pairs of chunks: columns `key`, first, second are added.

    A bucket of up to `size` rows is one chunk. A larger one is cut into chunks of about `size` rows by the hash of
    `member`, and every pair of chunks is a group of its own, so no task gets more than some chunks at a time.
    """
    return dealt_in_chunks(rows.join(rows.groupBy(key).count().filter("count > 1"), key), member, size)


def dealt_in_chunks(rows: DataFrame, member: str, size: int) -> DataFrame:
    """The same for rows that have the number of rows of their bucket in `count`, which goes."""
    chunks = F.ceil(F.col("count") / size).cast("int")
    dealt = rows.withColumn("chunks", chunks).drop("count")
    own = F.pmod(F.xxhash64(F.lit("chunk"), member), F.col("chunks")).cast("int")
    other = F.when(F.col("chunks") == 1, F.array(F.lit(0))).otherwise(
        F.array_except(F.sequence(F.lit(0), F.col("chunks") - 1), F.array("own"))
    )
    return (
        dealt.withColumn("own", own)
        .withColumn("other", F.explode(other))
        .withColumn("first", F.least("own", "other"))
        .withColumn("second", F.greatest("own", "other"))
        .drop("own", "other", "chunks")
    )


class _Sliced:
    """Fingerprints of one group after another, 64 to a block, stored by bit: plane p of a block has bit p of each."""

    def __init__(self, fingerprints: np.ndarray, starts: np.ndarray):
        n = len(fingerprints)
        sizes = np.diff(np.append(starts, n))
        blocks = -(-sizes // 64)
        self.base = np.repeat(np.cumsum(blocks) - blocks, sizes)  # the first block of each row's group
        place = np.arange(n) - np.repeat(starts, sizes)
        self.block, self.lane = self.base + place // 64, place % 64
        lanes = np.zeros((int(blocks.sum()), 64), np.uint64)
        used = np.zeros(lanes.shape, bool)
        self.row = np.zeros(lanes.shape, np.int64)
        lanes[self.block, self.lane], used[self.block, self.lane] = fingerprints, True
        self.row[self.block, self.lane] = np.arange(n)
        bits = np.unpackbits(lanes.view(np.uint8).reshape(-1, 64, 8), axis=2, bitorder="little")
        packed = np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")
        self.planes = np.ascontiguousarray(packed).view(np.uint64)[:, :, 0]
        self.used = np.packbits(used, axis=1, bitorder="little").view(np.uint64)[:, 0]


def _within(sliced: _Sliced, queries: np.ndarray, rows: np.ndarray, blocks: np.ndarray, radius: int):
    """Of pairs (row, block): those with lanes within the radius, and these lanes as bits. Own and later rows are out."""
    width = max(1, radius.bit_length())
    wanted = sliced.used[blocks]
    own = sliced.block[rows] == blocks
    wanted[own] &= (np.uint64(1) << sliced.lane[rows[own]].astype(np.uint64)) - np.uint64(1)
    values = queries[rows]
    counter = [np.zeros(len(rows), np.uint64) for _ in range(width)]
    over = np.zeros(len(rows), np.uint64)
    for plane in range(64):
        carry = sliced.planes[plane, blocks] ^ (np.uint64(0) - ((values >> np.uint64(plane)) & np.uint64(1)))
        for digit in range(width):
            counter[digit], carry = counter[digit] ^ carry, counter[digit] & carry
        over |= carry
        if plane % 8 == 7:
            alive = wanted & ~(over | _greater(counter, radius))
            left = np.flatnonzero(alive)
            if len(left) < len(alive):
                rows, blocks, values, over, wanted = (x[left] for x in (rows, blocks, values, over, alive))
                counter = [digit[left] for digit in counter]
            else:
                wanted = alive
            if not len(rows):
                break
    return rows, blocks, wanted


def _greater(counter: list[np.ndarray], radius: int) -> np.ndarray:
    """Bits of the lanes whose counter is over the radius."""
    more, same = np.zeros_like(counter[0]), np.full_like(counter[0], ALL)
    for digit in range(len(counter) - 1, -1, -1):
        if radius >> digit & 1:
            same &= counter[digit]
        else:
            more |= same & counter[digit]
            same &= ~counter[digit]
    return more


def linked(fingerprints: np.ndarray, starts: np.ndarray, radius: int) -> np.ndarray:
    """For each row the first row of its group that it reaches over links of at most `radius` differing bits.

    `starts` says where the groups begin. Only the links' closure within a group is kept, not the links.
    """
    n = len(fingerprints)
    labels, sliced = np.arange(n), _Sliced(fingerprints, starts)
    first = starts[np.searchsorted(starts, np.arange(n), side="right") - 1]
    ends = np.append(starts, n)[np.searchsorted(starts, np.arange(n), side="right")]
    todo = sliced.block - sliced.base + 1
    begin = 0
    while begin < n:
        stop = max(begin + 1, int(np.searchsorted(np.cumsum(todo[begin:]), STRIP)) + begin)
        rows = np.repeat(np.arange(begin, stop), todo[begin:stop])
        nth = np.arange(len(rows)) - np.repeat(np.cumsum(todo[begin:stop]) - todo[begin:stop], todo[begin:stop])
        rows, blocks, lanes = _within(sliced, fingerprints, rows, sliced.base[rows] + nth, radius)
        pair, lane = np.nonzero(np.unpackbits(lanes[:, None].view(np.uint8), axis=1, bitorder="little"))
        one, other = rows[pair], sliced.row[blocks[pair], lane]
        cuts = np.flatnonzero(np.diff(one, prepend=-1))
        for here, there in zip(cuts, np.append(cuts[1:], len(one))):
            row = one[here]
            found = np.append(labels[other[here:there]], labels[row])
            least = found.min()
            if (found != least).any():
                group = labels[first[row] : ends[row]]
                group[np.isin(group, found)] = least
        begin = stop
    return labels
