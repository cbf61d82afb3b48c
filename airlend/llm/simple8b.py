"""Simple-8b: whole numbers in 64-bit words, each word with as many as fit.

A word's top 4 bits select how many numbers of how many bits its other 60 bits hold. Numbers of more than 60
bits take an escape word and then a word of their own. Every BLOCK numbers a new word begins, and the place of
that word is kept, so that any block can be decoded alone.

    bytes 0-3 "S8B1", 4-7 number of blocks, 8-15 how many numbers, then the first word of each block
    (unsigned 32 bit, padded to 8 bytes), then the words; all little-endian
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK = 4096
MAGIC = b"S8B1"
ESCAPE = 0
#: Fixed values of the code: numbers in a word and bits of each, by selector from 1.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])


def _selectors(values: np.ndarray) -> np.ndarray:
    """For each place the selector that packs most numbers from there without leaving the block."""
    n = len(values)
    width = np.full(n + 64, 255, np.uint8)
    width[:n] = np.frexp(values.astype(np.float64))[1]
    left = np.full(n, 255, np.uint8)
    for end in {*range(BLOCK, n, BLOCK), n}:
        first = max(end - 255, (end - 1) // BLOCK * BLOCK)
        left[first:end] = np.arange(end - first, 0, -1)
    widest = {1: width}
    for half in (1, 2, 4, 8, 16):
        wide = widest[half].copy()
        np.maximum(wide[:-half], widest[half][half:], out=wide[:-half])
        widest[2 * half] = wide
    chosen = np.where(width[:n] <= 60, np.uint8(14), np.uint8(ESCAPE))
    for selector in range(13, 0, -1):
        count, bits = int(COUNTS[selector]), BITS[selector]
        power = 1 << (count.bit_length() - 1)
        most = np.maximum(widest[power][:n], widest[power][count - power : count - power + n])
        chosen[(most <= bits) & (left >= count)] = selector
    return chosen


def encode(values: np.ndarray) -> bytes:
    """Whole numbers from 0 to 2**64 - 1."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    if not n:
        return struct.pack("<4sIQ", MAGIC, 0, 0)
    chosen = _selectors(values)
    step = COUNTS[chosen]
    # All blocks advance together, a word at a time.
    at = np.arange(0, n, BLOCK)
    end = np.minimum(at + BLOCK, n)
    taken = []
    while len(at):
        taken.append(at)
        at = at + step[at]
        going = at < end
        at, end = at[going], end[going]
    starts = np.sort(np.concatenate(taken))
    selectors = chosen[starts]
    place = np.cumsum(1 + (selectors == ESCAPE)) - 1 - (selectors == ESCAPE)
    words = np.zeros(len(starts) + int((selectors == ESCAPE).sum()), np.uint64)
    for selector in np.unique(selectors):
        which = selectors == selector
        base, to = starts[which], place[which]
        if selector == ESCAPE:
            words[to + 1] = values[base]
            continue
        packed = np.full(len(base), np.uint64(selector) << np.uint64(60))
        for k in range(COUNTS[selector]):
            packed |= values[base + k] << np.uint64(k * BITS[selector])
        words[to] = packed
    firsts = place[np.searchsorted(starts, np.arange(0, n, BLOCK))].astype("<u4")
    head = struct.pack("<4sIQ", MAGIC, len(firsts), n) + firsts.tobytes()
    return head + bytes(-len(head) % 8) + words.astype("<u8").tobytes()


def _unpack(words: np.ndarray) -> np.ndarray:
    selectors = (words >> np.uint64(60)).astype(np.intp)
    raw = np.zeros(len(words), bool)
    for place in np.flatnonzero(selectors == ESCAPE):
        if not raw[place]:
            raw[place + 1] = True
    first = np.flatnonzero(~raw)
    selectors = selectors[first]
    counts = COUNTS[selectors]
    to = np.cumsum(counts) - counts
    values = np.empty(int(counts.sum()), np.uint64)
    for selector in np.unique(selectors):
        which = selectors == selector
        if selector == ESCAPE:
            values[to[which]] = words[first[which] + 1]
            continue
        mask = np.uint64((1 << int(BITS[selector])) - 1)
        for k in range(COUNTS[selector]):
            values[to[which] + k] = (words[first[which]] >> np.uint64(k * BITS[selector])) & mask
    return values


def _parts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    magic, blocks, _ = struct.unpack_from("<4sIQ", data)
    if magic != MAGIC:
        raise ValueError("not Simple-8b data")
    firsts = np.frombuffer(data, "<u4", blocks, 16)
    at = 16 + 4 * blocks
    return firsts, np.frombuffer(data, "<u8", offset=at + -at % 8)


def decode(data: bytes) -> np.ndarray:
    _, words = _parts(data)
    return _unpack(words)


def decode_block(data: bytes, block: int) -> np.ndarray:
    """Numbers BLOCK * block and following, up to BLOCK of them."""
    firsts, words = _parts(data)
    return _unpack(words[firsts[block] : firsts[block + 1] if block + 1 < len(firsts) else None])
