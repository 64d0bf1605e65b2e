"""Two-stage suffix sorting of a block of text, and its repeated strings.

Only the wanted suffixes are sorted, each by its first ``depth`` bytes:

1. Suffixes smaller than their successor (one byte later) are sorted directly.
2. All others are induced: buckets of equal first bytes are scanned in order,
   and the suffix before each one scanned, if larger than it, takes the next
   place in its own bucket.
3. Neighbours in the order whose common prefix reaches ``depth`` are repeated.

Defined cases: an empty text has no suffixes; no wanted suffixes give an empty
order; any byte may occur, zero included; suffixes that are equal up to
``depth`` stand in any order among themselves, and are told as repeated.
"""

from __future__ import annotations

import numpy as np


def smaller_than_next(x: np.ndarray) -> np.ndarray:
    """For each position, whether its suffix is smaller than the next one; ``x`` ends in a value below all."""
    out = np.zeros(len(x), bool)
    out[-1] = True
    steps = np.flatnonzero(x[:-1] != x[1:])               # ends of runs of equal bytes
    if len(steps):
        upto = np.searchsorted(steps, np.arange(len(x) - 1))
        last = steps[np.minimum(upto, len(steps) - 1)]
        out[:-1] = np.where(upto < len(steps), x[last] < x[last + 1], False)
    return out


def sort_suffixes(text: bytes, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The ``wanted`` positions (a mask) and those they are induced from, in the order of their suffixes."""
    n = len(text)
    x = np.empty(n + 1, np.int16)
    x[:n] = np.frombuffer(text, np.uint8)
    x[:n] += 1
    x[n] = 0
    small = smaller_than_next(x)
    need = np.append(wanted, False)
    # a suffix larger than its successor is induced from it: the chain up to the next smaller one is needed
    ends = np.flatnonzero(small)
    starts = np.flatnonzero(need & ~small)
    stops = ends[np.searchsorted(ends, starts)]
    edge = np.zeros(n + 2, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, stops + 1, -1)
    need |= np.cumsum(edge[:-1]) > 0

    direct = sorted(np.flatnonzero(need & small).tolist(), key=lambda i: text[i:i + depth])
    direct = np.array(direct, np.int64)
    first = x[direct]                                     # rising: cut into buckets
    cuts = np.searchsorted(first, np.arange(258))
    waiting: list[list[np.ndarray]] = [[] for _ in range(257)]
    induced = need & ~small
    order = []
    for c in range(257):
        bucket = waiting[c]
        at = 0
        while at < len(bucket):                           # a run of this byte: induced within its own bucket
            before = bucket[at] - 1
            before = before[before >= 0]
            more = before[induced[before] & (x[before] == c)]
            if len(more):
                bucket.append(more)
            at += 1
        bucket.append(direct[cuts[c]:cuts[c + 1]])
        whole = np.concatenate(bucket)
        if not len(whole):
            continue
        order.append(whole)
        before = whole - 1
        before = before[before >= 0]
        before = before[induced[before] & (x[before] > c)]
        if len(before):
            to = np.argsort(x[before], kind="stable")
            before, bytes_ = before[to], x[before][to]
            for part in np.split(before, np.flatnonzero(np.diff(bytes_)) + 1):
                waiting[int(x[part[0]])].append(part)
    return np.concatenate(order) if order else np.empty(0, np.int64)


def repeated(text: bytes, wanted: np.ndarray, depth: int) -> np.ndarray:
    """A mask of the ``wanted`` positions whose next ``depth`` bytes start at another wanted position, too.

    ``depth`` is a multiple of 8, and that many bytes follow each wanted position.
    """
    order = sort_suffixes(text, wanted, depth)
    order = order[np.append(wanted, False)[order]]
    out = np.zeros(len(text), bool)
    if len(order) < 2:
        return out
    pad = np.frombuffer(text + bytes(8), np.uint8).astype(np.uint64)
    word = np.zeros(len(text), np.uint64)                 # the eight bytes from each position on
    for k in range(8):
        word |= pad[k:k + len(text)] << np.uint64(8 * k)
    pairs = np.arange(len(order) - 1)                     # neighbours with a common prefix so far
    for k in range(0, depth, 8):
        a, b = order[pairs], order[pairs + 1]
        pairs = pairs[word[a + k] == word[b + k]]
    out[order[pairs]] = True
    out[order[pairs + 1]] = True
    return out
