"""Run-length index of a set of byte strings and the long matches inside the set.

The strings are laid one after another, each closed by a separator that equals
nothing else. Their suffixes are sorted, the Burrows-Wheeler transform is cut
into runs, and only run heads are sampled: the text position there and its
common prefix with the suffix before it. Reading the text from left to right,
the match with the suffix before shrinks by one per character until the next
sampled head (inside a run, the preceding characters agree, so the value one
position earlier is one larger), which streams the matching statistics of the
whole set from as many samples as there are runs. A set must stay below 2 GB.
"""

from __future__ import annotations

import numpy as np

SEPARATOR = 0xFF  # no byte of UTF-8


def suffix_ranks(text: np.ndarray, end: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """Rank of every suffix; ``end`` is the separator's place after each position."""
    n = len(text)
    at = np.arange(n, dtype=np.int32)
    order = np.argsort(packed, kind="stable").astype(np.int32)
    key = packed[order]
    new = np.r_[True, (key[1:] != key[:-1]) | ((end - at)[order[1:]] < 8)]
    del key
    first = np.maximum.accumulate(np.where(new, at, 0))
    rank = np.empty(n, dtype=np.int32)
    rank[order] = first
    live = order[np.bincount(first, minlength=n)[first] > 1]
    del first, new, order
    h = 8
    while len(live):
        own, nxt = rank[live], rank[live + h]
        by = np.argsort(own * np.int64(n) + nxt, kind="stable")
        live, own, nxt = live[by], own[by], nxt[by]
        at = np.arange(len(live), dtype=np.int32)
        new_class = np.r_[True, own[1:] != own[:-1]]
        new = new_class | np.r_[True, nxt[1:] != nxt[:-1]]
        begin = np.maximum.accumulate(np.where(new, at, 0))
        rank[live] = own + begin - np.maximum.accumulate(np.where(new_class, at, 0))
        live = live[np.bincount(begin, minlength=len(live))[begin] > 1]
        h *= 2
    return rank


def matching_statistics(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For every position of the joined strings: the longest match elsewhere in the set; and string starts."""
    sep = bytes([SEPARATOR])
    text = np.frombuffer(sep.join(strings) + sep, dtype=np.uint8)
    n = len(text)
    seps = np.flatnonzero(text == SEPARATOR)
    starts = np.r_[0, seps[:-1] + 1]
    end = np.repeat(seps.astype(np.int32), np.diff(np.r_[-1, seps]))
    padded = np.r_[text, np.zeros(8, dtype=np.uint8)]
    packed, at = np.zeros(n, dtype=np.uint64), np.arange(n, dtype=np.int32)
    for j in range(8):
        packed |= np.where(at + j <= end, padded[j:j + n], 0).astype(np.uint64) << np.uint64(56 - 8 * j)
    rank = suffix_ranks(text, end, packed)
    suffix = np.empty(n, dtype=np.int32)
    suffix[rank] = at
    bwt = text[suffix - 1]
    head = np.r_[True, (bwt[1:] != bwt[:-1]) | (bwt[1:] == SEPARATOR)]
    rows = np.flatnonzero(head)
    sampled = suffix[rows]  # the samples at run heads: the position, and its common prefix with the row before
    value = np.zeros(len(rows), dtype=np.int32)
    value[1:] = common_prefix(packed, end, suffix[rows[1:] - 1], sampled[1:])
    sample_at, sample_value = np.full(n, -1, dtype=np.int32), np.zeros(n, dtype=np.int32)
    sample_at[sampled], sample_value[sampled] = sampled, value
    last = np.maximum.accumulate(sample_at)
    before = sample_value[last] - (at - last)  # with the suffix one row up
    by_row = before[suffix]
    best = np.maximum(by_row, np.r_[by_row[1:], 0])  # or one row down
    return best[rank], starts


def common_prefix(packed: np.ndarray, end: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal leading bytes before either separator, eight at a time."""
    room = np.minimum(end[a] - a, end[b] - b)
    found = room.copy()
    live = np.arange(len(a))
    done = 0
    while len(live):
        live = live[room[live] > done]
        x = packed[a[live] + done] ^ packed[b[live] + done]
        differ = x != 0
        if differ.any():
            # index of the first differing byte
            bits = np.frexp(x[differ].astype(np.float64))[1] - 1
            top = np.minimum(bits, 63)
            low = (x[differ] >> top.astype(np.uint64)) == 0  # rounding of large values went one bit up
            equal = (63 - (top - low)) // 8
            where = live[differ]
            found[where] = np.minimum(done + equal, room[where])
        live = live[~differ]
        done += 8
    return found


def long_matches(strings: list[bytes], length: int) -> list[tuple[int, int, int]]:
    """(string, start, stop): runs covered by substrings of ``length`` that start in two places of the set."""
    if not strings:
        return []
    best, starts = matching_statistics(strings)
    hits = np.flatnonzero(best >= length)
    if not len(hits):
        return []
    gap = np.flatnonzero((np.diff(hits) > length) | (np.diff(np.searchsorted(starts, hits, side="right")) > 0)) + 1
    first, last = hits[np.r_[0, gap]], hits[np.r_[gap - 1, len(hits) - 1]]
    which = np.searchsorted(starts, first, side="right") - 1
    return list(zip(which.tolist(), (first - starts[which]).tolist(), (last - starts[which] + length).tolist()))
