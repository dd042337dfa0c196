"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy arrays.

Suffixes are classified as smaller (S) or larger (L) than the next one. The leftmost S of
each run are sorted by their substrings, which one round of inducing does; named, they make
a shorter string, whose suffixes give the order that a second round induces all others
from. Inducing goes through the symbols' buckets, and each bucket is handled as a whole. A
shorter string with too many symbols for that has its suffixes ranked by doubling instead.
"""

from __future__ import annotations

import numpy as np

#: Most symbols that buckets are gone through for, one by one.
BUCKETS = 512


def _is_smaller(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last, the sentinel, is."""
    n = len(s)
    step = np.sign(s[1:].astype(np.int64) - s[:-1])
    where = np.where(step != 0, np.arange(n - 1), n - 1)
    decides = np.minimum.accumulate(where[::-1])[::-1]  # the next place where neighbours differ
    out = np.ones(n, bool)
    out[:-1] = np.append(step, 1)[decides] > 0
    return out


def _induce(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All suffixes in the order that the given order of the leftmost S suffixes induces."""
    n, symbols = len(s), len(counts)
    ends = np.cumsum(counts)
    starts = ends - counts
    order = np.full(n, -1, np.int64)

    lms_symbols = s[lms]
    lms_counts = np.bincount(lms_symbols, minlength=symbols)
    lms_sorted = lms[np.argsort(lms_symbols, kind="stable")]
    lms_starts = np.concatenate([[0], np.cumsum(lms_counts)])

    def dealt(found: np.ndarray, backward: bool, edge: np.ndarray) -> None:
        """Put suffixes into their buckets, one behind the other, or before."""
        own = s[found]
        by = np.argsort(own, kind="stable")
        found, own = found[by], own[by]
        new = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        sizes = np.diff(np.append(new, len(own)))
        within = np.arange(len(own)) - np.repeat(new, sizes)
        if backward:
            order[edge[own] - 1 - within] = found
            edge[own[new]] -= sizes
        else:
            order[edge[own] + within] = found
            edge[own[new]] += sizes

    heads = starts.copy()
    for c in range(symbols):
        done = starts[c]
        while done < heads[c]:  # larger suffixes of this bucket, also those it adds itself
            some = order[done : heads[c]]
            done = heads[c]
            before = some[some > 0] - 1
            before = before[~smaller[before]]
            if len(before):
                dealt(before, False, heads)
        some = lms_sorted[lms_starts[c] : lms_starts[c + 1]]
        before = some[some > 0] - 1
        if len(before):
            dealt(before, False, heads)
    tails = ends.copy()
    for c in range(symbols - 1, -1, -1):
        done = ends[c]
        while done > tails[c]:
            some = order[tails[c] : done][::-1]
            done = tails[c]
            before = some[some > 0] - 1
            before = before[smaller[before]]
            if len(before):
                dealt(before, True, tails)
        some = order[starts[c] : heads[c]][::-1]  # the larger ones, behind which the smaller stand
        before = some[some > 0] - 1
        before = before[smaller[before]]
        if len(before):
            dealt(before, True, tails)
    order[0] = n - 1
    return order


def _names(s: np.ndarray, sorted_lms: np.ndarray, next_lms: np.ndarray) -> np.ndarray:
    """Rank of each leftmost S substring in sorted order; equal ones share theirs."""
    a, b = sorted_lms[:-1], sorted_lms[1:]
    size = next_lms[sorted_lms] - sorted_lms
    same = size[:-1] == size[1:]
    at = 0
    open_pairs = np.flatnonzero(same)
    while len(open_pairs):
        x, y = a[open_pairs], b[open_pairs]
        equal = s[x + at] == s[y + at]
        same[open_pairs[~equal]] = False
        at += 1
        open_pairs = open_pairs[equal & (size[open_pairs] >= at)]
    return np.concatenate([[0], np.cumsum(~same)])


def _by_doubling(s: np.ndarray) -> np.ndarray:
    """Suffix array of a string whose last symbol is the smallest and occurs once."""
    n = len(s)
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        following = np.zeros(n, np.int64)
        following[: n - width] = rank[width:] + 1
        keys = rank * (n + 1) + following
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        new_rank = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank[order] = new_rank
        if new_rank[-1] == n - 1:
            return order
        width *= 2


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of whole numbers from 0 on, of which 0 occurs only as the last one."""
    if len(s) == 1:
        return np.zeros(1, np.int64)
    counts = np.bincount(s)
    if len(counts) > BUCKETS:
        return _by_doubling(s)
    smaller = _is_smaller(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    order = _induce(s, smaller, lms, counts)
    is_lms = np.zeros(len(s), bool)
    is_lms[lms] = True
    sorted_lms = order[is_lms[order]]
    next_lms = np.zeros(len(s), np.int64)
    next_lms[lms[:-1]] = lms[1:]
    next_lms[lms[-1]] = lms[-1]
    names = _names(s, sorted_lms, next_lms)
    if names[-1] + 1 == len(lms):  # all differ
        return _induce(s, smaller, sorted_lms, counts)
    shorter = np.empty(len(s), np.int64)
    shorter[sorted_lms] = names
    return _induce(s, smaller, lms[suffix_array(shorter[lms])], counts)


def long_matches(data: np.ndarray, array: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of ``starts`` (rising) share ``length`` bytes with another suffix.

    ``data``: bytes; ``array``: its suffix array. The common prefix with the suffix before
    it in the array is found in text order, eight bytes at a time, and only as far as
    ``length``. Every start must have ``length`` bytes after it.
    """
    before = np.full(len(array), -1, np.int64)
    before[array[1:]] = array[:-1]
    found = np.zeros(len(array) + 1, bool)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(data) + 1,), "<u8", padded.tobytes(), 0, (1,))
    here = starts[before[starts] >= 0]
    other = before[here]
    fits = other + length <= len(data)
    here, other = here[fits], other[fits]
    for at in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        equal = words[here + at] == words[other + at]
        here, other = here[equal], other[equal]
    found[here] = True
    found[other] = True
    return found[starts]
