"""Content-defined anchors: equal windows of text choose the same anchor, wherever they stand.

A window of ``length`` units (bytes or words) holds ``length - k + 1`` runs of k units; the
one with the smallest hash, the leftmost of equal ones, is its anchor. Neighbouring windows
mostly share theirs, so there is an anchor for every ``length / 2`` units or so, and a window
can recur only where its anchor does.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash

from furlong.llm.common import once_per_worker

#: Low bits of a hash that give way to the place, so that of equal ones the leftmost is smallest.
PLACE_BITS = 24

_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    def make() -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.cumprod(out)

    return once_per_worker(("anchors", base, n), make)


class Hashes:
    """64-bit hashes of any byte ranges of one buffer, all at once.

    Fit for choosing anchors and finding those that may recur, not for telling texts apart:
    some families of strings collide.
    """

    def __init__(self, data: np.ndarray) -> None:
        room = 1 << max(16, len(data).bit_length())  # few different table sizes
        self.back = _powers(pow(_BASE, -1, 1 << 64), room)
        terms = _BYTE[data] * _powers(_BASE, room)[: len(data)]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = (self.sums[end] - self.sums[begin]) * self.back[begin]
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32)) ^ (end - begin).astype(np.uint64)


def digests(data: bytes | memoryview, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """XXH128 of each byte range, as two 64-bit halves: equal ones count as equal texts."""
    whole, digest = memoryview(data), xxhash.xxh3_128_digest
    joined = b"".join([digest(whole[b:e]) for b, e in zip(begin.tolist(), end.tolist())])
    halves = np.frombuffer(joined, "<i8").reshape(-1, 2)
    return halves[:, 0], halves[:, 1]


class Runs(NamedTuple):
    """Runs of neighbouring windows with one anchor; positions are units of the buffer."""

    anchor: np.ndarray
    first: np.ndarray  # first window of the run
    last: np.ndarray
    text: np.ndarray  # number of the text


def _least_of(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    rows = -(-len(keys) // width)
    padded = np.full(rows * width, ~np.uint64(0))
    padded[: len(keys)] = keys
    padded = padded.reshape(rows, width)
    upto = np.minimum.accumulate(padded, axis=1).ravel()
    onward = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(keys) - width + 1
    return np.minimum(onward[:n], upto[width - 1 : width - 1 + n])


def anchor_runs(run_hashes: np.ndarray, begins: np.ndarray, ends: np.ndarray, k: int, length: int) -> Runs:
    """Anchors of all windows that lie within one text each. ``run_hashes``: of the k units from each unit on."""
    counts = np.maximum(ends - begins - length + 1, 0)
    total = int(counts.sum())
    if not total:
        return Runs(*[np.empty(0, np.int64)] * 4)
    bits = PLACE_BITS
    if len(run_hashes) >> bits:
        raise ValueError("too many units at once")
    place = np.arange(len(run_hashes), dtype=np.uint64)
    keys = (run_hashes >> np.uint64(bits) << np.uint64(bits)) | place
    least = _least_of(keys, length - k + 1)
    text = np.repeat(np.arange(len(begins)), counts)
    starts = np.arange(total) + np.repeat(begins - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    chosen = (least[starts] & np.uint64((1 << bits) - 1)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])]))
    last = np.append(new[1:], total) - 1
    return Runs(chosen[new], starts[new], starts[last], text[new])


def combined(columns: dict[str, np.ndarray], places: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Rows that agree in ``columns`` as one: ``n`` of them, the place of one (``place``), and those of all if several (``more``)."""
    by = np.lexsort([*list(columns.values())[::-1]])
    differ = np.zeros(max(len(by) - 1, 0), bool)
    for values in columns.values():
        differ |= values[by][1:] != values[by][:-1]
    first = np.flatnonzero(np.concatenate([[True] * bool(len(by)), differ])).astype(np.int64)
    n = np.diff(np.append(first, len(by)))
    several = n > 1
    in_several = np.repeat(several, n)
    offsets = np.concatenate([[0], np.cumsum(np.where(several, n, 0))]).astype(np.int32)

    def structs(rows: np.ndarray) -> pa.StructArray:
        return pa.StructArray.from_arrays([pa.array(values[rows]) for values in places.values()], names=list(places))

    more = pa.ListArray.from_arrays(pa.array(offsets), structs(by[in_several]), mask=pa.array(~several))
    fields = {name: pa.array(values[by][first]) for name, values in columns.items()}
    return pa.RecordBatch.from_pydict({**fields, "n": pa.array(n), "place": structs(by[first]), "more": more})


def covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans joined where they touch or overlap, in order."""
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(b, e) for b, e in out]
