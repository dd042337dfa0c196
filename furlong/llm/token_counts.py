"""Token counts of texts by a piece model (BPE with byte fallback), with rank-synchronous array merging.

No piece has white space behind another character, so a text's tokens are those of its
pre-tokens: a word with the spaces before it. The pre-tokens of a batch that have not been
met before are held as one ragged array of symbols. In every round each sequence applies its
lowest-ranking pair at all places at once, and a sequence without a pair is done: its
symbols are counted, no ids are made.

The model's own rule is one merge at a time, the best pair first and of equal ones the
leftmost. A round differs from that only where a merge makes a pair that ranks no lower than
itself; of such a round only the merges up to the first of that kind are applied.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from furlong.llm.common import once_per_worker, pieces

CHUNK_BYTES = 4 * 1024 * 1024
#: Characters of pre-tokens merged at once.
BATCH_CHARS = 2_000_000
#: Results kept per worker, of pre-tokens no longer than this.
KEPT = 500_000
LONGEST_KEPT = 64
#: Rounds after which the few sequences left, long and repetitive ones, go on one merge at a time.
ROUNDS = 200
SPACE = "▁"
NONE = np.int32(2**31 - 1)

# kinds of pieces, of models and of fields in the model's file: fixed values
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The numbered fields of a message in the protocol buffers' wire format."""

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    at = 0
    while at < len(data):
        tag = number()
        field, kind = tag >> 3, tag & 7
        if kind == 0:
            yield field, number()
            continue
        size = {1: 8, 5: 4}.get(kind) or number()
        yield field, data[at : at + size]
        at += size


class PieceModel:
    """What counting needs of a model's file: symbols, and which pairs of them merge at which rank."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            parts = list(_fields(file.read()))
        scored: dict[str, float] = {}
        for field, body in parts:
            if field == 1:
                piece = dict(_fields(body))
                kind = piece.get(3, NORMAL)
                if kind in (USER_DEFINED, UNUSED):
                    raise ValueError("models with user-defined or unused pieces are not supported")
                if kind == NORMAL:
                    scored[piece[1].decode()] = float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0])
        trainer = dict(_fields(b"".join(body for field, body in parts if field == 2)))
        normalizer = dict(_fields(b"".join(body for field, body in parts if field == 3)))
        self.prefix = " " if normalizer.get(3, 1) else ""
        plain = not normalizer.get(2) and normalizer.get(4, 1) == 0 and normalizer.get(5, 1) == 1
        if trainer.get(3) != BPE or not trainer.get(35) or trainer.get(24) or not plain:
            raise ValueError("only BPE models with byte fallback that leave texts as they are are supported")
        if any(SPACE in piece.lstrip(SPACE) for piece in scored):
            raise ValueError("pieces with white space behind another character are not supported")

        letters = {letter for piece in scored for letter in piece}
        names = {name: i for i, name in enumerate([*scored, *sorted(letters - scored.keys())])}
        ranks = {score: i for i, score in enumerate(sorted(set(scored.values()), reverse=True))}
        pairs = {}
        for piece, score in scored.items():
            for cut in range(1, len(piece)):
                left, right = names.get(piece[:cut]), names.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = ranks[score], names[piece]
        keys = sorted(pairs)
        self.pair_keys = np.array([*keys, 2**63 - 1], np.int64)
        self.pair_ranks = np.array([*[pairs[k][0] for k in keys], NONE], np.int32)
        self.pair_merged = np.array([*[pairs[k][1] for k in keys], 0], np.int32)
        # a symbol that isn't a piece falls back to its bytes
        self.weight = np.array([1 if name in scored else len(name.encode()) for name in names], np.int64)
        self.symbol = np.full(0x110000, -1, np.int32)
        for letter in letters:
            self.symbol[ord(letter)] = names[letter]
        neighbours = {piece[i : i + 2] for piece in scored for i in range(len(piece) - 1)}
        self.neighbours = np.array(sorted(ord(a) << 32 | ord(b) for a, b in neighbours) + [2**63 - 1], np.int64)
        apart = re.escape("".join(c for c in "\t\n\r\f\v" if c not in letters))
        self.pre_tokens = re.compile(f" *[^ {apart}]+| +" + (f"|[{apart}]" if apart else "")).findall

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; ``NONE`` where it doesn't merge."""
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pair_keys, key)
        hit = self.pair_keys[at] == key
        return np.where(hit, self.pair_ranks[at], NONE), self.pair_merged[at]

    def counts(self, tokens: list[str]) -> np.ndarray:
        """Number of pieces of each pre-token."""
        points = np.frombuffer("".join(tokens).replace(" ", SPACE).encode("utf-32-le", "surrogatepass"), "<u4")
        token = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
        symbols = self.symbol[points]
        known = symbols >= 0
        lost = points[~known]  # each as its bytes
        size = 1 + (lost >= 0x80).astype(np.int64) + (lost >= 0x800) + (lost >= 0x10000)
        out = np.bincount(token[~known], size, len(tokens)).astype(np.int64)
        # no merge reaches over neighbours that no piece has next to each other
        key = points[:-1].astype(np.int64) << 32 | points[1:]
        joined = (self.neighbours[np.searchsorted(self.neighbours, key)] == key) & (token[1:] == token[:-1])
        begins = np.concatenate([[True], ~joined])[: len(points)]
        for name, merged in self._merged(symbols[known], begins[known], token[known]):
            out += np.bincount(name, self.weight[merged], len(tokens)).astype(np.int64)
        return out

    def _merged(self, symbols: np.ndarray, begins: np.ndarray, token: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Surviving symbols, each with its token, as their sequences are done."""
        rank, merged = self._ranked(symbols, begins)
        for _ in range(ROUNDS):
            if not len(symbols):
                return
            starts = np.flatnonzero(begins)
            lengths = np.diff(np.append(starts, len(symbols)))
            least = np.minimum.reduceat(rank, starts)
            on = np.repeat(least != NONE, lengths)
            if not on.all():
                yield token[~on], symbols[~on]
                symbols, begins, token, rank, merged = (x[on] for x in (symbols, begins, token, rank, merged))
                lengths, least = lengths[least != NONE], least[least != NONE]
                if not len(symbols):
                    return
            chosen = self._chosen(symbols, begins, rank, merged, np.repeat(least, lengths))
            symbols = symbols.copy()
            symbols[chosen] = merged[chosen]
            stays = np.ones(len(symbols), bool)
            stays[chosen + 1] = False
            # of the pairs only those at a merge and before it are new
            touched = np.zeros(len(symbols), bool)
            touched[chosen] = True
            symbols, begins, token, rank, merged, touched = (x[stays] for x in (symbols, begins, token, rank, merged, touched))
            touched[:-1] |= touched[1:] & ~begins[1:]
            self._rank_again(symbols, begins, rank, merged, np.flatnonzero(touched))
        for begin, end in zip(starts := np.flatnonzero(begins), [*starts[1:], len(symbols)]):
            left = self._one_by_one(symbols[begin:end])
            yield np.full(len(left), token[begin]), left

    def _ranked(self, symbols: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, merged = np.full(len(symbols), NONE), np.zeros(len(symbols), np.int32)
        self._rank_again(symbols, begins, rank, merged, np.arange(len(symbols)))
        return rank, merged

    def _rank_again(self, symbols, begins, rank, merged, at) -> None:
        """Rank the pairs that begin at ``at`` anew, in place."""
        rank[at] = NONE
        at = at[at < len(symbols) - 1]
        at = at[~begins[at + 1]]
        rank[at], merged[at] = self.pair(symbols[at], symbols[at + 1])

    def _chosen(self, symbols, begins, rank, merged, least) -> np.ndarray:
        """The places of this round's merges."""
        at = np.flatnonzero(rank == least)
        # of pairs that overlap every other one, from the left
        gap = np.concatenate([[True], (np.diff(at) > 1) | begins[at[1:]]])
        run = np.maximum.accumulate(np.where(gap, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - run) % 2 == 0]
        made = merged[at]
        # a pair made by a merge that ranks no lower than it comes before the merges further right
        after = at + 2
        inside = after < len(symbols)
        inside[inside] = ~begins[after[inside]]
        early = np.zeros(len(at), bool)
        early[inside] = self.pair(made[inside], symbols[after[inside]])[0] <= rank[at[inside]]
        before = np.flatnonzero(~begins[at])
        left = symbols[at[before] - 1]
        touching = before[(before > 0) & (at[before] - at[before - 1] == 2)]
        left[np.searchsorted(before, touching)] = made[touching - 1]
        early[before] |= self.pair(left, made[before])[0] <= rank[at[before]]
        if not early.any():
            return at
        sequence = np.cumsum(begins)[at]
        first = np.concatenate([[True], sequence[1:] != sequence[:-1]])
        seen = np.cumsum(early) - early  # early ones before this one, over all sequences
        return at[seen == np.repeat(seen[first], np.diff(np.append(np.flatnonzero(first), len(at))))]

    def _one_by_one(self, symbols: np.ndarray) -> np.ndarray:
        """What is left of one sequence, merged by a heap."""
        n = len(symbols)
        own, after, before = array("i", symbols.tolist()), array("i", range(1, n + 1)), array("i", range(-1, n - 1))
        pairs = self.pairs()
        heap = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else n
            if j < n and (found := pairs.get(own[i] << 32 | own[j])) is not None:
                put(found[0] << 40 | i)

        put = heap.append
        for i in range(n - 1):
            offer(i)
        heapify(heap)

        def put(entry: int) -> None:
            heappush(heap, entry)

        while heap:
            entry = heappop(heap)
            rank, i = entry >> 40, entry & (1 << 40) - 1
            j = after[i]
            found = pairs.get(own[i] << 32 | own[j]) if own[i] >= 0 and j < n else None
            if found is None or found[0] != rank:
                continue  # stale
            own[i], own[j] = found[1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            offer(before[i])
        left = np.array(own, np.int64)
        return left[left >= 0]

    def pairs(self) -> dict[int, tuple[int, int]]:
        """The pairs as a dictionary."""
        if not hasattr(self, "_pairs"):
            values = zip(self.pair_ranks[:-1].tolist(), self.pair_merged[:-1].tolist())
            self._pairs = dict(zip(self.pair_keys[:-1].tolist(), values))
        return self._pairs


class Counter:
    """Counts of whole texts; a bounded number of results is kept, those met last the longest."""

    def __init__(self, path: str) -> None:
        self.model = PieceModel(path)
        self.kept: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        model = self.model
        found = [model.pre_tokens(model.prefix + text.replace(SPACE, " ")) if text else [] for text in texts]
        met = set().union(*found)
        if len(self.kept) > KEPT:
            self.kept, self.older = {}, self.kept
        older = met & self.older.keys()
        here = {token: self.older[token] for token in older - self.kept.keys()}
        new = list(met - self.kept.keys() - older)
        begin, held = 0, 0
        for end, token in enumerate(new, 1):
            held += len(token)
            if held >= BATCH_CHARS or end == len(new):
                some = new[begin:end]
                here.update(zip(some, model.counts(some).tolist()))
                begin, held = end, 0
        if not any(len(token) > LONGEST_KEPT for token in here):
            self.kept.update(here)
            return [sum(map(self.kept.__getitem__, tokens)) for tokens in found]
        long = {token: n for token, n in here.items() if len(token) > LONGEST_KEPT}
        self.kept.update((token, n) for token, n in here.items() if len(token) <= LONGEST_KEPT)
        return [sum(long[t] if t in long else self.kept[t] for t in tokens) for tokens in found]


def counter(path: str) -> Counter:
    """The counter of a model's file, read once per worker."""
    return once_per_worker(("token_counts", path), lambda: Counter(path))


def count_tokens(docs: DataFrame, path: str, limit: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of every row.

    ``path``: a model file that every executor has. No begin, end or other special tokens
    are added, and their names in a text are ordinary text. Null counts as empty, and an
    empty text has no tokens. Every row is counted on its own, so repeated rows and rows
    without an id keep theirs; nothing is shuffled. Other columns are neither read nor
    returned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            for some in pieces(batch, "__text", CHUNK_BYTES):
                counts = own.count([t or "" for t in some.column(2).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(counts, pa.int64())], names=["__id", "n_bytes", "n_tokens"]
                )

    rows = docs.select(
        F.col(id_column).alias("__id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), F.col(text).alias("__text")
    )
    kind = docs.schema[id_column].dataType.simpleString()
    counted = rows.mapInArrow(run, f"__id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("__id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
