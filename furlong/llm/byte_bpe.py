"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The pieces that the pattern finds, those of a batch that aren't known yet, lie one behind
the other, and the bytes of each form a linked list. For each merge rank a bucket holds the
positions where that merge was possible, and a bitmap in two levels has a bit for each
bucket that isn't empty, so the next rank is found by two find-first-set steps however long
the pieces are. A bucket is taken as a whole: its merges, of all pieces, are done at once
where they don't touch. Entries that an earlier merge made stale are skipped when they come
up.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from furlong.llm.common import Recent, once_per_worker, pieces

WORD = 256  # bits in a word of the lower level of the bitmap
KEPT = 150_000
LONGEST_KEPT = 64
CHUNK_BYTES = 4 * 1024 * 1024
#: Bytes of pieces that are encoded together, at least.
QUEUE_BYTES = 2 * 1024 * 1024
#: Buckets with so few positions are gone through one by one.
FEW = 6
NONE = 2**31 - 1


class RankQueue:
    """Encodes pieces: of each always the merge of the lowest rank, and of that the leftmost."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = pairs
        keys = np.array(list(pairs), np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], 2**63 - 1)
        self.merged = np.append(np.array(list(pairs.values()), np.int32)[order], np.int32(NONE))

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.merged[at], np.int32(NONE))

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as little-endian 32-bit integers."""
        out: list[bytes | None] = []
        held, size = [], 0
        for piece in pieces:
            whole = self.ranks.get(piece)
            out.append(None if whole is None else whole.to_bytes(4, "little"))
            if whole is None:
                held.append(piece)
                size += len(piece)
                if size >= QUEUE_BYTES:
                    self._fill(out, held)
                    held, size = [], 0
        self._fill(out, held)
        return out

    def _fill(self, out: list[bytes | None], pieces: list[bytes]) -> None:
        """Put the ids of ``pieces`` in place of the last ones missing."""
        if not pieces:
            return
        data = np.frombuffer(b"".join(pieces), np.uint8)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids, counts = self._merge(data, sizes)
        packed, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        done = [packed[a:b] for a, b in zip([0, *ends], ends)]
        missing = [i for i in range(len(out)) if out[i] is None]
        for i, blob in zip(missing, done):
            out[i] = blob

    def _merge(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, and how many each has."""
        n = len(data)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        piece = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        # linked lists; the place behind the last stands for the end of each, and no pair has its symbol
        token = np.append(self.byte[data], np.int32(NONE))
        after = np.arange(1, n + 2, dtype=np.int32)
        after[ends - 1] = after[n] = n
        before = np.arange(-1, n, dtype=np.int32)
        before[starts] = n
        possible = np.full(n + 1, NONE, np.int32)  # rank of the merge of this part with the next
        alive = np.ones(n, bool)
        buckets: dict[int, list[int]] = {}
        words: dict[int, int] = {}  # lower level of the bitmap
        summary = 0  # upper level: which words aren't empty

        def offer(rank: int, places: list[int]) -> None:
            nonlocal summary
            held = buckets.get(rank)
            if held is not None:
                held += places
                return
            buckets[rank] = places
            word = rank // WORD
            words[word] = words.get(word, 0) | 1 << rank % WORD
            summary |= 1 << word

        def offer_all(places: np.ndarray) -> None:
            rank = self._ranks_of(token[places], token[after[places]])
            possible[places] = rank
            real = rank != NONE
            places, rank = places[real], rank[real]
            if not len(rank):
                return
            order = np.argsort(rank, kind="stable")
            places, rank = places[order].tolist(), rank[order]
            heads = [0, *(np.flatnonzero(rank[1:] != rank[:-1]) + 1).tolist()]
            for r, a, b in zip(rank[heads].tolist(), heads, [*heads[1:], len(places)]):
                offer(r, places[a:b])

        tokens, afters, befores, possibles, alives = map(memoryview, (token, after, before, possible, alive))
        pair = self.pairs.get
        offer_all(np.arange(n, dtype=np.int32))
        while summary:
            word = (summary & -summary).bit_length() - 1
            bits = words[word]
            lowest = bits & -bits
            rank = word * WORD + lowest.bit_length() - 1
            places = buckets.pop(rank)
            words[word] = bits ^ lowest
            if bits == lowest:
                summary ^= 1 << word
            if len(places) <= FEW:
                places.sort()
                for k, i in enumerate(places):
                    if possibles[i] != rank:
                        continue  # stale
                    j = afters[i]
                    k_after = afters[j]
                    possibles[j], alives[j], tokens[i], afters[i] = NONE, False, rank, k_after
                    befores[k_after] = i
                    new = pair(rank << 32 | tokens[k_after], NONE) if k_after < n else NONE
                    possibles[i] = least = new
                    if new != NONE:
                        offer(new, [i])
                    h = befores[i]
                    if h < n:
                        possibles[h] = new = pair(tokens[h] << 32 | rank, NONE)
                        if new != NONE:
                            offer(new, [h])
                            least = min(least, new)
                    if least < rank and k + 1 < len(places):
                        offer(rank, places[k + 1 :])  # a merge that came up just now comes first
                        break
                continue
            at = np.unique(np.array(places, np.int32))
            at = at[possible[at] == rank]
            if not len(at):
                continue
            chosen = self._apart(at, rank, token, after, before, piece)
            if len(chosen) < len(at):
                offer(rank, np.setdiff1d(at, chosen, assume_unique=True).tolist())
            joined = after[chosen]
            behind = after[joined]
            token[chosen], after[chosen], before[behind] = rank, behind, chosen
            possible[joined], alive[joined] = NONE, False
            ahead = before[chosen]
            offer_all(np.unique(np.concatenate([ahead[ahead < n], chosen])))
        return token[:n][alive], np.add.reduceat(alive, starts, dtype=np.int64)

    def _apart(self, at: np.ndarray, rank: int, token: np.ndarray, after: np.ndarray, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """The places of one bucket whose merges can be done at once, just as if they were done from left to right."""
        touching = after[at[:-1]] == at[1:]
        if touching.any():  # of places that touch every other one
            run = np.maximum.accumulate(np.where(np.concatenate([[True], ~touching]), np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
        same = piece[at[1:]] == piece[at[:-1]]
        if not same.any():
            return at
        # a merge that makes a pair of lower rank is the last of its piece, for now
        behind = after[after[at]]
        early = self._ranks_of(np.full(len(at), rank), token[behind]) < rank
        left = token[before[at]]
        left[1:][behind[:-1] == at[1:]] = rank
        early |= self._ranks_of(left, np.full(len(at), rank)) < rank
        if not early.any():
            return at
        first = np.concatenate([[True], ~same])
        seen = np.cumsum(early) - early  # early ones before this one
        heads = np.flatnonzero(first)
        return at[seen == np.repeat(seen[heads], np.diff(np.append(heads, len(at))))]


class Coder:
    """Encoder and decoder of one rank file."""

    # No piece goes on from a character that isn't white space to one that is, so a text can
    # be cut before every run of white space. That needs one notion of white space: texts with
    # any other than these characters are not cut.
    cut = re.compile(r"[ \t\n\r\f\v]*[^ \t\n\r\f\v]+|[ \t\n\r\f\v]+")
    other_space = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.find = regex.compile(pattern).findall
        self.queue = RankQueue(ranks)
        self.pieces, self.chunks = Recent(KEPT, LONGEST_KEPT), Recent(KEPT, LONGEST_KEPT)
        self.tokens = {rank: token for token, rank in ranks.items()}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as little-endian 32-bit integers."""
        parts = [([text] if self.other_space.search(text) else self.cut.findall(text)) if text else [] for text in texts]
        chunks = self.chunks.of(set().union(*parts), self._encode_chunks).__getitem__
        return [b"".join(map(chunks, part)) for part in parts]

    def _encode_chunks(self, chunks: list[str]) -> Iterator[bytes]:
        found = list(map(self.find, chunks))
        known = self.pieces.of(set().union(*found), lambda new: self.queue.encode([p.encode() for p in new])).__getitem__
        return (b"".join(map(known, part)) for part in found)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def coder(path: str, pattern: str) -> Coder:
    """The coder of a rank file, read once per worker."""
    return once_per_worker(("byte_bpe", path, pattern), lambda: Coder(path, pattern))


def _ids_array(blobs: list[bytes]) -> pa.Array:
    offsets = np.cumsum([0] + [len(b) // 4 for b in blobs]).astype(np.int32)
    values = np.frombuffer(b"".join(blobs), "<i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def encode(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Id and ``ids`` (array of int) of every row; null counts as empty, and an empty text has no ids.

    ``path``: a rank file (token in base64, rank) that every executor has. Each row is
    encoded on its own, so repeated rows and rows without an id keep theirs. Other columns
    are neither read nor returned.
    """
    return _encoded(docs, path, pattern, id_column, text, False).drop("round_trip")


def encode_checked(
    docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """As ``encode``, with ``round_trip``: whether the ids decode to the text's bytes."""
    return _encoded(docs, path, pattern, id_column, text, True)


def _encoded(docs: DataFrame, path: str, pattern: str, id_column: str, text: str, check: bool) -> DataFrame:

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for batch in batches:
            for some in pieces(batch, "__text", CHUNK_BYTES):
                texts = [t or "" for t in some.column(1).to_pylist()]
                blobs = own.encode(texts)
                same = [not check or own.decode(np.frombuffer(b, "<u4").tolist()) == t.encode() for b, t in zip(blobs, texts)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), _ids_array(blobs), pa.array(same)], names=["__id", "ids", "round_trip"]
                )

    rows = docs.select(F.col(id_column).cast("long").alias("__id"), F.col(text).alias("__text"))
    encoded = rows.mapInArrow(run, "__id long, ids array<int>, round_trip boolean")
    return encoded.withColumnRenamed("__id", id_column)


def decode(encoded: DataFrame, path: str, pattern: str, id_column: str = "doc_id") -> DataFrame:
    """Id and ``decoded`` (bytes) of every row of a table of ``ids``; null ids give no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for batch in batches:
            decoded = [own.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(decoded, pa.binary())], names=["__id", "decoded"])

    rows = encoded.select(F.col(id_column).cast("long").alias("__id"), "ids")
    return rows.mapInArrow(run, "__id long, decoded binary").withColumnRenamed("__id", id_column)


def coding_digest(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the number of its text's ids, and hashes of the ids and of what they decode to; null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for batch in batches:
            for some in pieces(batch, "__text", CHUNK_BYTES):
                blobs = own.encode([t or "" for t in some.column(1).to_pylist()])
                decoded = [hashlib.sha256(own.decode(np.frombuffer(b, "<u4").tolist())).hexdigest() for b in blobs]
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0), pa.array([len(b) // 4 for b in blobs], pa.int64()),
                        pa.array([hashlib.sha256(b).hexdigest() for b in blobs], pa.string()), pa.array(decoded, pa.string()),
                    ],
                    names=["__id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    rows = docs.select(F.col(id_column).cast("long").alias("__id"), F.col(text).alias("__text"))
    schema = "__id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, schema).withColumnRenamed("__id", id_column)
