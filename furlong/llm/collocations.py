"""Phrases that occur often and whose parts seldom stand without each other, found by Rabin-Karp fingerprints.

Every word has a code, and prefix sums of a polynomial over the codes give the fingerprint of
any run of words at once. Phrases are counted by fingerprint, one length after the other: a
phrase can only be frequent if both phrases of one word less in it are, so the fingerprints
that turned out frequent, kept as a bitmap of fixed size, spare the others the shuffle. A
last pass follows a pointer to each frequent fingerprint's text and counts by text, so
phrases that share a fingerprint part there; no other phrase's text is ever made.

The bitmap only prunes: what it lets pass by chance, or because a corpus has filled it, is
counted and dropped.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from furlong.llm.common import cut_lineage, once_per_worker, pieces
from furlong.operators.skew import spread_join

#: Text read at once; a longer one is read in parts.
CHUNK_BYTES = 2 * 1024 * 1024
#: Bits of the bitmap of frequent fingerprints of one length: 8 MB.
BITMAP_BITS = 26
#: Parts of a language in which its best phrases are first chosen.
SALTS = 64
#: Longer words are coded one by one.
LONG_WORD = 64

WORD, BLANK, STOP = 0, 1, 2
_STOPS, _BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b" \x09"
_KINDS = bytes(STOP if b in _STOPS else BLANK if b in _BLANKS else WORD for b in range(256))
_FOLD = bytes(range(256)).lower()  # A-Z only

_PRIMES = (2**31 - 1, 2**31 - 19)
_BASES = (1_180_463_921, 1_823_094_217)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64 bits, so that the upper ones are fit for a bitmap."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    """base^0 ... base^(n-1) modulo a prime under 2^31."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), prime)) % np.uint64(prime)])
    return out[:n].astype(np.uint32)


def _tables(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of each base and of its inverse, made once per worker for a number of words."""
    room = 1 << max(20, n.bit_length())
    make = lambda: [(_powers(b, p, room), _powers(pow(b, -1, p), p, room)) for b, p in zip(_BASES, _PRIMES)]
    return once_per_worker(("collocations", _BASES, _PRIMES, room), make)


_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Bytes of every word that are read at once; and those kept free behind the last text.
FIRST_BYTES, ROOM = 16, 24


class Words(NamedTuple):
    """The words of some texts, in a buffer of folded bytes."""

    raw: np.ndarray  # with some bytes behind the last text
    start: np.ndarray
    size: np.ndarray
    piece: np.ndarray  # words of one piece have the same number
    text: np.ndarray  # number of the text
    own: np.ndarray  # whether phrases that begin here are counted here

    def blocks(self, of: np.ndarray | slice, at: int) -> np.ndarray:
        """The eight bytes from byte ``at`` on of some words, zeros behind a word's end."""
        overlapping = np.ndarray(len(self.raw) - 7, "<u8", self.raw, 0, (1,))
        return overlapping[self.start[of] + at] & _MASKS[np.clip(self.size[of] - at, 0, 8)]

    def bytes_of(self, i: int) -> bytes:
        return self.raw[self.start[i] : self.start[i] + self.size[i]].tobytes()


def words_of(texts: list[bytes], own_bytes: int | None = None) -> Words:
    """Fold and split; ``own_bytes``: words that begin beyond it belong to the next part of a long text."""
    # a line feed between texts ends a piece, as they do; sizes count it
    joined = b"".join([b"\n", b"\n".join(texts), b"\n" * ROOM])
    raw = np.frombuffer(joined.translate(_FOLD), np.uint8)
    kind = np.frombuffer(joined.translate(_KINDS), np.uint8)
    inside = kind == WORD
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, stop = edge[::2], edge[1::2]
    begins = np.cumsum([1, *[len(t) + 1 for t in texts[:-1]]])
    new = np.zeros(len(start) + 1, bool)
    new[np.searchsorted(start, np.flatnonzero(kind == STOP))] = True
    own = np.ones(len(start), bool) if own_bytes is None else start <= own_bytes
    return Words(raw, start, stop - start, np.cumsum(new[:-1]), np.searchsorted(begins, start, "right") - 1, own)


class Fingerprints:
    """Fingerprints of any runs of words, 62 bits from two prefix polynomials."""

    def __init__(self, words: Words) -> None:
        code = words.size.astype(np.uint64)
        for at in range(0, FIRST_BYTES, 8):
            code = _mixed(code ^ words.blocks(slice(None), at))
        some, at = np.flatnonzero((words.size > FIRST_BYTES) & (words.size <= LONG_WORD)), FIRST_BYTES
        while len(some):
            code[some] = _mixed(code[some] ^ words.blocks(some, at))
            at += 8
            some = some[words.size[some] > at]
        for i in np.flatnonzero(words.size > LONG_WORD).tolist():
            code[i] = int.from_bytes(hashlib.blake2b(words.bytes_of(i), digest_size=8).digest())
        codes = [code % np.uint64(_PRIMES[0]), (code >> np.uint64(32)) % np.uint64(_PRIMES[1])]
        self.codes = codes
        self.tables = _tables(len(words.start))
        self.sums = []
        for code, (powers, _), prime in zip(codes, self.tables, _PRIMES):
            terms = (code + np.uint64(1)) * powers[: len(code)] % np.uint64(prime)
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)]))

    def of(self, first: np.ndarray, length: int) -> np.ndarray:
        out = np.full(len(first), length, np.uint64)
        for sums, (_, back), prime in zip(self.sums, self.tables, _PRIMES):
            p = np.uint64(prime)
            out = out << np.uint64(31) | (sums[first + length] - sums[first]) % p * back[first] % p
        return out


def _parts(text: bytes, longest: int) -> Iterator[tuple[bytes, int]]:
    """A long text in parts, each with the words behind it that its last phrases need, and how many bytes are its own."""
    kind = text.translate(_KINDS)
    gap = re.compile(b"[\x01\x02]").search
    word = re.compile(b"\x00+").finditer
    at = 0
    while at < len(text):
        found = gap(kind, at + CHUNK_BYTES)
        cut = found.start() if found else len(text)
        behind = islice(word(kind, cut), longest - 1)
        tail = max([cut, *[match.end() for match in behind]])
        yield text[at:tail], cut - at
        at = cut


def _read(batch: pa.RecordBatch, longest: int) -> Iterator[tuple[pa.RecordBatch, Words]]:
    """The words of a batch, some texts at a time."""
    for some in pieces(batch, "text", CHUNK_BYTES):
        texts = some.column("text").cast(pa.large_binary()).to_pylist()
        if len(texts) > 1 or len(texts[0]) <= CHUNK_BYTES:
            yield some, words_of(texts)
        else:  # a single long text
            for part, own in _parts(texts[0], longest):
                yield some, words_of([part], own)


def _language_keys(some: pa.RecordBatch) -> np.ndarray:
    """A 64-bit number per row that stands for its language."""
    coded = some.column("lang").dictionary_encode()
    numbers = [int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest()) for name in coded.dictionary.to_pylist()]
    return np.array(numbers, np.uint64)[coded.indices.to_numpy(zero_copy_only=False)]


def _phrases(
    words: Words, prints: Fingerprints, languages: np.ndarray, longest: int, bitmaps: list[np.ndarray]
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per length the first words and fingerprints of the phrases both of whose shorter ones are in the bitmaps.

    Goes one length beyond the bitmaps, at most to ``longest``.
    """
    language = languages[words.text]
    frequent = np.ones(len(words.start), bool)
    for length in range(1, min(longest, len(bitmaps) + 1) + 1):
        if length == 1:
            first = np.arange(len(words.start))
        else:  # the phrases one word shorter that begin at this word and at the next
            first = np.flatnonzero(frequent[:-1] & frequent[1:])
            first = first[first + length <= len(words.start)]
            first = first[words.piece[first] == words.piece[first + length - 1]]
        keys = _mixed(prints.of(first, length) ^ language[first])
        if length <= len(bitmaps):
            bitmap = bitmaps[length - 1]
            place = keys >> np.uint64(65 - (8 * len(bitmap)).bit_length())
            hit = (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
            frequent = np.zeros(len(words.start), bool)
            frequent[first[hit]] = True
            first, keys = first[hit], keys[hit]
        yield length, first, keys


#: Marks the fingerprints of words that are in a frequent phrase of two.
USED = "used"


def _counted(length: int, longest: int, bitmaps: list[Broadcast]):
    """Per batch how often each fingerprint of one length occurs.

    With single words also their number per language; with phrases of three also which words
    are in a frequent phrase of two.
    """

    def rows(keys: np.ndarray, n: np.ndarray, lang: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([lang, pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = [np.frombuffer(b.value, np.uint8) for b in bitmaps]
        for batch in batches:
            for some, words in _read(batch, longest):
                prints, languages = Fingerprints(words), _language_keys(some)
                for at, first, keys in _phrases(words, prints, languages, longest, maps):
                    if at == 2 and length == 3:
                        both = np.unique(np.concatenate([first, first + 1]))
                        used = np.unique(_mixed(prints.of(both, 1) ^ languages[words.text[both]]))
                        yield rows(used, np.zeros(len(used)), pa.array([USED] * len(used), pa.string()))
                    if at == length:
                        keys, n = np.unique(keys[words.own[first]], return_counts=True)
                        yield rows(keys, n, pa.nulls(len(keys), pa.string()))
                if length == 1:
                    per_text = np.bincount(words.text[words.own], minlength=some.num_rows)
                    totals = pa.table({"lang": some.column("lang"), "n": per_text}).group_by("lang").aggregate([("n", "sum")])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(totals["lang"].to_pylist(), pa.string()), pa.nulls(len(totals), pa.int64()), pa.array(totals["n_sum"].to_pylist(), pa.int64())],
                        names=["lang", "key", "n"],
                    )

    return run


def _word_numbers(words: Words, prints: Fingerprints) -> np.ndarray:
    """A number per word, the same for equal words only: each is held against the first with its code."""
    codes = prints.codes[0] << np.uint64(31) | prints.codes[1]
    _, at, number = np.unique(codes, return_index=True, return_inverse=True)
    other = at[number]
    same = words.size == words.size[other]
    for begin in range(0, FIRST_BYTES, 8):
        block = words.blocks(slice(None), begin)
        same &= block == block[other]
    some, begin = np.flatnonzero(same & (words.size > FIRST_BYTES) & (words.size <= LONG_WORD)), FIRST_BYTES
    while len(some):
        equal = words.blocks(some, begin) == words.blocks(other[some], begin)
        same[some[~equal]] = False
        begin += 8
        some = some[equal & (words.size[some] > begin)]
    for i in np.flatnonzero(same & (words.size > LONG_WORD)).tolist():
        same[i] = words.bytes_of(i) == words.bytes_of(int(other[i]))
    known: dict[bytes, int] = {}
    for i in np.flatnonzero(~same).tolist():  # a code shared by different words
        number[i] = known.setdefault(words.bytes_of(i), len(at) + len(known))
    return number


def _apart(keys: np.ndarray, numbers: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
    """Group numbers of phrases by key and words: each is held against the first with its key."""
    _, at, group = np.unique(keys, return_index=True, return_inverse=True)
    other = first[at[group]]
    same = np.ones(len(first), bool)
    for k in range(length):
        same &= numbers[first + k] == numbers[other + k]
    known: dict[tuple[int, ...], int] = {}
    for i in np.flatnonzero(~same).tolist():  # a fingerprint shared by different phrases
        phrase = (int(keys[i]), *numbers[first[i] : first[i] + length].tolist())
        group[i] = known.setdefault(phrase, len(at) + len(known))
    return group


def _texts(words: Words, first: np.ndarray, length: int) -> pa.Array:
    """The phrases' words joined by single spaces."""
    each = (first[:, None] + np.arange(length)).ravel()
    size = words.size[each]
    spaced = size + 1
    spaced[length - 1 :: length] -= 1
    ends = np.concatenate([[0], np.cumsum(spaced)])
    out = np.full(int(ends[-1]), 0x20, np.uint8)
    along, skipped = np.arange(int(size.sum())), np.cumsum(size) - size
    out[along + np.repeat(ends[:-1] - skipped, size)] = words.raw[along + np.repeat(words.start[each] - skipped, size)]
    offsets = ends[::length].astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes())).cast(pa.string())


def _materialised(longest: int, bitmaps: list[Broadcast]):
    """Per batch the texts of the phrases whose fingerprints are frequent, with their counts and one document each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = [np.frombuffer(b.value, np.uint8) for b in bitmaps]
        for batch in batches:
            for some, words in _read(batch, longest):
                prints = Fingerprints(words)
                numbers = _word_numbers(words, prints)
                for length, first, keys in _phrases(words, prints, _language_keys(some), longest, maps):
                    counted = words.own[first]
                    first, keys = first[counted], keys[counted]
                    # there may be two rows of one phrase where fingerprints are shared; they are added up
                    _, at, n = np.unique(_apart(keys, numbers, first, length), return_index=True, return_counts=True)
                    text = pa.array(words.text[first[at]])
                    yield pa.RecordBatch.from_arrays(
                        [
                            some.column("lang").take(text), _texts(words, first[at], length), pa.array(np.full(len(at), length, np.int32)),
                            pa.array(n.astype(np.int64)), some.column("id").take(text),
                        ],
                        names=["lang", "phrase", "words", "n", "id"],
                    )

    return run


def _bitmap(frequent: DataFrame) -> Broadcast:
    """The upper bits of the keys as a bitmap; its size does not depend on the table's."""
    place = F.shiftrightunsigned("key", 64 - BITMAP_BITS)
    bit = F.expr("shiftleft(1L, cast(place % 64 AS int))")
    cells = frequent.select(place.alias("place")).groupBy((F.col("place") / 64).cast("long").alias("cell")).agg(F.bit_or(bit).alias("bits"))
    found = cells.toArrow()
    out = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    out[found["cell"].to_numpy()] = found["bits"].to_numpy()
    return frequent.sparkSession.sparkContext.broadcast(out.astype("<i8").tobytes())


def frequent_phrases(docs: DataFrame, least: int, longest: int, id_column: str, text: str, lang: str) -> tuple[DataFrame, DataFrame]:
    """The phrases of up to ``longest`` words with at least ``least`` occurrences, and the number of words per language.

    Both are stored tables: ``lang``, ``phrase``, ``words``, ``a``, ``example_id``; and ``lang``, ``n``.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    bitmaps: list[Broadcast] = []
    totals, used = None, None
    for length in range(1, longest):
        counts = rows.mapInArrow(_counted(length, longest, list(bitmaps)), "lang string, key long, n long")
        counts = counts.groupBy("lang", "key").agg(F.sum("n").alias("n"))
        counts = cut_lineage(counts.filter((F.col("n") >= least) | F.col("lang").isNotNull()), f"prints-{length}")
        if length == 1:
            totals = counts.filter("key IS NULL").select("lang", "n")
        if length == 3:
            used = _bitmap(counts.filter(F.col("lang") == USED))
        bitmaps.append(_bitmap(counts.filter("lang IS NULL")))
    # only words that are in a frequent phrase are parts of one
    last = [used if used is not None else bitmaps[0], *bitmaps[1:]]
    found = rows.mapInArrow(_materialised(longest, last), "lang string, phrase string, words int, n long, id long")
    found = found.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("a"), F.min("id").alias("example_id"))
    found = cut_lineage(found.filter(F.col("a") >= least), "phrases")
    for bitmap in {*bitmaps, *last}:
        bitmap.destroy()
    return found, totals


def _joined(first: Column | int, count: Column | int) -> Column:
    return F.array_join(F.slice("__parts", first, count), " ")


def collocations(
    docs: DataFrame,
    least: int = 30,
    longest: int = 4,
    top: int = 2000,
    covering: int = 80,
    id_column: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """The best phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``, ``example_id``.

    Texts are folded (A-Z), cut at ``.,;:!?`` and 0x0A-0x0D, and split into words at spaces and
    tabs. Phrases of 2 to ``longest`` words with ``a >= least`` occurrences, overlapping ones
    included, are cut in two at every word: ``l`` and ``r`` are the parts' occurrences and the
    score is floor(2,000,000 * a / (l + r)); the cut with the lowest counts, of equal ones the
    first. Left out are phrases inside a longer one that has ``covering`` hundredths of their
    occurrences or more. Each language's first ``top`` by score, occurrences and phrase (UTF-8).
    ``n``: words of the language; ``example_id``: the smallest id of a document that has the phrase.

    Rows without a language have the language ``und``, rows without text no words; rows without
    an id and repeated rows count like others. Texts of any length are read in parts. An empty
    table gives no rows. Other columns are neither read nor returned.
    """
    grams, totals = frequent_phrases(docs, least, longest, id_column, text, lang)
    phrases = grams.filter("words >= 2")
    longer = phrases.filter("words >= 3").withColumn("__parts", F.split("phrase", " "))
    # a phrase inside a longer one is inside one that is a single word longer and no less frequent
    shorter = F.array(_joined(1, F.col("words") - 1), _joined(2, F.col("words") - 1))
    around = longer.select("lang", "a", F.explode(F.array_distinct(shorter)).alias("phrase"))
    around = around.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    big = lambda name: F.col(name).cast("decimal(19,0)")
    covered = F.coalesce(big("around") * 100 >= big("a") * covering, F.lit(False))
    left = phrases.join(around, ["lang", "phrase"], "left").filter(~covered).drop("around")

    cuts = left.withColumn("__parts", F.split("phrase", " ")).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns({"first": _joined(1, F.col("k")), "rest": _joined(F.col("k") + 1, F.col("words") - F.col("k"))})
    cuts = cut_lineage(cuts.drop("__parts", "words"), "cuts")
    parts = grams.select("lang", "phrase", "a")
    # a word that begins a large share of all phrases is spread
    with_l = spread_join(cuts, parts.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l")), ["lang", "first"], "inner")
    with_r = spread_join(with_l, parts.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"], "inner")
    scored = with_r.withColumn("score", F.expr("(cast(a AS decimal(19,0)) * cast(2000000 AS decimal(7,0))) div (l + r)"))
    best = scored.groupBy("lang", "phrase", "a", "example_id").agg(F.min(F.struct("score", "k", "l", "r")).alias("__best"))
    best = best.select("lang", "phrase", "a", "example_id", "__best.score", "__best.l", "__best.r")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = best.withColumn("__salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "__salt").orderBy(*order)))
    ranked = some.filter(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return (
        ranked.filter(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "example_id")
    )
