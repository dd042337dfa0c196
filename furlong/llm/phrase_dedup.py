"""Removal of passages that an earlier document has, located by automata of recurring phrases.

First the phrases are confirmed: of each window of ``length`` words the anchor phrase
(``anchors``) is counted over all documents, by its text, and those that occur once are out;
where they occur is not kept. Documents are dealt out to shards by a hash. Each shard is
sent the recurring phrases that its documents have, makes one Aho-Corasick automaton of
them, and streams its documents through it, which locates every occurrence. A window belongs
to the occurrence in it whose phrase has the smallest hash, so equal windows belong to equal
phrases. Stretches of windows around an occurrence that are equal are settled by the
smallest id that has them; where different stretches share a phrase, their windows are
compared one by one.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from furlong.llm.anchors import Hashes, anchor_runs, covered, digests
from furlong.llm.common import cut_lineage, discard_tables, join_sized, pieces, text_bytes

PHRASE = 12
#: Text that is read at once; a longer one is read in parts.
CHUNK_BYTES = 1024 * 1024
#: Text of the documents of one shard, about.
SHARD_BYTES = 2 * 1024 * 1024
#: A stretch: hash of its phrase, digest of its words, windows in it, words before the phrase.
KEYS = ["p", "v0", "v1", "windows", "off"]
KEY_TYPES = "p long, v0 long, v1 long, windows int, off int"
NONE = ~np.uint64(0)
#: Stands for no id: such rows come after all others.
LAST = (1 << 63) - 1

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Words:
    """The words of some texts, joined by single spaces, and where each begins and ends."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray) -> None:
        inside = ~_IS_SPACE[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[offsets] = True
        starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
        stops = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
        sizes = stops - starts
        self.end = np.cumsum(sizes + 1) - 1
        self.begin = self.end - sizes
        self.data = np.full(int((sizes + 1).sum()), 0x20, np.uint8)
        place = np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)
        self.data[place] = raw[inside]
        # of each text the first word, and the one after its last
        self.first = np.searchsorted(starts, offsets[:-1])
        self.last = np.searchsorted(starts, offsets[1:])

    def run_hashes(self, k: int) -> np.ndarray:
        if len(self.begin) < k:
            return np.empty(0, np.uint64)
        return Hashes(self.data).of(self.begin[: len(self.begin) - k + 1], self.end[k - 1 :])


def _parts(raw: np.ndarray, length: int) -> Iterator[tuple[int, Words]]:
    """A long text in parts that overlap by ``length - 1`` words, with the number of each part's first word."""
    at, number = 0, 0
    while True:
        stop = min(at + CHUNK_BYTES, len(raw))
        while stop < len(raw) and not _IS_SPACE[raw[stop]]:
            stop += 1
        while True:
            words = Words(raw[at:stop], np.array([0, stop - at]))
            if stop == len(raw) or len(words.begin) >= 2 * length:
                break
            stop = min(stop + CHUNK_BYTES, len(raw))
            while stop < len(raw) and not _IS_SPACE[raw[stop]]:
                stop += 1
        yield number, words
        if stop == len(raw):
            return
        # the next part begins with the last length - 1 words of this one
        inside = ~_IS_SPACE[raw[at:stop]]
        starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
        step = len(starts) - (length - 1)
        number += step
        at += int(starts[step])


def _read(texts: pa.Array, length: int) -> list[tuple[int, Words]] | Iterator[tuple[int, Words]]:
    """The words of some texts, or of a single long one in parts."""
    raw, offsets = text_bytes(texts)
    # more than this only where it is a single long text
    return [(0, Words(raw, offsets))] if len(raw) <= CHUNK_BYTES or len(texts) > 1 else _parts(raw, length)


def _phrases(length: int):
    """Per batch the anchor phrases of all windows, each once per shard, with how often it was chosen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in pieces(batch, "text", CHUNK_BYTES):
                shards = some.column(0).to_numpy()
                for _, words in _read(some.column(1), length):
                    hashes = words.run_hashes(PHRASE)
                    runs = anchor_runs(hashes, words.first, words.last, PHRASE, length)
                    if not len(runs.anchor):
                        continue
                    # a part of a long text may choose a phrase at a place that the last one chose: counted twice, which
                    # at most confirms a phrase in vain
                    place, once = np.unique(runs.anchor, return_index=True)
                    shard, key = shards[runs.text[once]], hashes[place]
                    by = np.lexsort([key, shard])
                    new = np.concatenate([[True], (shard[by][1:] != shard[by][:-1]) | (key[by][1:] != key[by][:-1])])
                    heads = np.flatnonzero(new)
                    first = place[by][heads]
                    begin, size = words.begin[first], words.end[first + PHRASE - 1] - words.begin[first]
                    ends = np.concatenate([[0], np.cumsum(size)])
                    flat = words.data[np.arange(ends[-1]) + np.repeat(begin - ends[:-1], size)]
                    phrase = pa.LargeStringArray.from_buffers(
                        len(first), pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(flat.tobytes())
                    )
                    yield pa.RecordBatch.from_arrays(
                        [
                            phrase.cast(pa.string()), pa.array(key[by][heads].view(np.int64)), pa.array(shard[by][heads]),
                            pa.array(np.diff(np.append(heads, len(by)))),
                        ],
                        names=["phrase", "p", "shard", "n"],
                    )

    return run


class Automaton:
    """The recurring phrases of a shard; words are numbered as they come up, and a number is a letter to it."""

    FIRST, LETTERS = 0x10000, 0xF0000  # code points that text can hold

    def __init__(self, phrases: list[str], hashes: list[int]) -> None:
        self.numbers: dict[bytes, int] = {}
        self.automaton = ahocorasick.Automaton()
        for phrase, p in zip(phrases, hashes):
            self.automaton.add_word(self._letters(phrase.encode().split(b" ")), p)
        if phrases:
            self.automaton.make_automaton()

    def _letters(self, words: list[bytes]) -> str:
        numbers = self.numbers
        coded = [numbers.setdefault(word, len(numbers)) for word in words]
        return (np.array(coded, "<u4") % self.LETTERS + self.FIRST).astype("<u4").tobytes().decode("utf-32-le")

    def located(self, words: Words) -> np.ndarray:
        """For each word the hash of the phrase that begins there, or ``NONE``."""
        out = np.full(len(words.begin), NONE)
        if not self.numbers:
            return out
        # a word of no phrase is the last letter, whichever it is
        number = self.numbers.get
        coded = np.array([number(word, -1) for word in words.data.tobytes().split()], np.int64)
        coded = (np.where(coded < 0, self.LETTERS, coded % self.LETTERS) + self.FIRST).astype("<u4")
        for first, last in zip(words.first.tolist(), words.last.tolist()):
            if last - first >= PHRASE:
                text = coded[first:last].tobytes().decode("utf-32-le")
                for end, p in self.automaton.iter(text):
                    out[first + end - PHRASE + 1] = p % (1 << 64)
        if len(self.numbers) > self.LETTERS:  # different words share a letter
            hashes = np.append(words.run_hashes(PHRASE), np.full(min(PHRASE - 1, len(out)), NONE))
            out[out != hashes] = NONE
        return out


def _stretches(words: Words, hashes: np.ndarray, length: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Number of the text and description of each stretch of windows around a located phrase."""
    runs = anchor_runs(hashes, words.first, words.last, PHRASE, length)
    real = hashes[runs.anchor] != NONE if len(runs.anchor) else np.zeros(0, bool)
    anchor, first, last, text = (x[real] for x in runs)
    v0, v1 = digests(words.data, words.begin[first], words.end[last + length - 1])
    return text, {
        "p": hashes[anchor].view(np.int64), "v0": v0, "v1": v1, "windows": (last - first + 1).astype(np.int32),
        "off": (anchor - first).astype(np.int32), "at": first - words.first[text],
    }


def _located(length: int):
    """Of each document of a shard its words, and the stretches of windows that may recur.

    A shard's rows come in order: first its phrases, then its documents.
    """
    names = [*KEYS, "at"]
    kinds = [pa.int64()] * 3 + [pa.int32()] * 2 + [pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, shard_now, held = Automaton([], []), None, ([], [])
        for batch in batches:
            shard, phrase = batch.column(0).to_numpy(), batch.column("phrase")
            cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(shard) else []
            for begin, end in zip(cuts, [*cuts[1:], len(shard)]):
                if shard[begin] != shard_now:
                    automaton, shard_now, held = None, shard[begin], ([], [])
                part = batch.slice(int(begin), int(end - begin))
                is_phrase = part.column("phrase").is_valid()
                found = part.filter(is_phrase)
                held[0].extend(found.column("phrase").to_pylist())
                held[1].extend(found.column("p").to_pylist())
                documents = part.filter(pc.invert(is_phrase))
                if not documents.num_rows:
                    continue
                if automaton is None:
                    automaton, held = Automaton(*held), ([], [])
                for some in pieces(documents, "text", CHUNK_BYTES):
                    yield _document_rows(some, automaton)

    def _document_rows(some: pa.RecordBatch, automaton: Automaton) -> pa.RecordBatch:
        n_words, hashes = np.zeros(some.num_rows, np.int64), [hashlib.sha256() for _ in range(some.num_rows)]
        owner, found = [], []
        for number, words in _read(some.column("text"), length):
            text, fields = _stretches(words, automaton.located(words), length)
            fields["at"] = fields["at"] + number
            owner.append(text)
            found.append(fields)
            joined = memoryview(words.data)
            for i, (first, last) in enumerate(zip(words.first.tolist(), words.last.tolist())):
                new = first + max(int(n_words[i]) - number, 0)  # behind what the last part has
                if new < last:
                    if n_words[i]:
                        hashes[i].update(b" ")
                    hashes[i].update(joined[words.begin[new] : words.end[last - 1]])
                    n_words[i] += last - new
        columns = [pa.array(np.concatenate([f[name] for f in found]), kind) for name, kind in zip(names, kinds)]
        counts = np.bincount(np.concatenate(owner), minlength=some.num_rows)
        values = pa.StructArray.from_arrays(columns, names=names)
        stretches = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)
        # only texts with stretches are read again
        texts = pa.array([t if n else None for t, n in zip(some.column("text").to_pylist(), counts)], pa.string())
        return pa.RecordBatch.from_arrays(
            [some.column("id"), pa.array(n_words), pa.array([h.hexdigest() for h in hashes]), texts, stretches],
            names=["id", "n_words", "sha256", "text", "stretches"],
        )

    return run


def _windows(length: int):
    """Every window of the stretches wanted of each text, by its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in pieces(batch, "text", CHUNK_BYTES):
                wanted = some.column(1).to_pylist()
                for number, words in _read(some.column(0), length):
                    begins, owner = [], []
                    rows = [w for ws in wanted for w in ws]
                    bases = [int(f) - number for f, ws in zip(words.first, wanted) for _ in ws]
                    stops = [int(e) - length + 1 for e, ws in zip(words.last, wanted) for _ in ws]
                    for i, (w, base, stop) in enumerate(zip(rows, bases, stops)):
                        first, last = base + w["at"], min(base + w["at"] + w["windows"], stop)
                        first = max(first, 0)  # those before it are in an earlier part
                        if first < last:
                            begins.append(np.arange(first, last))
                            owner.append(np.full(last - first, i))
                    if not begins:
                        continue
                    at, row = np.concatenate(begins), np.concatenate(owner)
                    w0, w1 = digests(words.data, words.begin[at], words.end[at + length - 1])
                    place = at - np.array(bases)[row] - np.array([w["at"] for w in rows])[row]
                    columns = [np.array([w[k] for w in rows], np.int64)[row] for k in (*KEYS, "least")]
                    types = [pa.int64()] * 3 + [pa.int32()] * 2 + [pa.int64()]
                    yield pa.RecordBatch.from_arrays(
                        [*[pa.array(c).cast(t) for c, t in zip(columns, types)], pa.array(w0), pa.array(w1), pa.array(place)],
                        names=[*KEYS, "least", "w0", "w1", "place"],
                    )

    return run


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text without the words of its spans."""
    for batch in batches:
        n_removed, kept = [], []
        for text, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            words = text.encode().split()  # bytes: at 0x20 and 0x09-0x0D only
            gone = covered([(s["begin"], s["end"]) for s in spans])
            edges = [0, *[x for span in gone for x in span], len(words)]
            kept.append(b" ".join(w for b, e in zip(edges[::2], edges[1::2]) for w in words[b:e]))
            n_removed.append(sum(e - b for b, e in gone))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())],
            names=["id", "n_words", "n_removed", "kept"],
        )


def recurring_phrases(rows: DataFrame, length: int) -> DataFrame:
    """``shard``, ``phrase``, ``p``: the anchor phrases that were chosen more than once, for each shard that has them."""
    found = rows.select("shard", "text").mapInArrow(_phrases(length), "phrase string, p long, shard long, n long")
    # by partitions of the scan and shard: a document's phrases are in few batches, so little is left to combine
    found = cut_lineage(found, "phrases")
    counts = found.groupBy("phrase").agg(F.sum("n").alias("n"), F.count("*").alias("size")).filter("n > 1").drop("n")
    return join_sized(found.select("phrase", "p", "shard"), cut_lineage(counts, "recurring"), ["phrase"], "size")


def located_documents(docs: DataFrame, length: int) -> DataFrame:
    """Per row ``row``, ``id``, ``n_words``, ``sha256`` of its words, and where phrases recur its text and stretches.

    ``docs``: ``id`` and ``text``. The result is a written table; ``row`` numbers its rows.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = math.ceil(total / SHARD_BYTES) + 1
    rows = docs.withColumn("shard", F.pmod(F.xxhash64("id", "text"), F.lit(shards)))
    # a text this short has no window; such rows, a third of all perhaps, stay where they are
    has_window = F.coalesce(F.octet_length("text") >= 2 * length - 1, F.lit(False))
    phrases = recurring_phrases(rows.filter(has_window), length)
    no_text, no_phrase = F.lit(None).cast("string"), F.lit(None).cast("long")
    both = phrases.select("shard", F.lit(0).alias("kind"), "phrase", "p", no_phrase.alias("id"), no_text.alias("text")).unionByName(
        rows.filter(has_window).select("shard", F.lit(1).alias("kind"), no_text.alias("phrase"), no_phrase.alias("p"), "id", "text")
    )
    placed = both.repartition("shard").sortWithinPartitions("shard", "kind")
    short = rows.filter(~has_window).select(
        F.lit(-1).cast("long").alias("shard"), F.lit(1).alias("kind"), no_text.alias("phrase"), no_phrase.alias("p"), "id", "text"
    )
    out = f"id long, n_words long, sha256 string, text string, stretches array<struct<{KEY_TYPES}, at long>>"
    located = placed.mapInArrow(_located(length), out).unionByName(short.mapInArrow(_located(length), out))
    located = cut_lineage(located.withColumn("row", F.monotonically_increasing_id()), "located")
    discard_tables([phrases])  # the written tables that it reads
    return located


def passage_spans(located: DataFrame, length: int) -> DataFrame:
    """Per ``row`` the spans of words (``begin``, ``end``) that lie in a window which a smaller id has too."""
    rows = located.select("row", F.coalesce("id", F.lit(LAST)).alias("id"), F.explode("stretches").alias("s"))
    rows = cut_lineage(rows.select("row", "id", "s.*"), "stretches")
    variants = cut_lineage(
        rows.groupBy(*KEYS).agg(F.count("*").alias("rows"), F.min("id").alias("least"), F.min(F.struct("row", "at")).alias("place")),
        "variants",
    )
    groups = variants.groupBy("p").agg(F.count("*").alias("size")).filter("size > 1")
    groups = cut_lineage(groups, "groups")
    several = join_sized(variants, groups, ["p"], "size")
    wanted = several.groupBy(F.col("place.row").alias("row")).agg(  # at most what one text holds
        F.collect_list(F.struct(*KEYS, "least", F.col("place.at").alias("at"))).alias("wanted")
    )
    texts = located.filter("text IS NOT NULL").select("row", "text").join(wanted.hint("merge"), "row")
    windows = texts.select("text", "wanted").mapInArrow(
        _windows(length), f"{KEY_TYPES}, least long, w0 long, w1 long, place long"
    )
    windows = cut_lineage(windows, "windows")
    shared = windows.groupBy("w0", "w1").agg(F.min("least").alias("first"), F.max("least").alias("other"), F.count("*").alias("size"))
    shared = cut_lineage(shared.filter("first < other").drop("other"), "shared")
    more = (
        join_sized(windows, shared, ["w0", "w1"], "size")
        .filter("first < least")
        .groupBy(*KEYS)
        .agg(F.collect_list(F.struct("place", "first")).alias("earlier"))  # one per window at most
    )
    verdicts = variants.join(more, KEYS, "left").select(*KEYS, "rows", "least", "earlier")
    verdicts = cut_lineage(verdicts.filter("rows > 1 OR earlier IS NOT NULL"), "verdicts")
    discard_tables([variants, groups, windows, shared])
    hits = join_sized(rows, verdicts, KEYS, "rows")
    one_each = F.transform(
        F.filter(F.coalesce("earlier", F.array()), lambda e: e["first"] < F.col("id")),
        lambda e: F.struct((F.col("at") + e["place"]).alias("begin"), (F.col("at") + e["place"] + length).alias("end")),
    )
    whole = F.array(F.struct(F.col("at").alias("begin"), (F.col("at") + F.col("windows") - 1 + length).alias("end")))
    spans = F.when(F.col("least") < F.col("id"), whole).otherwise(one_each)
    return hits.select("row", F.explode(spans).alias("s")).select("row", "s.*")


def drop_passages(docs: DataFrame, length: int = 50, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, ``n_words``, ``n_removed``, ``kept`` and ``kept_sha256`` of every row of ``docs``.

    Words are separated by the bytes 0x20 and 0x09-0x0D and compared as they are. Removed is
    every word covered by a window of ``length`` words that also starts in a row with a
    smaller id; windows are judged on the input. ``kept``: the rest, joined by single spaces;
    null where nothing was removed. Null counts as no words; a text with fewer words than a
    window stays. Rows without an id come after all others: they lose what a row with an id
    has, and take nothing from any. Rows that repeat an id, with the same text or another,
    don't count as earlier than each other. Equality is that of 128-bit digests of the words.
    Other columns are neither read nor returned.
    """
    if length < 2 * PHRASE:
        raise ValueError(f"windows must have {2 * PHRASE} words at least")
    located = located_documents(docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text")), length)
    spans = passage_spans(located, length).groupBy("row").agg(
        F.collect_set(F.struct("begin", "end")).alias("spans")  # at most what one text holds
    )
    settled, spans = spans, cut_lineage(spans, "spans")
    discard_tables([settled])  # the written tables that it reads
    touched = located.filter("text IS NOT NULL").select("row", "id", "n_words", "text").join(spans.hint("merge"), "row")
    changed = touched.select("id", "n_words", "text", "spans").mapInArrow(
        _removed, "id long, n_words long, n_removed long, kept binary"
    )
    same = located.select("row", "id", "n_words", "sha256").join(spans.select("row"), "row", "left_anti")
    return changed.select(
        F.col("id").alias(id_column), "n_words", "n_removed", "kept", F.sha2("kept", 256).alias("kept_sha256")
    ).unionByName(
        same.select(
            F.col("id").alias(id_column), "n_words", F.lit(0).cast("long").alias("n_removed"),
            F.lit(None).cast("binary").alias("kept"), F.col("sha256").alias("kept_sha256"),
        )
    )
