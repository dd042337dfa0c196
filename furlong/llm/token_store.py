"""Token ids in ORC files, in ascending order of document ids.

Ids are an integer column, so ORC's integer run-length encoding packs them; row indexes
and Bloom filters on the document id let a reader pass over stripes and row groups that
hold none of the documents asked for, and each stripe can be read by a task of its own.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from operator import itemgetter
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from furlong.llm.common import Recent, cut_lineage, once_per_worker, pieces, text_bytes
from furlong.operators.skew import running_totals

STRIPE_BYTES = 16 * 1024 * 1024
ROWS_PER_INDEX_ENTRY = 1_000
CHUNK_BYTES = 8 * 1024 * 1024
KEPT_WORDS = 300_000
LONGEST_KEPT = 64
#: Words that the library is given as one text.
WORDS_A_TEXT = 128
# ASCII white space only: whatever else a tokenizer may take for white space stays inside a word
SPACES = " \t\n\r\f\v"
STOPS = ".,;:!?"


def splits_at_space(parts: dict[str, Any]) -> bool:
    """Whether a tokenizer's description says that it drops white space, and that no id depends on what lies beyond it.

    Known to be so: normalisers that work on single characters and their marks (NFC and the
    like, lower case, runs of white space as one space), a pre-tokenizer whose first step takes
    pieces without white space by a pattern and drops the rest, and no step after the model.
    """
    steps = _normalizers(parts)
    spaces = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    if any(step["type"] not in ("NFC", "NFD", "NFKC", "NFKD", "Lowercase") and step != spaces for step in steps):
        return False
    first = _first_split(parts)
    if first["type"] in ("Whitespace", "WhitespaceSplit"):
        drops = True
    elif first["type"] == "Split" and first.get("behavior") == "Removed" and first.get("invert"):
        drops = all(_takes_no_space(choice) for choice in first["pattern"].get("Regex", " ").split("|"))
    else:
        drops = False
    added = all(not re.search(r"\s", token["content"]) and not token["lstrip"] and not token["rstrip"] for token in parts.get("added_tokens", []))
    model = parts["model"]
    lasting = not model.get("dropout") and not model.get("fuse_unk")
    return drops and added and lasting and not any(parts.get(step) for step in ("post_processor", "truncation", "padding"))


def _takes_no_space(choice: str) -> bool:
    """Whether a choice of a pattern is plain letters, or classes of letters, numbers, or what is none of these and no space."""
    return bool(re.fullmatch(r"[A-Za-z']+|(\[(\\p\{[LN]\})+\]\+?|\[\^\\s(\\p\{[LN]\})*\]\+?)", choice))


def splits_after_letters(parts: dict[str, Any]) -> bool:
    """Whether a tokenizer that ``splits_at_space`` also splits between an ASCII letter and a stop (one of ``STOPS``), always.

    So it does where no choice of its pattern takes both; no normaliser named there joins the two.
    """
    first = _first_split(parts)
    if first["type"] == "Split":
        apart = all("\\p{L}" in choice for choice in first["pattern"]["Regex"].split("|") if choice.startswith("[^"))
    else:
        apart = first["type"] == "Whitespace"  # \w+|[^\w\s]+
    return apart and not any(set(STOPS) & set(token["content"]) for token in parts.get("added_tokens", []))


def lowers_letters(parts: dict[str, Any]) -> bool:
    """Whether a tokenizer that ``splits_at_space`` gives A-Z the ids of a-z, but for those before a mark and in added tokens."""
    added = all(token["content"] == token["content"].lower() for token in parts.get("added_tokens", []))
    return added and any(step["type"] == "Lowercase" for step in _normalizers(parts))


def _normalizers(parts: dict[str, Any]) -> list[dict[str, Any]]:
    normalizer = parts.get("normalizer") or {"type": "Sequence", "normalizers": []}
    return normalizer["normalizers"] if normalizer["type"] == "Sequence" else [normalizer]


def _first_split(parts: dict[str, Any]) -> dict[str, Any]:
    before = parts.get("pre_tokenizer") or {"type": None}
    return (before["pretokenizers"] or [{"type": None}])[0] if before["type"] == "Sequence" else before


class WordIds:
    """Ids of whole texts by the tokenizers library.

    For a tokenizer that drops white space and splits at it (``splits_at_space``), a text's
    ids are those of its words one after the other, so each different word is encoded once; a
    bounded number is kept. Where the tokenizer also splits between letters and stops or
    lowers letters, words are cut there and lowered first, which leaves fewer different ones.
    Texts of any other are encoded whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel ones
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self.by_words = splits_at_space(parts)
        self.cuts = self.by_words and splits_after_letters(parts)
        self.lowers = self.by_words and lowers_letters(parts)
        self.added = [token["content"].encode() for token in parts.get("added_tokens", [])]
        self.kept = Recent(KEPT_WORDS, LONGEST_KEPT)

    def _encode_all(self, texts: list[str]) -> Iterator[bytes]:
        for start in range(0, len(texts), 4096):
            for coded in self.tokenizer.encode_batch_fast(texts[start : start + 4096], add_special_tokens=False):
                yield array("I", coded.ids).tobytes()

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Per word its ids. Words of ASCII, or of letters and then stops, go many to a text; where a token begins tells its word.

        Others may hold marks, which a normaliser may join with what is before them or move: they are encoded one by one.
        """
        joined = [word.isascii() or word.rstrip(STOPS).isalpha() for word in words]
        alone = self._encode_all([word for word, together in zip(words, joined) if not together])
        some = [word for word, together in zip(words, joined) if together]
        together = (ids for start in range(0, len(some), 4096) for ids in self._encode_joined(some[start : start + 4096]))
        return [next(together) if j else next(alone) for j in joined]

    def _encode_joined(self, words: list[str]) -> list[bytes]:
        texts = [" ".join(words[start : start + WORDS_A_TEXT]) for start in range(0, len(words), WORDS_A_TEXT)]
        ids, begins, before = array("I"), [], 0
        for text, coded in zip(texts, self.tokenizer.encode_batch(texts, add_special_tokens=False)):
            ids.extend(coded.ids)
            begins.append(np.fromiter(map(itemgetter(0), coded.offsets), np.int64, len(coded)) + before)
            before += len(text) + 1
        firsts = np.cumsum([0] + [len(word) + 1 for word in words])
        cuts = (np.searchsorted(np.concatenate(begins), firsts) * 4).tolist()
        blob = ids.tobytes()
        return [blob[a:b] for a, b in zip(cuts, cuts[1:])]

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of texts, lowered where that changes no id, and where words begin, each with the white space before it."""
        if self.lowers:
            capital = (data - np.uint8(ord("A"))) < 26
            capital[:-1] &= data[1:] < 128  # a mark may follow that joins with one case alone
            lowered = data | (capital.view(np.uint8) << 5)
            whole = lowered.tobytes()
            if not any(token in whole for token in self.added):
                data = lowered
        kind = np.zeros(256, np.uint8)
        kind[list(SPACES.encode())], kind[list(STOPS.encode())] = 1, 2
        letter = np.zeros(256, bool)
        letter[[*range(65, 91), *range(97, 123)]] = self.cuts
        kinds = kind[data]
        space = kinds == 1
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[1:] |= (kinds[1:] == 2) & letter[data[:-1]]
        begins[offsets[:-1][offsets[:-1] < len(data)]] = True
        return data, np.flatnonzero(begins)

    def lists(self, texts: pa.Array, end_id: int | None = None) -> pa.ListArray:
        """Per text its ids, and ``end_id`` after them. Null counts as empty."""
        end = b"" if end_id is None else array("I", [end_id]).tobytes()
        if not self.by_words:
            return _id_lists([ids + end for ids in self._encode_all([text or "" for text in texts.to_pylist()])])
        data, offsets = text_bytes(texts)
        data, begins = self._cut(data, offsets)
        ends = np.searchsorted(begins, offsets[1:])
        buffers = [None, pa.py_buffer(np.append(begins, len(data))), pa.py_buffer(data)]
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), buffers).dictionary_encode()
        del data, begins, buffers  # not held while words are encoded
        words = pc.ascii_ltrim(found.dictionary.cast(pa.large_string()), SPACES).to_numpy(zero_copy_only=False).tolist()
        known = self.kept.of(set(words), self._encode_words)
        vocabulary = _id_lists([*map(known.__getitem__, words), end])
        # an end after each text's words
        places = np.insert(found.indices.to_numpy(), ends, len(words))
        ids = vocabulary.take(pa.array(places))
        ends = np.append(0, ends + np.arange(1, len(ends) + 1))
        return pa.ListArray.from_arrays(pa.array(ids.offsets.to_numpy()[ends]), ids.values)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as little-endian 32-bit integers."""
        ids = self.lists(pa.array(texts, pa.large_string()))
        data, ends = ids.values.to_numpy().tobytes(), ids.offsets.to_numpy() * 4
        return [data[a:b] for a, b in zip(ends, ends[1:])]


def _id_lists(blobs: list[bytes]) -> pa.ListArray:
    """Ids from their little-endian bytes."""
    offsets = np.cumsum([0, *map(len, blobs)]) // 4
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.frombuffer(b"".join(blobs), "<i4")))


def word_ids(path: str) -> WordIds:
    """The tokenizer of a file, read once per worker."""
    return once_per_worker(("token_store", path), lambda: WordIds(path))


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int | None = 1,
    id_column: str = "doc_id",
    text: str = "text",
    stripe_bytes: int = STRIPE_BYTES,
) -> None:
    """Encode whole texts and write ``<id_column>`` and ``ids`` to ORC files at ``path``, in order of the id.

    ``end_id`` is appended to each document's ids. Null counts as empty; rows that repeat an
    id follow each other, and rows without an id come first. Texts, not ids, are shuffled
    into order: they are smaller. An empty table writes a folder without rows. Other columns
    are not written.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_ids(tokenizer)
        for batch in batches:
            for some in pieces(batch, "__text", CHUNK_BYTES):
                ids = coder.lists(some.column(1), end_id)
                yield pa.RecordBatch.from_arrays([some.column(0), ids], names=["__id", "ids"])

    rows = docs.select(F.col(id_column).cast("long").alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    ordered = rows.repartitionByRange("__id").sortWithinPartitions("__id", "__text")
    encoded = ordered.mapInArrow(run, "__id long, ids array<int>").withColumnRenamed("__id", id_column)
    (
        encoded.write.option("orc.bloom.filter.columns", id_column)
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.stripe.size", str(stripe_bytes))
        .option("orc.row.index.stride", str(ROWS_PER_INDEX_ENTRY))
        .option("orc.compress", "zstd")
        .orc(path)
    )


def read_tokens(
    spark: SparkSession, path: str, ids: list[int] | None = None, between: tuple[int, int] | None = None, id_column: str = "doc_id"
) -> DataFrame:
    """The stored documents, or those with the given ids or in a range of ids (ends included).

    Both conditions reach the ORC reader, which checks file, stripe and row group statistics
    and Bloom filters before it decodes any ids.
    """
    table = spark.read.schema(f"`{id_column}` long, ids array<int>").orc(path)
    if ids is not None:
        table = table.filter(F.col(id_column).isin(ids))
    if between is not None:
        table = table.filter(F.col(id_column).between(*between))
    return table


def token_index(tokens: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per stored document: id, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``.

    The checksum is of the ids as little-endian unsigned 32-bit integers. Documents with
    equal ids are ordered by length and checksum.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            data, ends = column.values.to_numpy().astype("<u4").tobytes(), column.offsets.to_numpy()
            view = memoryview(data)
            sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(ends, ends[1:])]
            counts = np.diff(ends).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts), pa.array(sums, pa.int64())], names=["__id", "n_tokens", "ids_crc32"]
            )

    rows = tokens.select(F.col(id_column).alias("__id"), "ids").mapInArrow(run, "__id long, n_tokens long, ids_crc32 long")
    # sorting looks at its input twice: at these few numbers, not at the files
    rows = cut_lineage(rows, "token-counts")
    placed = running_totals(rows, ["__id", "n_tokens", "ids_crc32"], {"start": "n_tokens"})
    return placed.select(F.col("__id").alias(id_column), "start", "n_tokens", "ids_crc32")
