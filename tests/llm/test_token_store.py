import json
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from furlong.llm import token_store
from tests.llm.samples import ODD_SCHEMA, empty, frame, odd_rows

PATH = public_tokenizers.path("word_bpe_49k.json")


def library_ids(text):
    return Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def test_words_one_by_one_give_the_ids_of_whole_texts():
    texts = [r[1] or "" for r in odd_rows(count=20)]
    texts += ["It's  NOT\tso\n\x0bhard", "été É ǅ ﬁ İ", "a\xa0b c\x85d\x1ce", "中文 é ́", "x" * 300, "<|endoftext|> a<|startoftext|>b"]
    coded = token_store.WordIds(PATH).encode(texts)
    assert [np.frombuffer(c, "<u4").tolist() for c in coded] == [library_ids(t) for t in texts]


def test_a_tokenizer_that_keeps_white_space_reads_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    coder = token_store.WordIds(path)
    assert not coder.by_words and token_store.WordIds(PATH).by_words
    text = "It's  NOT\tso hard"
    assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == Tokenizer.from_file(path).encode(text).ids


def test_whether_words_can_be_encoded_one_by_one():
    """Decided by what the tokenizer says of itself: one that joins letters over a space is not split there."""
    with open(PATH, encoding="utf-8") as file:
        parts = json.load(file)
    assert token_store.splits_at_space(parts)
    joins = {"type": "Replace", "pattern": {"String": "q z"}, "content": "qz"}
    changed = [
        {"normalizer": {"type": "Sequence", "normalizers": [joins]}}, {"normalizer": joins}, {"pre_tokenizer": None},
        {"pre_tokenizer": {"type": "Split", "pattern": {"Regex": r"\s?[\p{L}]+"}, "behavior": "Removed", "invert": True}},
        {"pre_tokenizer": {"type": "Split", "pattern": {"Regex": r"[\p{L}]+"}, "behavior": "Isolated", "invert": False}},
        {"post_processor": {"type": "TemplateProcessing"}}, {"truncation": {"max_length": 5}},
        {"added_tokens": [{"content": "a b", "lstrip": False, "rstrip": False}]}, {"added_tokens": [{"content": "a", "lstrip": True, "rstrip": False}]},
    ]
    assert not any(token_store.splits_at_space(parts | change) for change in changed)
    assert token_store.splits_at_space(parts | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}})


def test_a_tokenizer_that_joins_words_reads_whole_texts(folder):
    with open(PATH, encoding="utf-8") as file:
        parts = json.load(file)
    parts["normalizer"]["normalizers"].append({"type": "Replace", "pattern": {"String": "q z"}, "content": "qz"})
    path = f"{folder}/joins.json"
    with open(path, "w", encoding="utf-8") as file:
        json.dump(parts, file)
    coder = token_store.WordIds(path)
    assert np.frombuffer(coder.encode(["a q z b"])[0], "<u4").tolist() == Tokenizer.from_file(path).encode("a q z b").ids


def test_files_hold_whole_texts_in_order(spark, folder):
    rows = odd_rows(count=30)
    token_store.write_tokens(frame(spark, rows), f"{folder}/t", PATH, end_id=1)
    stored = token_store.read_tokens(spark, f"{folder}/t")
    expected = sorted((r[0], library_ids(r[1] or "") + [1]) for r in rows)
    assert sorted((r["doc_id"], r["ids"]) for r in stored.collect()) == expected
    ids = [r["doc_id"] for r in spark.read.orc(f"{folder}/t").coalesce(1).collect()]
    assert len(ids) == len(rows)
    index = {}
    start = 0
    for doc_id, own in expected:
        index.setdefault(doc_id, (start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    found = sorted(tuple(r) for r in token_store.token_index(stored).collect())
    assert len(found) == len(rows) and {r[0]: r[1:] for r in reversed(found)} == index


def test_readers_pass_over_what_is_not_asked_for(spark, folder):
    rows = [(i, f"word {i}", None, None, 1, 1, "", "") for i in range(5000)]
    token_store.write_tokens(frame(spark, rows, 3), f"{folder}/t", PATH, end_id=None)
    some = token_store.read_tokens(spark, f"{folder}/t", ids=[7, 4000, 9999])
    assert Counter(r["doc_id"] for r in some.collect()) == Counter([7, 4000])
    assert "PushedFilters: [In(doc_id" in some._jdf.queryExecution().executedPlan().toString()
    part = token_store.read_tokens(spark, f"{folder}/t", between=(100, 109))
    assert sorted(r["doc_id"] for r in part.collect()) == list(range(100, 110))
    assert part.filter("ids IS NOT NULL").count() == 10


def test_nulls_and_an_empty_table(spark, folder):
    rows = [(None, "b", None, None, 1, 1, "", ""), (2, None, None, None, 1, 1, "", "")]
    token_store.write_tokens(spark.createDataFrame(rows, ODD_SCHEMA), f"{folder}/n", PATH)
    found = token_store.token_index(token_store.read_tokens(spark, f"{folder}/n")).orderBy("start").collect()
    assert [(r["doc_id"], r["n_tokens"]) for r in found] == [(None, len(library_ids("b")) + 1), (2, 1)]
    token_store.write_tokens(empty(spark), f"{folder}/e", PATH)
    assert token_store.token_index(token_store.read_tokens(spark, f"{folder}/e")).collect() == []


def test_new_words_reach_the_library_together():
    """A word is encoded once, whatever its case and the stop behind it, and many words make one text."""
    coder = token_store.WordIds(PATH)
    library, given = coder.tokenizer, []

    class Noting:
        def encode_batch(self, texts, **how):
            given.extend(texts)
            return library.encode_batch(texts, **how)

        def encode_batch_fast(self, texts, **how):
            given.extend(texts)
            return library.encode_batch_fast(texts, **how)

    coder.tokenizer = Noting()
    words = [f"wörd{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(500)] + ["so", "hard"]
    text = " ".join(words) + " So, HARD so. hard!"
    ids = np.frombuffer(coder.encode([text])[0], "<u4").tolist()
    assert len(given) < 20 and Counter(" ".join(given).split()) == Counter([*words, ",", ".", "!"])
    assert ids == library_ids(text)


def test_cut_lowered_and_joined_words_give_the_ids_of_whole_texts():
    odd = ["H̱ ẖ H̱.", "İ İI I", "x.'s X,'S it's! '", "U.S.'s a,b;C", "e;̸ ≠", "́a ́ á", "ÉTÉ. Été", "ǅ.ΑΣ ΣΑΣ, ß",
           "<|ENDOFTEXT|> <|endoftext|>, A<|StartOfText|>b.", "\x85A \xa0.b ", "\x1ca b\x1c\x1d C", "각 각 ᅡ", "…a. a… ﬁ, ①.", " \t", "", "."]
    rng = np.random.default_rng(3)
    signs = list("aAzH.,;'!? \t09-<|>") + ["́", "̱", "̇", "̸", "é", "É", "İ", "Σ", "中", "ᄀ", "ᅡ", "ᆨ", "ﬁ", "\xa0", "　", "𝐀", "👍"]
    odd += ["".join(rng.choice(signs, 40)) for _ in range(300)]
    coder = token_store.WordIds(PATH)
    expected = [coder.tokenizer.encode(text, add_special_tokens=False).ids for text in odd]
    assert [np.frombuffer(c, "<u4").tolist() for c in coder.encode(odd)] == expected
    for text, ids in zip(odd[:16], expected):
        assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == ids
    ended = coder.lists(pa.array([None, *odd, None], pa.string())[1:], 1)
    assert ended.to_pylist() == [ids + [1] for ids in [*expected, []]]
    assert coder.lists(pa.array([], pa.string()), 1).to_pylist() == []


def test_whether_words_can_be_cut_and_lowered():
    with open(PATH, encoding="utf-8") as file:
        parts = json.load(file)
    assert token_store.splits_after_letters(parts) and token_store.lowers_letters(parts)
    taken = {"type": "Split", "pattern": {"Regex": r"[^\s]+"}, "behavior": "Removed", "invert": True}
    assert not token_store.splits_after_letters(parts | {"pre_tokenizer": taken})
    assert not token_store.splits_after_letters(parts | {"pre_tokenizer": {"type": "WhitespaceSplit"}})
    assert not token_store.splits_after_letters(parts | {"added_tokens": [{"content": "a.b"}]})
    assert not token_store.lowers_letters(parts | {"normalizer": {"type": "NFC"}})
    assert not token_store.lowers_letters(parts | {"added_tokens": [{"content": "<|A|>"}]})
