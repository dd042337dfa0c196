import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from furlong.llm import token_counts
from tests.llm.samples import ODD_SCHEMA, empty, frame, odd_rows

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
COUNTER = token_counts.Counter(PATH)

ODD = [
    "", " ", "  ", "   a", " a  b   ", "▁", "▁▁x▁ y", "a\tb\n\nc\r\n d", "é￿\0z", "<s> </s><unk> <0x0A>",
    "x" * 3000, " " * 700 + "end", "ab" * 2000, "\n" * 50, "中文字符 日本語", "🤗👩‍🚀 ok", "a" * 17 + " " * 33 + "b",
]


def library(texts):
    return [len(ids) for ids in LIBRARY.encode(texts, num_threads=1)]


def made(seed=3, count=1500):
    """Texts of pieces in random order, so that pairs meet which no training text had."""
    rnd = random.Random(seed)
    names = [LIBRARY.id_to_piece(i) for i in range(259, 32000)]
    return ["".join(rnd.choice(names[: rnd.choice([300, 3000, 31000])]) for _ in range(rnd.randrange(12))) for _ in range(count)]


@pytest.mark.parametrize("rounds", [0, 1, 3, 200])
def test_counts_are_the_librarys(rounds, monkeypatch):
    monkeypatch.setattr(token_counts, "ROUNDS", rounds)
    texts = ODD + made()
    assert token_counts.Counter(PATH).count(texts) == library(texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aaabb thein  ▁\n\tTH.,é中🤗\0"), max_size=40), max_size=6))
def test_any_text(texts):
    assert COUNTER.count(texts) == library(texts)


def test_what_is_forgotten_is_counted_again(monkeypatch):
    monkeypatch.setattr(token_counts, "KEPT", 50)
    monkeypatch.setattr(token_counts, "LONGEST_KEPT", 4)
    monkeypatch.setattr(token_counts, "BATCH_CHARS", 100)
    own, texts = token_counts.Counter(PATH), made(seed=4, count=300)
    for start in range(0, 300, 20):
        assert own.count(texts[start : start + 20]) == library(texts[start : start + 20])


def test_every_row_has_its_count(spark):
    rows = odd_rows() + [(None, "no id", None, None, 1, 1, "", ""), (900, None, None, None, 1, 1, "", "")]
    found = token_counts.count_tokens(frame(spark, rows), PATH, limit=100)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    expected = [(r[0], len((r[1] or "").encode()), n, n > 100) for r, n in zip(rows, library([r[1] or "" for r in rows]))]
    assert Counter(tuple(r) for r in found.collect()) == Counter(expected)
    assert any(n[3] for n in expected)


def test_clashing_names_and_an_empty_table(spark):
    rows = [(1, "a b", "x", "y", 1, 1, "", "z")]
    odd = spark.createDataFrame(rows, ODD_SCHEMA).selectExpr("*", "1 AS __id", "2 AS __text", "3 AS n_bytes", "4 AS n_tokens")
    assert [tuple(r) for r in token_counts.count_tokens(odd, PATH, limit=1).collect()] == [(1, 3, 2, True)]
    assert token_counts.count_tokens(empty(spark), PATH, limit=1).collect() == []


def test_nothing_is_shuffled(spark):
    plan = token_counts.count_tokens(frame(spark, odd_rows(count=20)).coalesce(1), PATH, limit=1)
    assert plan._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
