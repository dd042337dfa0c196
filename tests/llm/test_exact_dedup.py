from collections import Counter, defaultdict
import hashlib

import pytest
from hypothesis import given, settings, strategies as st

from furlong.llm import exact_dedup
from tests.llm.samples import empty, frame, odd_rows, rows_without_proper_ids

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out.update((i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids)
    return out


@pytest.mark.parametrize("slice_bytes", [16 << 20, 3000])
def test_against_brute_force(spark, slice_bytes, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SLICE_BYTES", slice_bytes)
    if slice_bytes < 5000:
        monkeypatch.setattr(exact_dedup, "LEAST_PER_SLICE", 2)
    # many copies, and texts of one length and one beginning, which need several rounds
    many = [(1000 + i, ("Ab" * 100, "ab" * 100, "ab" * 90 + f"{i % 7:020d}")[i % 3], None, None, 0, 0, "", "") for i in range(200)]
    rows = odd_rows() + many
    rows += rows_without_proper_ids(rows)
    found = exact_dedup.equal_texts(frame(spark, rows, 9)).collect()
    assert Counter(tuple(r) for r in found) == brute(rows)


def test_empty_table_and_null_ids(spark):
    assert exact_dedup.equal_texts(empty(spark)).collect() == []
    rows = [(None, "a", None, None, 1, 1, "", ""), (1, "a", None, None, 1, 1, "", "")]
    found = [tuple(r)[:4] for r in exact_dedup.equal_texts(frame(spark, rows)).collect()]
    assert sorted(found, key=str) == [(1, 1, 2, True), (None, 1, 2, False)]
    assert [r["doc_id"] for r in exact_dedup.drop_equal_texts(frame(spark, rows)).collect()] == [1]
    alone = [(None, "b", None, None, 1, 1, "", "")] * 2
    assert exact_dedup.drop_equal_texts(frame(spark, alone)).count() == 2


def test_an_id_with_two_texts(spark):
    rows = [(i, t, None, None, 1, 1, "", "") for i, t in ((1, "alpha"), (1, "beta"), (2, "alpha"), (3, "beta"))]
    found = sorted(tuple(r)[:4] for r in exact_dedup.equal_texts(frame(spark, rows)).collect())
    assert found == [(1, 2, 2, False), (1, 3, 2, False), (2, 2, 2, True), (3, 3, 2, True)]
    left = exact_dedup.drop_equal_texts(frame(spark, rows)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in left) == [(2, "alpha"), (3, "beta")]


def test_rows_that_stay_keep_their_columns(spark):
    rows = odd_rows()
    left = exact_dedup.drop_equal_texts(frame(spark, rows).withColumnRenamed("n_chars", "__0"))
    assert left.columns == ["doc_id", "text", "lang", "source", "__0", "id", "rep", "n"]
    keep = {i for i, _, _, kept, _ in brute(rows) if kept}
    assert {r["doc_id"] for r in left.collect()} == keep


@given(st.lists(st.binary(max_size=40), max_size=30))
@settings(max_examples=60, deadline=None)
def test_radix_groups(texts):
    texts = texts + texts[:3]
    groups = {frozenset(g) for g in exact_dedup._by_length(texts)}
    by_text = defaultdict(set)
    for i, text in enumerate(texts):
        by_text[text].add(i)
    assert groups == {frozenset(g) for g in by_text.values() if len(g) > 1}
