import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from furlong.llm import suffix_array, suffix_dedup
from tests.llm.samples import empty, frame, odd_rows, rows_without_proper_ids


def brute(rows, length):
    count, texts = Counter(), []
    for doc_id, text, *_ in rows:
        data = (text or "").encode()
        texts.append((doc_id, data))
        count.update(data[s : s + length] for s in range(len(data) - length + 1))
    out = Counter()
    for doc_id, data in texts:
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            if count[data[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def found(df):
    return Counter(
        (r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in df.collect()
    )


@pytest.mark.parametrize("most, chunk", [(None, 1 << 20), (3, 700)])
def test_against_brute_force(spark, most, chunk, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", chunk)
    rnd = random.Random(2)
    shared = ["".join(rnd.choice("ab é") for _ in range(600)) for _ in range(4)]
    rows = []
    for i in range(120):
        base, a = rnd.choice(shared), rnd.randrange(400)
        own = ["".join(rnd.choice("abcdef") for _ in range(rnd.randrange(90))) for _ in range(2)]
        rows.append((i, own[0] + base[a : a + rnd.randrange(50, 300)] + own[1]))
    rows += [(200, "x" * 1000), (201, None), (202, ""), (203, "ab" * 700), (204, rows[3][1]), (3, rows[3][1])]
    rows = [(*r, None, None, 1, 1, "", "") for r in rows]
    assert found(suffix_dedup.drop_repeats(frame(spark, rows), 100, most=most)) == brute(rows, 100)


def test_odd_rows(spark):
    rows = odd_rows()
    rows += rows_without_proper_ids(rows)
    assert found(suffix_dedup.drop_repeats(frame(spark, rows), 200)) == brute(rows, 200)


def test_empty_table_and_short_strings(spark):
    assert suffix_dedup.drop_repeats(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        suffix_dedup.drop_repeats(empty(spark), 20)


@given(st.lists(st.integers(1, 4), max_size=60), st.sampled_from([2, 512]))
@settings(max_examples=300, deadline=None)
def test_suffix_array(symbols, buckets):
    before, suffix_array.BUCKETS = suffix_array.BUCKETS, buckets
    try:
        found_order = suffix_array.suffix_array(np.array([*symbols, 0])).tolist()
    finally:
        suffix_array.BUCKETS = before
    whole = [*symbols, 0]
    assert found_order == sorted(range(len(whole)), key=lambda i: whole[i:])


def test_long_runs_and_periods():
    for symbols in ([1] * 500, [1, 2] * 300, [3, 1, 2] * 200 + [3, 3]):
        whole = [*symbols, 0]
        assert suffix_array.suffix_array(np.array(whole)).tolist() == sorted(range(len(whole)), key=lambda i: whole[i:])


@pytest.mark.parametrize("length", [8, 13, 40])
def test_long_matches(length):
    rng = np.random.default_rng(4)
    part = rng.integers(0, 3, 60)
    data = np.concatenate([rng.integers(0, 3, 300), part, rng.integers(0, 3, 50), part]).astype(np.uint8)
    order = suffix_array.suffix_array(np.append(data.astype(np.int64) + 1, 0))
    starts = np.arange(len(data) - length + 1)
    windows = [data[s : s + length].tobytes() for s in starts]
    count = Counter(windows)
    assert suffix_array.long_matches(data, order, starts, length).tolist() == [count[w] > 1 for w in windows]
