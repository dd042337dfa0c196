from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from furlong.llm import common
from furlong.llm.anchors import covered


@given(st.lists(st.integers(0, 4), max_size=60), st.lists(st.integers(1, 9), min_size=1, max_size=9), st.integers(1, 12))
@settings(max_examples=200, deadline=None)
def test_groups_come_whole(keys, sizes, least):
    keys = sorted(keys)
    rows = [{"k": k, "i": i} for i, k in enumerate(keys)]
    schema = pa.schema([("k", pa.int64()), ("i", pa.int64())])
    batches, at = [], 0
    while at < len(rows):
        size = sizes[len(batches) % len(sizes)]
        batches.append(pa.RecordBatch.from_pylist(rows[at : at + size], schema=schema))
        at += size
    tables = [t.to_pylist() for t in common.whole_groups(iter(batches), ["k"], least)]
    assert [r for t in tables for r in t] == rows
    seen = [{r["k"] for r in t} for t in tables]
    assert sum(len(s) for s in seen) == len(set(keys))


@given(st.lists(st.one_of(st.none(), st.text(max_size=30)), max_size=30), st.integers(1, 40))
@settings(max_examples=100, deadline=None)
def test_pieces_are_bounded_and_complete(texts, limit):
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    parts = list(common.pieces(batch, "text", limit))
    assert [t for p in parts for t in p.column(0).to_pylist()] == texts
    for part in parts:
        data, offsets = common.text_bytes(part.column(0))
        whole = [(t or "").encode() for t in part.column(0).to_pylist()]
        assert [data[a:b].tobytes() for a, b in zip(offsets, offsets[1:])] == whole
        assert sum(map(len, whole)) <= limit or len(whole) == 1 or not sum(map(len, whole[1:])) > limit


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_sized(spark, how):
    rows = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(3000)], "k long, v long")
    groups = rows.filter("k <> 9").groupBy("k").count().selectExpr("k", "k * 2 AS w", "count AS n")
    found = common.join_sized(rows, groups, ["k"], "n", how)
    expected = rows.join(groups.drop("n"), "k", how)
    assert found.columns == expected.columns
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, expected.collect()))


def test_covered():
    assert covered([(5, 9), (1, 3), (3, 4), (6, 7), (20, 21)]) == [(1, 4), (5, 9), (20, 21)] and covered([]) == []
