import zlib
from collections import defaultdict

import pytest

from furlong.llm import kd_shards
from tests.llm.samples import empty, frame, odd_rows


def check(rows, found, shards):
    assert sorted(r["doc_id"] for r in found) == sorted(r[0] for r in rows)
    texts = {r[0]: (r[1] or "").encode() for r in rows}
    slots, crcs, sizes = defaultdict(list), defaultdict(set), defaultdict(int)
    for r in found:
        data = texts[r["doc_id"]]
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        slots[r["shard"]].append(r["slot"])
        crcs[data].add(r["shard"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))
    assert all(len(held) == 1 for held in crcs.values())  # equal texts stay together
    return sizes


def test_odd_rows(spark):
    rows = odd_rows()
    check(rows, kd_shards.shard_by_bytes(frame(spark, rows), shards=4).collect(), 4)


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_sizes_are_near_equal(spark, shards):
    # one source, one language and one length hold most rows: only the hash can split them
    rows = [(i, f"{i % 1500:0>300}", "en", "hot" if i % 3 else f"s{i % 7}", 300, 1, "", "") for i in range(2000)]
    sizes = check(rows, kd_shards.shard_by_bytes(frame(spark, rows), shards=shards).collect(), shards)
    mean = sum(sizes.values()) / shards
    assert len(sizes) == shards and all(abs(s - mean) < 0.03 * mean for s in sizes.values())


def test_medians_of_one_dimension_are_those_of_a_sorted_list(spark):
    rows = [(i, "x" * (i % 5), None, None, i, 1, "", "") for i in range(400)]
    found = kd_shards.shard_by_bytes(frame(spark, rows), shards=2, dims=["n_chars"]).collect()
    sizes = check(rows, found, 2)
    assert abs(sizes[0] - sizes[1]) <= max(sizes.values())  # 5 different texts: no finer cut


def test_target_bytes_and_the_rest(spark):
    rows = [(i, "x" * 99 + str(i), None, None, None, 1, "", "") for i in range(100)]
    found = kd_shards.shard_by_bytes(frame(spark, rows), target_bytes=2000).collect()
    assert len({r["shard"] for r in found}) == -(-sum(r["size"] for r in found) // 2000)
    assert kd_shards.shard_by_bytes(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        kd_shards.shard_by_bytes(empty(spark), shards=0)


def test_no_python_runs_in_tasks(spark):
    found = kd_shards.shard_by_bytes(frame(spark, odd_rows()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_texts_that_begin_alike_are_told_apart(spark):
    """URLs share their first bytes; the bytes behind those make the dimension."""
    rows = [(i, f"text {i} " + "x" * 50, "en", f"https://example.com/{'abcdefgh'[i % 8]}", 60, 1, "", "") for i in range(400)]
    groups = kd_shards.text_groups(frame(spark, rows), "doc_id", "text", ["source"])
    assert groups.select("d0").distinct().count() == 8
    placed = kd_shards.shard_by_bytes(frame(spark, rows), shards=8, dims=["source"]).collect()
    of = {}
    for r in placed:
        of.setdefault(r["shard"], set()).add("abcdefgh"[r["doc_id"] % 8])
    assert len(of) == 8 and sum(len(letters) for letters in of.values()) <= 16
