import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from furlong.llm import simhash
from furlong.llm.components import components
from tests.llm.samples import empty, frame, odd_rows, rows_without_proper_ids


def brute_fingerprint(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << k for k in range(64) if sum(h >> k & 1 for h in hashes) * 2 > len(hashes))


def brute_groups(marks, ids, max_bits):
    """The smallest id that each mark reaches; one that is missing counts as infinite."""
    near = np.bitwise_count(marks[:, None] ^ marks[None, :]) <= max_bits
    found = np.array([np.inf if i is None else i for i in ids])
    while True:
        new = np.array([found[row].min() for row in near])
        if (new == found).all():
            return found
        found = new


@pytest.mark.parametrize("width, max_bits", [(4, 4), (2, 9)])
def test_against_brute_force(spark, width, max_bits):
    rows = odd_rows()
    rows += rows_without_proper_ids(rows)
    marks = np.array([brute_fingerprint(r[1], width) for r in rows], np.uint64)
    reached = brute_groups(marks, [r[0] for r in rows], max_bits)
    expected = Counter((r[0], f"{int(m):016x}", None if c == np.inf else int(c)) for r, m, c in zip(rows, marks, reached))
    found = simhash.near_groups(frame(spark, rows), width=width, max_bits=max_bits).collect()
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in found) == expected
    kept = simhash.drop_near_copies(frame(spark, rows), width=width, max_bits=max_bits).collect()
    assert Counter(r["doc_id"] for r in kept) == Counter(i for i, _, c in expected.elements() if i == c)


def clusters(seed=1, centres=30, members=50):
    rng = np.random.default_rng(seed)
    marks = set()
    for centre in rng.integers(0, 1 << 63, centres, np.uint64):
        for _ in range(members):
            mark = int(centre) * 2
            for bit in rng.integers(0, 64, rng.integers(0, 6)):
                mark ^= 1 << int(bit)
            marks.add(mark)
    return np.array(sorted(marks), np.uint64)


def gray_rank(marks):
    rank = marks.copy()
    for step in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(step)
    return rank


def in_gray_order(marks):
    return marks[np.argsort(gray_rank(marks))]


@pytest.mark.parametrize("block", [64, 5000])
def test_tree_finds_all_groups(block):
    marks = in_gray_order(clusters())
    assert (simhash.node_labels(marks, 4, block) == brute_groups(marks, np.arange(len(marks)), 4)).all()


@pytest.mark.parametrize("block", [64, 5000])
def test_one_tree_over_several_upper_nodes(block):
    parts = [in_gray_order(clusters(seed, centres, members)) for seed, centres, members in ((1, 5, 50), (2, 1, 2), (3, 40, 1), (4, 1, 1))]
    starts = np.cumsum([0, *map(len, parts)])
    seen = []
    labels = simhash.node_labels(np.concatenate(parts), 4, block, starts[:-1], seen)
    for part, start in zip(parts, starts):
        assert (labels[start : start + len(part)] == start + brute_groups(part, np.arange(len(part)), 4)).all()
    assert seen[0] > seen[1] > 0 and (block > 1000 or seen[2] > 0)


def test_the_tree_prunes_on_given_texts(spark):
    """All fingerprints of the largest local table under the first mask: most nodes looked at are left out by their differences."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    marks = simhash.fingerprints(docs, "doc_id", "text", 4).select("fp").distinct().toPandas()["fp"].to_numpy().view(np.uint64)
    mask = np.uint64(simhash._block_masks((1 << 64) - 1, 6)[0])
    order = np.lexsort([gray_rank(marks), marks & mask])
    marks = marks[order]
    starts = np.flatnonzero(np.concatenate([[True], (marks[1:] & mask) != (marks[:-1] & mask)]))
    seen = []
    labels = simhash.node_labels(marks, 4, starts=starts, seen_nodes=seen)
    assert (labels != np.arange(len(marks))).any() and seen[0] / 2 < seen[1] < seen[0]


@pytest.mark.parametrize("limit", [150, None])
def test_large_nodes_are_divided(spark, limit):
    low = np.random.default_rng(3).integers(0, 1 << 24, 500, np.uint64)
    marks = np.unique(low) | np.uint64(0xABCDEF0123 << 24)
    nodes = spark.createDataFrame([(int(m.view(np.int64)), i) for i, m in enumerate(marks)], "fp long, id long")
    found = {r["id"]: r["component"] for r in components(simhash.near_links(nodes, 4, limit), "a", "b").collect()}
    expected = brute_groups(marks, np.arange(len(marks)), 4)
    assert [found.get(i, i) for i in range(len(marks))] == expected.tolist()


def test_components_of_a_chain_a_star_and_a_loop(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}, 201: 200}


def test_empty_table(spark):
    assert simhash.near_groups(empty(spark)).collect() == []
