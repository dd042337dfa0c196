import numpy as np
import pytest

from furlong.llm import kd_search

SCHEMA = "vec_id long, embedding array<double>, label int, id long, v string, score int"


def brute(rows, queries, k):
    def usable(v):
        return v and all(x is not None and np.isfinite(x) and abs(x) * 1024 <= (2**62 / len(v)) ** 0.5 for x in v)

    whole = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v, *_ in rows if i is not None and usable(v)]
    out = []
    for q, v in dict(sorted(((i, v) for i, v in whole if i in queries), reverse=True)).items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q and len(w) == len(v))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.fixture
def rows():
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=6).round(2).tolist(), i % 3, 1, "x", 5) for i in range(700)]
    rows += [(700 + i, rows[i % 4][1], 0, 1, "x", 5) for i in range(60)]  # ties
    odd = [None, [], [None] * 6, [float("nan")] * 6, [float("inf")] * 6, [1.0] * 5, [2.0] * 5, [1e9] * 6, [0.0] * 6]
    rows += [(800 + i, v, None, None, None, None) for i, v in enumerate(odd)]
    return rows + [rows[3], (None, [1.0] * 6, 1, 1, "", 1)]


@pytest.mark.parametrize("shard_rows, block", [(4096, 4096), (128, 3)])
def test_against_brute_force(spark, rows, shard_rows, block, monkeypatch):
    monkeypatch.setattr(kd_search, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(kd_search, "QUERY_BLOCK", block)
    monkeypatch.setattr(kd_search.index_shards, "__defaults__", (shard_rows, 16))
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(3)
    asked = vectors.filter("vec_id % 100 = 0 OR vec_id >= 799 OR vec_id = 3")
    queries = {r["vec_id"] for r in asked.collect()}
    found = kd_search.top_k(vectors, asked, k=7).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, queries, 7)


def test_too_large_for_doubles_is_still_exact(spark):
    rows = [(i, [2.0**40 + i, float(i)], None, 1, "", 1) for i in range(50)]
    vectors = spark.createDataFrame([(i, [x / 2**20 for x in v], *r) for i, v, *r in rows], SCHEMA)
    small = kd_search.top_k(vectors, vectors.filter("vec_id = 0"), k=3).collect()
    assert sorted(tuple(r) for r in small) == brute([(i, [x / 2**20 for x in v], *r) for i, v, *r in rows], {0}, 3)


def test_vectors_whose_scores_do_not_fit_a_long_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, [1e18, 2.0]), (2, [-1e18, 3.0]), (3, [1e-300, 4.0]), (100, [2.0**20, 2.0**20]), (200, [2.0**20, 2.0**20])]
    vectors = spark.createDataFrame([(i, v, 0, 1, "", 1) for i, v in rows], SCHEMA)
    found = kd_search.top_k(vectors, vectors.filter("vec_id % 100 = 0"), k=9).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, {0, 100, 200}, 9)
    assert {r["vec_id"] for r in found} == {0, 3, 100, 200} and max(r["score"] for r in found) == 2**61


def test_few_rows_and_none(spark):
    vectors = spark.createDataFrame([(0, [1.0], 1, 1, "", 1), (1, [2.0], 1, 1, "", 1)], SCHEMA)
    assert [tuple(r) for r in kd_search.top_k(vectors, vectors.filter("vec_id = 0")).collect()] == [(0, 1, 1, 2 * 1024 * 1024)]
    nothing = vectors.filter("false")
    assert kd_search.top_k(nothing, nothing).collect() == []
    assert kd_search.top_k(vectors, nothing).collect() == []


def test_search_leaves_out_most_nodes():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 8)) * 4000
    values = np.floor(np.repeat(centres, 100, axis=0) + rng.normal(size=(4000, 8)) * 50)
    order, nodes = kd_search.build_tree(values, 50)
    assert sorted(order.tolist()) == list(range(4000))
    leaves = nodes[nodes[:, 2] < 0]
    assert leaves[:, 0].tolist() != [] and (leaves[:, 1] - leaves[:, 0]).max() <= 50
    values = values[order]
    low, high = (np.array([f(values[b:e]) for b, e, _ in nodes]) for f in (lambda x: x.min(0), lambda x: x.max(0)))
    shard = {
        "width": 8, "ids": np.arange(4000), "vectors": values.tobytes(), "nodes": nodes.tobytes(),
        "low": low.tobytes(), "high": high.tobytes(),
    }
    visits = []

    class Counted(kd_search.Best):
        def add(self, query, ids, scores):
            visits.append(len(ids))
            super().add(query, ids, scores)

    query = values[:1]
    best = Counted(10, 1)
    kd_search.search_shard(best, np.array([0]), query, np.array([-1]), shard)
    scores = values @ query[0]
    assert best.scores[0].tolist() == sorted(scores.tolist(), reverse=True)[:10]
    assert sum(visits) < 1500


def test_given_table_against_sql(spark, sf_dir):
    from furlong.llm import bindings
    from tests.compare import connect, duck_rows, spark_rows

    found = spark_rows(bindings.QUERIES["op5_kd_search"](spark, sf_dir))
    assert found == duck_rows(connect(sf_dir), bindings.ORACLE["op5_kd_search"]) and found[1]
