import random

import pytest
from pyspark.sql import functions as F

from furlong.llm import quality
from tests.llm.samples import empty, frame, odd_rows

LABELS = "doc_id long, quality int, toxic int"


def corpus(count=900, seed=3):
    rnd = random.Random(seed)
    words = [f"{a}{b}" for a in ("al", "be", "ca", "do", "en", "fi") for b in ("m", "ne", "po", "qu", "ro", "st", "ul")]
    rows, truth = [], []
    for i in range(count):
        text = [rnd.choice(words) for _ in range(rnd.randrange(20, 120))]
        good, toxic = int(i % 7 != 0), int(i % 9 == 0)
        if not good:
            text = [w.upper() + "!!" for w in text] if i % 4 < 2 else [w + "%%%" for w in text]
        if toxic:
            text[5:5] = [rnd.choice(["vile", "nasty", "foul"]) for _ in range(3)]
        host = "bad" if i % 7 == 0 and i % 3 else f"s{i % 5}"
        rows.append((i, " ".join(text), "en" if i % 4 else None, host, len(text), 1, "", ""))
        truth.append((i, good, toxic))
    return rows, truth


@pytest.fixture(scope="module")
def scored(spark):
    rows, truth = corpus()
    labels = spark.createDataFrame(truth[::2] + [(3, None, None), (None, 1, 1), (truth[2][0], None, truth[2][2])], LABELS)
    out = quality.classify(frame(spark, rows), labels)
    return out, rows, truth


def test_held_out_accuracy(scored):
    out, rows, truth = scored
    found = {r["doc_id"]: r for r in out.collect()}
    assert len(found) == len(rows)
    held_out = truth[1::2]
    clean = [found[i]["kept"] for i, good, toxic in held_out if good and not toxic]
    rejected = [not found[i]["kept"] for i, good, toxic in held_out if toxic or not good]
    assert sum(clean) >= 0.99 * len(clean) and sum(rejected) >= 0.97 * len(rejected)
    assert all(0 <= found[i][c] <= 1 for i in found for c in ("quality_score", "toxic_score", "site_quality", "site_toxic"))


def test_sparse_sites_are_shrunk_to_their_hosts(spark):
    many = [("big", "a", 0.9)] * 300 + [("big", "b", 0.1)] * 2 + [("small", "a", 0.1)] * 2 + [(f"h{i}", "a", 0.5 + i / 50) for i in range(20)] * 30
    rows = spark.createDataFrame(many, "host string, path string, p_x double")
    sites, means = quality.site_posteriors(rows, "host", "path", ["x"])
    found = {(r["host"], r["path"]): r["site_x"] for r in sites.collect()}
    mean = sum(p for *_, p in many) / len(many)
    assert means["x"] == pytest.approx(mean)
    assert found["big", "a"] == pytest.approx(0.9, abs=0.02)
    assert 0.1 < found["big", "b"] < found["big", "a"]
    assert 0.1 < found["small", "a"] < mean


def test_site_posteriors_by_hand(spark, monkeypatch):
    monkeypatch.setattr(quality, "_strength", lambda *a: 4.0)
    rows = spark.createDataFrame([("h", "a", 1.0), ("h", "a", 0.0), ("h", "b", 1.0), ("g", "a", 0.0)], "host string, path string, p_x double")
    sites, _ = quality.site_posteriors(rows, "host", "path", ["x"])
    host_h, host_g = (2 + 4 * 0.5) / 7, (0 + 4 * 0.5) / 5
    expected = {("h", "a"): (1 + 4 * host_h) / 6, ("h", "b"): (1 + 4 * host_h) / 5, ("g", "a"): 4 * host_g / 5}
    assert {(r["host"], r["path"]): r["site_x"] for r in sites.collect()} == pytest.approx(expected)


def test_odd_rows_and_no_labels(spark):
    rows = odd_rows()
    out = quality.classify(frame(spark, rows), spark.createDataFrame([], LABELS))
    assert out.count() == len(rows) and out.filter("NOT kept").count() == 0
    assert {round(r[0], 6) for r in out.select("quality_score").distinct().collect()} == {0.5}
    one_class = spark.createDataFrame([(r[0], 1, 0) for r in rows[:20]], LABELS)
    assert quality.keep_good(frame(spark, rows), one_class).columns == frame(spark, rows).columns
    assert quality.classify(empty(spark), one_class).collect() == []


def test_clashing_columns_are_replaced(spark):
    rows, truth = corpus(60)
    docs = frame(spark, rows).withColumn("kept", F.lit("old")).withColumn("p_quality", F.lit("old"))
    out = quality.classify(docs, spark.createDataFrame(truth, LABELS))
    assert dict(out.dtypes)["kept"] == "boolean" and out.columns.count("kept") == 1


def test_the_sample_is_bounded_and_the_same_again(spark):
    labels = spark.createDataFrame([(i % 500, i % 2, None) for i in range(1000)], LABELS)
    first, again = (sorted(r["doc_id"] for r in quality.sampled_labels(labels.repartition(n), "doc_id", ["quality", "toxic"], 100).collect()) for n in (2, 5))
    assert first == again and len(first) == 100


def test_inner_names_do_not_clash(spark):
    rows, truth = corpus(60)
    labels = spark.createDataFrame(truth, LABELS)
    inner = ["__terms", "__vector", "__host", "__path", "__id", "__text", "c0", "c1", "p_quality_x"]
    docs = frame(spark, rows).selectExpr("*", *[f"'{name}' AS {name}" for name in inner])
    left = quality.keep_good(docs, labels).collect()
    plain = quality.keep_good(frame(spark, rows), labels).collect()
    assert sorted(r["doc_id"] for r in left) == sorted(r["doc_id"] for r in plain) and all(r[name] == name for r in left for name in inner)
