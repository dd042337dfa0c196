"""The stages over a small table, and the queries over the given ones, against plainer counterparts."""

import hashlib
import subprocess
import sys
from collections import Counter

import pytest

import corpus_pipeline
from furlong.llm import mixing
from furlong.llm.bindings import ORACLE, QUERIES
from tests.compare import connect, duck_rows, spark_rows
from tests.llm import test_exact_dedup, test_phrase_dedup, test_simhash, test_suffix_dedup


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def test_stages_and_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "exact_dedup", "simhash_near_dedup", "pfair_mixing", "byte_bpe",
    ]
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)


def test_every_stage_works_on_what_its_predecessor_kept(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        rows = docs.select("doc_id", "text").collect()
        kept[name] = {r["doc_id"]: r["text"] for r in rows}
        assert len(kept[name]) == len(rows) and kept[name].items() <= before.items()
        if name == "exact_dedup":
            expected = test_exact_dedup.brute([(i, t) for i, t in before.items()])
            assert set(kept[name]) == {i for i, _, _, stays, _ in expected if stays}
        if name == "simhash_near_dedup":
            ids = sorted(before)
            import numpy as np

            marks = np.array([test_simhash.brute_fingerprint(before[i], 4) for i in ids], np.uint64)
            reached = test_simhash.brute_groups(marks, ids, 4)
            assert set(kept[name]) == {i for i, c in zip(ids, reached) if i == c}
        before = kept[name]
    name, stage = corpus_pipeline.STAGES[-1]
    last = stage(spark, docs, sf_dir).collect()
    assert {r["doc_id"] for r in last} == set(before)
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in last)
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    clean = [i for i, r in labels.items() if r["quality"] and not r["toxic"]]
    assert sum(i in kept["quality_classifier"] for i in clean) >= 0.97 * len(clean)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    assert spark_rows(QUERIES[name](spark, sf_dir)) == duck_rows(connect(sf_dir), ORACLE[name])


def test_passage_query(spark, sf_dir, documents):
    assert test_phrase_dedup.found(QUERIES["op8_phrase_dedup"](spark, sf_dir)) == test_phrase_dedup.brute(documents, 50)


def test_repeat_query(spark, sf_dir, documents):
    found = Counter(tuple(r) for r in QUERIES["op10_suffix_dedup"](spark, sf_dir).collect())
    assert found == test_suffix_dedup.brute(documents, 200)


def test_mixing_query_places_all(spark, sf_dir, documents):
    found = QUERIES["op4_pfair_mixing"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(i for i, _ in documents)
    assert len({(r["slot"], r["place"]) for r in found}) == len(found)
    assert all(0 <= r["place"] < mixing.BLOCK_ROWS for r in found)


def test_coding_query_decodes_to_the_texts(spark, sf_dir, documents):
    hashes = {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in documents}
    assert {r["doc_id"]: r["decoded_sha256"] for r in QUERIES["op6_byte_bpe"](spark, sf_dir).collect()} == hashes


def test_the_rest_works_without_these(tmp_path):
    import os
    import shutil

    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    shutil.copytree(f"{root}/furlong", tmp_path / "furlong", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') for n in e.queries()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": ""})
    assert said.returncode == 0, said.stderr
    assert said.stdout.split()[-1] == "False"
