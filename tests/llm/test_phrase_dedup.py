import glob
import hashlib
import os
import random
import re
from collections import Counter

import pytest

from furlong.llm import phrase_dedup
from furlong.session import run_folder
from tests.llm.samples import empty, frame, odd_rows, rows_without_proper_ids


def brute(rows, length):
    first, texts = {}, []
    for doc_id, text, *_ in rows:
        doc_id = float("inf") if doc_id is None else doc_id  # behind all others
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        texts.append((doc_id, words))
        for s in range(len(words) - length + 1):
            key = tuple(words[s : s + length])
            first[key] = min(first.get(key, doc_id), doc_id)
    out = Counter()
    for doc_id, words in texts:
        gone = [False] * len(words)
        for s in range(len(words) - length + 1):
            if first[tuple(words[s : s + length])] < doc_id:
                gone[s : s + length] = [True] * length
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out[None if doc_id == float("inf") else doc_id, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def found(df):
    return Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect())


def passages(seed=2, count=120):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    shared = [[rnd.choice(words) for _ in range(300)] for _ in range(4)]
    rows = []
    for i in range(count):
        base, a = rnd.choice(shared), rnd.randrange(0, 200)
        own = [[rnd.choice(words) for _ in range(rnd.randrange(60))] for _ in range(2)]
        text = own[0] + base[a : a + rnd.randrange(20, 150)] + own[1]
        rows.append((i, "".join(w + rnd.choice([" ", "\n", "  ", "\t"]) for w in text)))
    rows += [(200, "x " * 1000), (201, None), (202, " \n "), (203, "a b " * 700), (204, rows[3][1])]
    rows += [(205, "y " * 400 + rows[7][1] + rows[7][1])]
    return [(*r, None, None, 1, 1, "", "") for r in rows]


@pytest.mark.parametrize("chunk", [1 << 20, 600])
def test_against_brute_force(spark, chunk, monkeypatch):
    monkeypatch.setattr(phrase_dedup, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(phrase_dedup, "SHARD_BYTES", 2 * chunk)
    rows = passages()
    assert found(phrase_dedup.drop_passages(frame(spark, rows), length=30)) == brute(rows, 30)


def test_odd_rows(spark):
    rows = odd_rows()
    rows += rows_without_proper_ids(rows)
    assert found(phrase_dedup.drop_passages(frame(spark, rows), length=50)) == brute(rows, 50)


def test_what_is_left(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [(1, passage), (2, f"before {passage}  after"), (3, f"p0 {passage[:-1]}"), (None, f"{passage} x")]
    left = phrase_dedup.drop_passages(frame(spark, [(*r, None, None, 1, 1, "", "") for r in rows])).collect()
    kept = {r["doc_id"]: (r["n_removed"], r["kept"] and bytes(r["kept"])) for r in left}
    assert kept == {1: (0, None), 2: (50, b"before after"), 3: (0, None), None: (50, b"x")}


def test_empty_table_and_short_windows(spark):
    assert phrase_dedup.drop_passages(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        phrase_dedup.drop_passages(empty(spark), length=10)


def thue_morse(n):
    return ["ab"[bin(i).count("1") % 2] for i in range(n)]


@pytest.mark.parametrize("letters", [1024, 2048])
def test_words_that_polynomial_hashes_confuse(spark, letters):
    """Documents of 61 words that differ in one word only, of letters that collide in hashes modulo powers of two."""
    word = "".join(thue_morse(letters))
    other = word.translate(str.maketrans("ab", "ba"))
    around = [f"w{i}" for i in range(60)]
    rows = [(1, around[:30] + [word] + around[30:]), (2, around[:30] + [other] + around[30:])]
    rows = [(i, " ".join(words), None, None, 1, 1, "", "") for i, words in rows]
    assert found(phrase_dedup.drop_passages(frame(spark, rows), length=50)) == brute(rows, 50)
    assert {n[2] for n in brute(rows, 50)} == {0}


def test_long_runs_of_one_word(spark):
    rows = [(i, " ".join(["ab"] * n + [f"x{i}"] + ["c"] * n), None, None, 1, 1, "", "") for i, n in enumerate((40, 60, 200, 49, 50))]
    assert found(phrase_dedup.drop_passages(frame(spark, rows), length=50)) == brute(rows, 50)


def test_a_very_long_text(spark):
    """More words than fit into the place bits of an anchor, read in parts."""
    tail = " ".join(f"t{i}" for i in range(70))
    rows = [(1, f"{tail} end"), (2, "a " * (1 << 24) + tail)]
    left = phrase_dedup.drop_passages(spark.createDataFrame(rows, "doc_id long, text string"), length=50).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in left} == {1: (71, 0), 2: ((1 << 24) + 70, 70)}


def test_the_automaton_locates_every_occurrence(monkeypatch):
    import pyarrow as pa

    phrase = " ".join(f"p{i}" for i in range(phrase_dedup.PHRASE))
    texts = pa.array([f"{phrase} x {phrase}", f"a {phrase[:-1]} b", f"c  \n{phrase}"])
    (_, words), = phrase_dedup._read(texts, 50)
    p = int(words.run_hashes(phrase_dedup.PHRASE)[0].view("i8"))
    for letters in (phrase_dedup.Automaton.LETTERS, 3):  # with 3 letters different words share one
        monkeypatch.setattr(phrase_dedup.Automaton, "LETTERS", letters)
        hashes = phrase_dedup.Automaton([phrase], [p]).located(words)
        hit = [i for i, h in enumerate(hashes) if h != phrase_dedup.NONE]
        first = words.first.tolist()
        assert hit == [0, phrase_dedup.PHRASE + 1, first[2] + 1] and {int(hashes[i]) for i in hit} == {p % 2**64}


def test_tables_that_nothing_reads_any_more_are_deleted(spark):
    def tables():
        folder = run_folder(spark)
        return set(os.listdir(folder)) if os.path.isdir(folder) else set()

    before = tables()
    rows = passages()
    result = phrase_dedup.drop_passages(frame(spark, rows), length=30)
    # the place where the tables lie may stay, but no rows in it
    left = {name.split("-")[0] for name in tables() - before if glob.glob(f"{run_folder(spark)}/{name}/*.parquet")}
    assert left == {"located", "spans"}
    assert found(result) == brute(rows, 30)
