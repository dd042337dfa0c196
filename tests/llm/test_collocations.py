import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from furlong.llm import bindings, collocations
from tests.compare import connect, duck_rows, duck_types
from tests.llm.samples import empty, frame, odd_rows

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top=2000, longest=4):
    counts, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for m in range(1, longest + 1):
                counts[lang or "und"].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = set()
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for phrase, a in candidates.items():
            m = len(phrase)
            longer = [p for p in candidates if len(p) > m and any(p[i : i + m] == phrase for i in range(len(p) - m + 1))]
            if any(100 * candidates[p] >= 80 * a for p in longer):
                continue
            cuts = [(2000000 * a // (f[phrase[:k]] + f[phrase[k:]]), k) for k in range(1, m)]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


def found(df):
    rows = [tuple(r)[:8] for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def texts(seed=8, count=150):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["Été", "é", "W1", "a-b"]
    fixed = [["new", "york", "city"], ["as", "soon", "as", "can", "be"], ["w1", "w2"], ["zu", "dem", "Été"]]
    rows = []
    for i in range(count):
        out = []
        for _ in range(rnd.randrange(1, 40)):
            out += rnd.choice(fixed) if rnd.random() < 0.4 else [rnd.choice(words)]
        text = "".join(w + rnd.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b"]) for w in out)
        rows.append((i, text, rnd.choice(["en", "de", None]), "s", len(text), 1, "", ""))
    return rows + [(900, None, "en", "s", 0, 1, "", ""), (901, "...", "xx", "s", 0, 1, "", ""), (None, "w1 w2 w1 w2 " * 40, "en", "", 0, 1, "", "")]


def test_against_brute_force(spark):
    rows = texts()
    expected = brute(rows, 5)
    assert len(expected) > 100
    assert found(collocations.collocations(frame(spark, rows), least=5)) == expected
    assert found(collocations.collocations(frame(spark, rows), least=5, top=7)) == brute(rows, 5, top=7)
    assert found(collocations.collocations(frame(spark, rows), least=5, longest=2)) == brute(rows, 5, longest=2)


@pytest.mark.parametrize("chunk", [40, 700])
def test_long_texts_in_parts(spark, chunk, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", chunk)
    rows = texts(seed=9, count=40) + [(950, "x" * 9000 + " w1 w2 w3 " * 300, "en", "", 0, 1, "", "")]
    assert found(collocations.collocations(frame(spark, rows), least=4)) == brute(rows, 4)


def test_equal_fingerprints_of_unequal_texts(spark, monkeypatch):
    whole = collocations.Fingerprints.of
    monkeypatch.setattr(collocations.Fingerprints, "of", lambda self, first, length: whole(self, first, length) % np.uint64(5))
    rows = texts(count=60)
    assert found(collocations.collocations(frame(spark, rows), least=5)) == brute(rows, 5)


def test_a_full_bitmap_prunes_nothing_and_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BITMAP_BITS", 6)
    rows = texts(count=60)
    assert found(collocations.collocations(frame(spark, rows), least=5)) == brute(rows, 5)


def test_odd_rows_and_clashing_names(spark):
    rows = odd_rows()
    odd = frame(spark, rows).selectExpr("*", "'x' AS phrase", "1 AS a", "2 AS words", "3 AS key")
    assert found(collocations.collocations(odd, least=10)) == brute(rows, 10)
    assert collocations.collocations(empty(spark)).collect() == []


def test_example_is_the_smallest_id(spark):
    rows = [(i, "one two", "en", "", 0, 1, "", "") for i in (7, 3, None, 9)]
    (row,) = collocations.collocations(frame(spark, rows), least=2).collect()
    assert (row["example_id"], row["a"], row["score"], row["n"]) == (3, 4, 1000000, 8)


def test_equal_codes_of_unequal_words(spark, monkeypatch):
    monkeypatch.setattr(collocations, "_PRIMES", (3, 2))
    rows = texts(count=40)
    assert found(collocations.collocations(frame(spark, rows), least=5)) == brute(rows, 5)


def test_fingerprints_differ_where_words_do():
    rnd = random.Random(3)
    long = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))  # Thue-Morse
    some = ["".join(rnd.choice("abcdé") for _ in range(rnd.randrange(1, 90))) for _ in range(3000)] + [long, long.translate({97: 98, 98: 97})]
    text = " ".join(some).encode()
    words = collocations.words_of([text, b"", b" . ", text])
    assert words.bytes_of(0) == some[0].encode() and len(words.start) == 2 * len(some)
    prints = collocations.Fingerprints(words)
    for length in (1, 3):
        first = np.arange(len(some) - length + 1)
        own, again = prints.of(first, length), prints.of(first + len(some), length)
        assert (own == again).all()
        assert len(np.unique(own)) == len({tuple(some[i : i + length]) for i in first})
    numbers = collocations._word_numbers(words, prints)
    assert len(np.unique(numbers)) == len(set(some)) and (numbers[: len(some)] == numbers[len(some) :]).all()


def test_given_table_against_sql(spark, sf_dir):
    query, sql = bindings.QUERIES["op11_collocations"], bindings.ORACLE["op11_collocations"]
    df, duck = query(spark, sf_dir), connect(sf_dir)
    columns, expected = duck_rows(duck, sql)
    own = sorted(df.columns)
    assert own == columns and Counter(tuple(r[c] for c in own) for r in df.collect()) == expected and expected
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR"}
    assert {c: kinds[t] for c, t in df.dtypes} == duck_types(duck, sql)
