import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from furlong.llm import byte_bpe
from furlong.llm.common import Recent
from tests.llm.samples import empty, frame, odd_rows

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(text):
    return np.frombuffer(byte_bpe.coder(PATH, PATTERN).encode([text])[0], "<u4").tolist()


def test_any_characters(library):
    rnd = random.Random(3)
    spaces = [0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF]
    some = [chr(x) for x in (*range(0x100), *spaces, 0x301, 0x4E2D, 0x1F600, 0x660, 0x2160)] + list("aaabbb   \n\n'stre") * 8
    for _ in range(1500):
        text = "".join(rnd.choice(some) for _ in range(rnd.randrange(40)))
        assert ids_of(text) == library.encode_ordinary(text)


def test_very_long_pieces(library):
    rnd = random.Random(1)
    text = "ab" * 20000 + "x" * 30000 + "".join(rnd.choice("abcdeé") for _ in range(30000)) + " " * 5000 + "\n" * 70
    assert ids_of(text) == library.encode_ordinary(text)
    assert byte_bpe.coder(PATH, PATTERN).decode(ids_of(text)) == text.encode()


def one_by_one(piece, ranks):
    """The rule, merge by merge."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        possible = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not possible:
            return [ranks[p] for p in parts]
        _, i = min(possible)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


BYTES = {bytes([b]): b for b in range(256)}


def queue_ids(pieces, ranks):
    return [np.frombuffer(b, "<u4").tolist() for b in byte_bpe.RankQueue(ranks).encode(pieces)]


@pytest.mark.parametrize("few", [0, 6])
def test_of_equal_ranks_the_leftmost_is_merged(few, monkeypatch):
    monkeypatch.setattr(byte_bpe, "FEW", few)
    ranks = BYTES | {b"aa": 256, b"aaa": 257, b"ba": 258}
    assert queue_ids([b"aaaaa", b"baab"], ranks) == [[256, 257], [98, 256, 98]]


@pytest.mark.parametrize("few", [0, 2, 6])
def test_any_ranks(few, monkeypatch):
    """Ranks in no order that training would give, so that a merge can make a pair that comes before it."""
    monkeypatch.setattr(byte_bpe, "FEW", few)
    monkeypatch.setattr(byte_bpe, "QUEUE_BYTES", 300)
    rnd = random.Random(6)
    for _ in range(60):
        tokens = {bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(2, 6))) for _ in range(rnd.randrange(1, 40))}
        tokens = rnd.sample(sorted(tokens), len(tokens))
        ranks = BYTES | {token: 256 + i for i, token in enumerate(tokens)}
        pieces = [bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(1, 40))) for _ in range(40)]
        expected = [[ranks[p]] if p in ranks else one_by_one(p, ranks) for p in pieces]
        assert queue_ids(pieces, ranks) == expected


def test_rows(spark, library):
    rows = odd_rows()
    expected = Counter()
    for doc_id, text, *_ in rows:
        ids = library.encode_ordinary(text or "")
        sums = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), (text or "").encode())]
        expected[doc_id, len(ids), *sums] += 1
    encoded = byte_bpe.encode(frame(spark, rows), PATH, PATTERN)
    found = byte_bpe.coding_digest(frame(spark, rows), PATH, PATTERN)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert Counter(tuple(r) for r in found.collect()) == expected
    decoded = {r["doc_id"]: bytes(r["decoded"]) for r in byte_bpe.decode(encoded, PATH, PATTERN).collect()}
    assert decoded == {r[0]: (r[1] or "").encode() for r in rows}
    checked = byte_bpe.encode_checked(frame(spark, rows), PATH, PATTERN).collect()
    assert all(r["round_trip"] for r in checked) and len(checked) == len(rows)


def test_empty_table(spark):
    assert byte_bpe.coding_digest(empty(spark), PATH, PATTERN).collect() == []
    assert byte_bpe.encode(empty(spark), PATH, PATTERN).collect() == []


def test_what_is_kept_is_bounded():
    made = []

    def make(texts):
        made.extend(texts)
        return [text.encode() for text in texts]

    kept = Recent(limit=10, longest=4)
    for i in range(1000):
        asked = {f"{i % 7}", f"w{i}", f"longer{i}"}
        found = kept.of(asked, make)
        assert all(found[text] == text.encode() for text in asked)
        assert len(kept.now) <= 14 and len(kept.older) <= 14 and sum(len(text) > 4 for text in kept.now) <= 1
    assert len(made) < 2400  # what is asked for often stays
