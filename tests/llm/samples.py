"""Rows that the tests of all operators share: nulls, empty and long texts, ties, repeats."""

import random

ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, rep string, n string"


def odd_rows(seed=5, count=60):
    """Documents over few words: exact and near copies, common passages, odd rows; columns with clashing names."""
    rnd = random.Random(seed)
    words = [f"{a}{b}" for a in ("al", "Be", "ça", "do") for b in ("m", "né", "po", "qu", "ro")]
    passage = [rnd.choice(words) for _ in range(90)]
    texts = []
    for i in range(count):
        own = [rnd.choice(words) for _ in range(rnd.randrange(1, 80))]
        if i % 3 == 0:
            cut = rnd.randrange(0, 30)
            own = own[:20] + passage[cut : cut + 60] + own[20:]
        texts.append(rnd.choice([" ", "\n", "  ", "\t"]).join(own))
    texts[7:9] = [texts[3], texts[3].upper()]
    texts[11] = texts[10] + " end"
    rows = [(i, t, ["en", "de", None][i % 3], f"s{i % 4}" if i % 5 else None, len(t), 1, "x", None) for i, t in enumerate(texts)]
    long_text = " ".join(rnd.choice(words) for _ in range(6000))
    odd = ["", None, "   \n ", long_text, long_text, "x" * 5000, "a", texts[3]]
    rows += [(count + i, t, None, "s0", None, 2, None, "y") for i, t in enumerate(odd)]
    return rows + [rows[3], rows[3], rows[5]]


def rows_without_proper_ids(rows):
    """Rows that lack an id, with texts that others have and of their own, and ids that come with two texts."""
    texts = [r[1] for r in rows]
    odd = [(None, texts[3]), (None, texts[3]), (None, None), (None, texts[3] + " " + texts[6]), (None, "only here"), (None, "only here")]
    odd += [(4, texts[3]), (4, texts[6]), (2, texts[9]), (rows[0][0], None)]
    return [(i, t, "en", "s1", 3, 5, "z", None) for i, t in odd]


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, ODD_SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
