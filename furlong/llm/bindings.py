"""The dealt operators as queries over whole given tables, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from furlong.llm import (
    byte_bpe, collocations, kd_search, kd_shards, mixing, phrase_dedup, quality, suffix_dedup, token_counts, token_store, whitening,
)
from furlong.llm.common import load, prepare
from furlong.llm.exact_dedup import equal_texts
from furlong.llm.simhash import near_groups
from furlong.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register under the function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(prepare(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


@query
def op1_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.shard_by_bytes(load(spark, sf_dir, "documents"), shards=8)


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(load(spark, sf_dir, "documents"), width=4, max_bits=4)


@query
def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_store.write_tokens(load(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_store.token_index(token_store.read_tokens(spark, path))


@query
def op4_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(load(spark, sf_dir, "documents"))


@query
def op5_kd_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = load(spark, sf_dir, "embeddings")
    return kd_search.top_k(vectors, vectors.filter(F.col("vec_id") % 100 == 0), k=10)


@query
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return byte_bpe.coding_digest(load(spark, sf_dir, "documents"), path, pattern)


@query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return equal_texts(load(spark, sf_dir, "documents"))


@query
def op8_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_dedup.drop_passages(load(spark, sf_dir, "documents"), length=50).drop("kept")


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return quality.classify(docs, load(spark, sf_dir, "labels")).drop("text", "source", "lang")


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.drop_repeats(load(spark, sf_dir, "documents"), length=200)
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(load(spark, sf_dir, "documents"), least=30, longest=4, top=2000).drop("example_id")


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(load(spark, sf_dir, "embeddings"), components=16)


@query
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(load(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op7_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256({FOLDED}) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY {FOLDED})
    """,
    "op11_collocations": rf"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest([list_filter(string_split_regex(p, '[ \t]+'), lambda w: w != '')
                           FOR p IN string_split_regex({FOLDED}, '[.,;:!?\x0A-\x0D]')]) AS w
            FROM documents
        ),
        totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
        starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
        runs AS (SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase
                 FROM starts, (VALUES (1), (2), (3), (4)) AS sizes(m) WHERE i + m - 1 <= len(w)),
        grams AS (SELECT lang, m, phrase, count(*) AS a FROM runs GROUP BY ALL HAVING count(*) >= 30),
        around AS (
            SELECT lang, phrase, max(a) AS around FROM (
                SELECT lang, a, unnest([array_to_string(string_split(phrase, ' ')[: m - 1], ' '),
                                        array_to_string(string_split(phrase, ' ')[2 :], ' ')]) AS phrase
                FROM grams WHERE m > 2) GROUP BY ALL
        ),
        kept AS (
            SELECT g.* FROM grams g LEFT JOIN around USING (lang, phrase)
            WHERE g.m > 1 AND coalesce(CAST(100 AS HUGEINT) * around < CAST(80 AS HUGEINT) * a, true)
        ),
        cuts AS (SELECT lang, phrase, a, unnest(range(1, m)) AS k, string_split(phrase, ' ') AS w FROM kept),
        scored AS (
            SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r,
                   CAST(CAST(2000000 AS HUGEINT) * c.a // (x.a + y.a) AS BIGINT) AS score, k
            FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[: k], ' ')
            JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1 :], ' ')
        ),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS INT) AS rank
            FROM best
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
    "op5_kd_search": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        ),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i])) AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.x) = len(q.x)
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM scored QUALIFY rank <= 10
    """,
}
