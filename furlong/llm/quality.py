"""Quality classifier: document evidence, set against what hosts and paths have shown (hierarchical empirical Bayes).

A logistic model over words and character shares, fitted on a bounded sample of the
labelled rows, gives each document's own evidence. Then all documents are grouped: the
mean evidence of a host is shrunk toward the global mean, and that of a path toward its
host's, the more the fewer documents there are; how much is estimated from the spread
between the groups. A document's posterior odds are its own odds, times the odds of its
path over the odds of all.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from furlong.llm.common import cut_lineage, join_sized, pieces

#: Most labelled rows that the document model is fitted on.
SAMPLE_ROWS = 20_000
FEATURES = 1 << 16
ROUNDS = 40
FIT_TASKS = 4
PENALTY = 0.001
#: Share of the penalty that drops terms: rare words say nothing by themselves.
SPARSITY = 1.0
LEAST_ODDS = 1e-6
CHUNK_BYTES = 4 * 1024 * 1024

_WORD = re.compile(r"[^\W\d_]+")
_UPPER, _DIGIT = np.arange(65, 91), np.arange(48, 58)
_SIGNS = [c for c in range(33, 127) if not chr(c).isalnum()]
_SHARES = (1 / 256, 1 / 64, 1 / 16, 1 / 4)


def terms_of(text: str, data: np.ndarray) -> list[str]:
    """The different words of a text in lower case, and a term for each share its characters reach."""
    words = _WORD.findall(text.lower())
    terms = set(words)
    out = list(terms)
    if not len(data):
        return ["=empty"]
    counts = np.bincount(data, minlength=256) / len(data)
    shares = [("A", counts[_UPPER].sum()), ("9", counts[_DIGIT].sum()), *[(chr(c), counts[c]) for c in _SIGNS if counts[c]]]
    for name, share in shares:
        out += [f"={name}{i}" for i, least in enumerate(_SHARES) if share >= least]
    if words:
        variety = len(terms) / len(words)
        out += [f"=same{i}" for i, most in enumerate((0.5, 0.25, 0.1, 0.03)) if variety < most]
    else:
        out.append("=no words")
    return out


def with_terms(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the terms of the text in ``__terms``; null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in pieces(batch, text, CHUNK_BYTES):
                column = pc.fill_null(some.column(some.schema.get_field_index(text)), "")
                terms = [terms_of(t, np.frombuffer(t.encode(), np.uint8)) for t in column.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(terms, pa.list_(pa.string()))], names=[*some.schema.names, "__terms"]
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, __terms array<string>")


def _vectors(rows: DataFrame) -> DataFrame:
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="__terms", outputCol="__vector").transform(rows).drop("__terms")


def fit(labelled: DataFrame, targets: Sequence[str]) -> dict[str, LogisticRegressionModel | float]:
    """A model for each target from rows of ``__vector`` and labels; a constant where only one class is there."""
    models: dict[str, LogisticRegressionModel | float] = {}
    for target in targets:
        rows = labelled.filter(F.col(target).isNotNull()).withColumn("__label", F.col(target).cast("double"))
        n, positive = rows.agg(F.count("*"), F.coalesce(F.sum("__label"), F.lit(0.0))).first()
        if 0 < positive < n:
            logistic = LogisticRegression(
                featuresCol="__vector", labelCol="__label", maxIter=ROUNDS, regParam=PENALTY, elasticNetParam=SPARSITY, standardization=False,
                rawPredictionCol="__raw", probabilityCol="__probability", predictionCol="__prediction",
            )
            # the sample is bounded: a few tasks a round, however many files it came from
            models[target] = logistic.fit(rows.select("__vector", "__label").coalesce(FIT_TASKS))
        else:
            models[target] = (positive + 1) / (n + 2)
    return models


def sampled_labels(labels: DataFrame, id_column: str, targets: Sequence[str], most: int) -> DataFrame:
    """At most ``most`` labelled ids, chosen by a hash of the id; an id with several labels counts if any is 1."""
    known = F.coalesce(*[F.col(t).cast("int") for t in targets]).isNotNull()
    one_each = labels.filter(known & F.col(id_column).isNotNull()).groupBy(id_column).agg(*[F.max(t).alias(t) for t in targets])
    return one_each.orderBy(F.xxhash64(id_column), id_column).limit(most)


def evidence(
    docs: DataFrame, labels: DataFrame, targets: Sequence[str], id_column: str, text: str, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """``docs`` with each target's probability from the document alone, in ``p_<target>``."""
    chosen = sampled_labels(labels, id_column, targets, sample_rows)
    chosen = cut_lineage(chosen.select(F.col(id_column).alias("__id"), *[F.col(t).alias(f"__t_{t}") for t in targets]), "labelled")
    texts = docs.select(F.col(id_column).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(chosen), "__id")
    vectors = cut_lineage(_vectors(with_terms(texts, "__text")).select("__vector", *[f"__t_{t}" for t in targets]), "vectors")
    models = fit(vectors, [f"__t_{t}" for t in targets])
    rows = _vectors(with_terms(docs, text))
    for target in targets:
        model = models[f"__t_{target}"]
        if isinstance(model, float):
            rows = rows.withColumn(f"p_{target}", F.lit(model))
        else:
            rows = model.transform(rows).withColumn(f"p_{target}", vector_to_array("__probability")[1])
            rows = rows.drop("__raw", "__probability", "__prediction")
    return rows.drop("__vector")


def _odds(p: Column) -> Column:
    bounded = F.greatest(F.lit(LEAST_ODDS), F.least(F.lit(1 - LEAST_ODDS), p))
    return F.log(bounded / (1 - bounded))


def _strength(groups: DataFrame, total: str, mean: Column) -> float:
    """Documents that the prior is worth, from how far the groups' means lie from it beyond chance."""
    share = F.col(total) / F.col("n")
    row = groups.agg(
        F.sum(F.col("n") * (share - mean) ** 2).alias("spread"),
        F.sum(mean * (1 - mean)).alias("chance"),
        F.sum("n").alias("n"),
        F.avg(mean * (1 - mean)).alias("within"),
    ).first()
    if not row["n"]:
        return 1.0
    between = (row["spread"] - row["chance"]) / row["n"]
    if between <= 0:
        return 1e6
    return min(max(row["within"] / between - 1, 1.0), 1e6)


def site_posteriors(scored: DataFrame, host: str, path: str, targets: Sequence[str]) -> tuple[DataFrame, dict[str, float]]:
    """A row per host and path: documents ``n``, and each target's posterior ``site_<target>``; the global means."""
    sums = [F.sum(f"p_{t}").alias(f"k_{t}") for t in targets]
    paths = cut_lineage(scored.groupBy(host, path).agg(F.count("*").alias("n"), *sums), "paths")
    hosts = paths.groupBy(host).agg(F.sum("n").alias("n"), *[F.sum(f"k_{t}").alias(f"k_{t}") for t in targets])
    total = hosts.agg(F.sum("n").alias("n"), *[F.sum(f"k_{t}").alias(t) for t in targets]).first()
    means = {t: (total[t] / total["n"] if total["n"] else 0.5) for t in targets}
    for t in targets:
        strength = _strength(hosts, f"k_{t}", F.lit(means[t]))
        hosts = hosts.withColumn(f"host_{t}", (F.col(f"k_{t}") + strength * means[t]) / (F.col("n") + strength))
    both = cut_lineage(paths.join(hosts.select(host, *[f"host_{t}" for t in targets]), host), "sites")
    out = both
    for t in targets:
        strength = _strength(both, f"k_{t}", F.col(f"host_{t}"))
        out = out.withColumn(f"site_{t}", (F.col(f"k_{t}") + strength * F.col(f"host_{t}")) / (F.col("n") + strength))
    return cut_lineage(out.select(host, path, "n", *[f"site_{t}" for t in targets]), "posteriors"), means


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    host: str = "source",
    path: str = "lang",
    good: str = "quality",
    bad: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``docs`` with ``<target>_score`` and ``site_<target>`` for both targets, and ``kept``.

    A row is kept if it is more likely good than not, and more likely not toxic than toxic.
    Null texts count as empty, null hosts and paths as one host or path of their own, labels
    that are null are passed over; without labels every score is one half and all rows are
    kept. Repeated rows are scored alike. Columns of ``docs`` with the names of results are
    replaced, all others are returned as they are.
    """
    targets = [good, bad]
    made = [f"{x}_{t}" for t in targets for x in ("p", "site")] + [f"{t}_score" for t in targets] + ["kept"]
    source = docs.drop(*[c for c in made if c not in (id_column, text, host, path)])
    # by place, so that no column of the table can have the name of one that is made on the way
    names = {name: f"c{i}" for i, name in enumerate(source.columns)}
    inner = source.toDF(*names.values())
    places = [names[c] for c in (id_column, text, host, path)]
    known = labels.select(F.col(id_column).alias(places[0]), *targets)
    keyed = evidence(inner, known, targets, places[0], places[1], sample_rows)
    keyed = keyed.withColumns({f"__{k}": F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for k, c in zip(("host", "path"), places[2:])})
    scored = cut_lineage(keyed, "evidence")
    sites, means = site_posteriors(scored, "__host", "__path", targets)
    joined = join_sized(scored, sites, ["__host", "__path"], "n")
    for t in targets:
        own, site = _odds(F.col(f"p_{t}")), _odds(F.col(f"site_{t}")) - _odds(F.lit(means[t]))
        joined = joined.withColumn(f"{t}_score", 1 / (1 + F.exp(-(own + site))))
    kept = (F.col(f"{good}_score") >= 0.5) & (F.col(f"{bad}_score") <= 0.5)
    scores = [c for t in targets for c in (f"{t}_score", f"site_{t}")]
    out = joined.withColumn("kept", kept).select(*names.values(), *scores, "kept")
    return out.toDF(*names, *scores, "kept")


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    return classify(docs, labels, **options).filter("kept").select(*docs.columns)
