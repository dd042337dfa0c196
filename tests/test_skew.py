"""Hot keys, null keys and copies change how work is spread, never what comes out."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from furlong.operators import aggregates, joins
from furlong.operators.skew import find_hot_keys, row_numbers, running_totals, spread_join
from tests.compare import spark_rows


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows has one key, a tenth has none, and many rows are exact copies."""
    key = F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 10 = 1 THEN NULL ELSE concat('k', id % 500) END")
    return spark.range(0, 30000, 1, 4).select(key.alias("k"), (F.col("id") % 7).cast("int").alias("v")).cache()


def test_hot_keys_are_found(rows):
    (hot,) = find_hot_keys(rows, [["k"]], rows_per_slice=1000)
    expected = rows.filter("k = 'hot'").select(F.xxhash64("k")).first()[0]
    assert hot.slices == {expected: 10}
    assert hot.null_slices == 2


def test_nothing_is_hot_in_even_data(spark):
    (hot,) = find_hot_keys(spark.range(10000).withColumnRenamed("id", "k"), [["k"]], rows_per_slice=1000)
    assert not hot.slices and hot.null_slices == 0


@pytest.mark.parametrize("how", ["left", "inner"])
def test_spread_join_equals_join(spark, rows, how):
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("k1", 3), ("k2", 4), (None, 5)], "k string, w int"
    )
    spread = spread_join(rows, right, ["k"], how, rows_per_slice=500)
    assert "__slice" in spread._jdf.queryExecution().toString()
    assert spark_rows(spread) == spark_rows(rows.join(right, "k", how).select("k", "v", "w"))


def test_spread_join_over_two_keys(spark, rows):
    left = rows.withColumn("s", F.col("v") % 2)
    right = spark.createDataFrame([("hot", 0, 1), ("hot", 1, 2), ("k1", 1, 3)], "k string, s int, w int")
    spread = spread_join(left, right, ["k", "s"], rows_per_slice=200)
    assert spark_rows(spread) == spark_rows(left.join(right, ["k", "s"], "left"))


def test_slices_share_the_hot_rows(spark, rows):
    spread = spread_join(rows, spark.createDataFrame([("hot", 1)], "k string, w int"), ["k"], rows_per_slice=1000)
    plan = spread._jdf.queryExecution().optimizedPlan().toString()
    assert "spark_partition_id" in plan.lower()


def exchanges(df):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", df._jdf.queryExecution().executedPlan().toString())


def sliced_calls(spark, rows):
    """Every caller of spread_join, on rows of which a third has one key."""
    lists = spark.createDataFrame([("hot", "a"), ("hot", "b"), ("k1", "c")], "k string, name string")
    names = rows.withColumn("name", F.lit("a"))
    return {
        "attach_mean": lambda: joins.attach_mean(rows, aggregates.mean_per_key(rows, "k", "v", "m"), "k"),
        "attach_ids": lambda: joins.attach_ids(names, lists.withColumn("id", F.col("name")), ["k"], "name", dedupe=True),
        "attach_payouts": lambda: joins.attach_payouts(rows, aggregates.mean_per_key(rows, "k", "v", "m"), ["k"]),
        "deviation": lambda: aggregates.deviation_from_mean(rows, "k", "v", "m", "dev"),
        "dictionary": lambda: aggregates.dictionary_encode(rows, ["k"]),
    }


@pytest.mark.parametrize("call", ["attach_mean", "attach_ids", "attach_payouts", "deviation", "dictionary"])
def test_slices_reach_the_exchange_of_both_sides(spark, rows, call, monkeypatch):
    from furlong.operators import skew

    monkeypatch.setattr(skew.find_hot_keys, "__defaults__", (1000, None))
    monkeypatch.setattr(skew.spread_join, "__defaults__", ("left", None, 1000))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = sliced_calls(spark, rows)[call]()
        found = exchanges(joined)
        assert sum("__slice" in keys for keys in found) >= 2, found
        largest = max(r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())
        assert largest < 10_000  # the hot key alone has as many rows
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize("left, right", [("int", "bigint"), ("bigint", "smallint"), ("float", "double")])
def test_slices_of_unlike_number_types(spark, left, right):
    many = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast(left).alias("k"), "id")
    few = spark.range(50).select(F.col("id").cast(right).alias("k"), F.col("id").alias("w"))
    spread = spread_join(many, few, ["k"], rows_per_slice=100)
    assert spread.filter("w IS NULL").count() == 0 and spread.count() == 3000


def test_zero_equals_minus_zero_when_sliced(spark):
    many = spark.createDataFrame([(0.0,), (-0.0,)] * 500, "k double")
    spread = spread_join(many, spark.createDataFrame([(-0.0, 1)], "k double, w int"), ["k"], rows_per_slice=100)
    assert spread.filter("w = 1").count() == 1000


def test_slices_of_rows_with_maps(spark, rows):
    mapped = rows.withColumns({"m": F.create_map(F.lit("a"), F.col("v")), "deep": F.array(F.create_map(F.lit("a"), F.col("v")))})
    spread = spread_join(mapped, spark.createDataFrame([("hot", 1)], "k string, w int"), ["k"], rows_per_slice=1000)
    assert spread.filter("w = 1").count() == 10000


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_no_rows_and_no_adaptive_execution(spark, rows, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        right = spark.createDataFrame([("hot", 1)], "k string, w int")
        assert spread_join(rows.filter("false"), right, ["k"]).count() == 0
        assert find_hot_keys(rows.filter("false"), [["k"], ["v"]]) == [({}, 0), ({}, 0)]
        assert spread_join(rows, right, ["k"], rows_per_slice=1000).filter("w = 1").count() == 10000
        empty = spark.createDataFrame([], rows.schema)
        assert spread_join(empty, right, ["k"]).count() == 0
        assert aggregates.deviation_from_mean(empty, "k", "v", "m", "d").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_other_joins_are_refused(rows):
    with pytest.raises(ValueError):
        spread_join(rows, rows, ["k"], "full")


def test_running_totals(spark):
    values = [(i * 37 % 1000, i % 5) for i in range(1000)]
    df = spark.createDataFrame(values, "o int, n int").repartition(7)
    found = {r["o"]: (r["before"], r["ones"]) for r in running_totals(df.withColumn("one", F.lit(1)), ["o"], {"before": "n", "ones": "one"}).collect()}
    total = 0
    for place, (o, n) in enumerate(sorted(values)):
        assert found[o] == (total, place)
        total += n


def test_row_numbers(spark):
    df = spark.createDataFrame([(i * 37 % 1000,) for i in range(1000)], "o int").repartition(7)
    assert all(r["o"] == r["n"] for r in row_numbers(df, ["o"], "n").collect())


def test_running_totals_of_nothing(spark):
    empty = spark.createDataFrame([], "o int, n int")
    assert running_totals(empty, ["o"], {"before": "n"}).count() == 0


@pytest.mark.parametrize("per_list", [1, 7, 10000])
def test_ids_per_date(spark, rows, per_list):
    dated = rows.select(F.when(F.col("v") < 6, F.concat(F.lit("2024010"), F.col("v"))).alias("d"), F.col("k").alias("id"))
    if per_list == 1:
        dated = dated.limit(500).cache()
    expected = defaultdict(list)
    for r in dated.collect():
        expected[r["d"]].append(r["id"])
    found = defaultdict(dict)
    for r in aggregates.ids_per_date(dated, "d", "id", per_list).collect():
        assert len(r["ids"]) <= per_list
        found[r["d"]][r["part"]] = r["ids"]
    assert {d: sum((parts[i] for i in range(len(parts))), []) for d, parts in found.items()} == {
        d: sorted(ids, key=lambda i: (i is not None, i)) for d, ids in expected.items()
    }


def test_deviation_with_hot_and_null_keys(rows):
    found = {(r["k"], r["v"]): (r["m"], r["dev"]) for r in aggregates.deviation_from_mean(rows, "k", "v", "m", "dev").collect()}
    groups = defaultdict(list)
    for r in rows.collect():
        groups[r["k"]].append(r["v"])
    for (key, value), (mean, dev) in found.items():
        if key is None:
            assert mean is None and dev is None
        else:
            assert mean == pytest.approx(sum(groups[key]) / len(groups[key]))
            assert dev == pytest.approx(value - mean)


def test_dictionary_codes(rows):
    coded = aggregates.dictionary_encode(rows, ["k"]).select("k", "k_cat").distinct().collect()
    codes = {r["k"]: r["k_cat"] for r in coded}
    assert codes.pop(None) is None
    assert [key for key, _ in sorted(codes.items(), key=lambda item: item[1])] == sorted(codes)
    assert sorted(codes.values()) == list(range(len(codes)))


def test_ids_fan_out_and_dedupe(spark):
    rows = spark.createDataFrame([("p", "　a "), ("p", "a"), ("p", "b"), ("q", "a"), ("q", None)], "page string, name string")
    ids = spark.createDataFrame([("p", "a", "1"), ("p", " a", "1"), ("p", "a", "2"), ("q", "c", "3"), ("q", None, "4")], "page string, name string, id string")
    fanned = Counter(tuple(r) for r in joins.attach_ids(rows, ids, ["page"], "name").collect())
    assert fanned == Counter({("p", "a", "1"): 4, ("p", "a", "2"): 2, ("p", "b", None): 1, ("q", "a", None): 1, ("q", None, None): 1})
    single = Counter(tuple(r) for r in joins.attach_ids(rows, ids, ["page"], "name", dedupe=True).collect())
    assert single == Counter({("p", "a", "1"): 2, ("p", "b", None): 1, ("q", "a", None): 1, ("q", None, None): 1})


def test_tiers(spark):
    schema = "id int, html string"
    local = spark.createDataFrame([(1, "a"), (2, ""), (3, None)], schema)
    stored = spark.createDataFrame([(1, "x"), (2, "b"), (3, ""), (4, "d")], schema)
    assert dict(joins.first_tier([local, stored], ["id"], "html").collect()) == {1: "a", 2: "b", 4: "d"}
    wanted = spark.createDataFrame([(i,) for i in (1, 2, 3, 3, 9)], "id int")
    assert sorted(r[0] for r in joins.still_missing(wanted, stored, ["id"], content="html").collect()) == [3, 9]
