import pytest
from pyspark.sql import Window, functions as F

from furlong.operators import aggregates, skew
from furlong.operators.aggregates import encode_with, mean_before
from furlong.sources import commits, growing


def lines(spark, count=3000, hot=True):
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 7 % 400).cast("int"))
    key = F.when((F.col("id") % 3 == 0) & F.lit(hot), -1).otherwise(F.col("id") % 97)
    rows = spark.range(count).select("id", key.alias("horse"), day.alias("day"), (F.col("id") % 13).cast("double").alias("value"))
    odd = spark.createDataFrame([(-1, None, None, 1.0), (-2, 5, None, 1.0), (-3, None, None, None)], "id long, horse long, day date, value double")
    return rows.unionByName(odd).withColumn("value", F.when(F.col("id") % 11 != 0, F.col("value")))


def test_mean_up_to_the_day_before(spark):
    rows = lines(spark)
    window = Window.partitionBy("horse").orderBy("number").rangeBetween(Window.unboundedPreceding, -1)
    numbered = rows.withColumn("number", F.datediff("day", F.lit("2020-01-01")))
    known = F.col("horse").isNotNull() & F.col("day").isNotNull()
    expected = {r["id"]: r["m"] for r in numbered.filter(known).withColumn("m", F.avg("value").over(window)).collect()}
    expected |= {r["id"]: None for r in numbered.filter(~known).collect()}
    found = mean_before(rows, "horse", "day", "value", "m")
    assert found.columns == [*rows.columns, "m"]
    own = {r["id"]: r["m"] for r in found.collect()}
    assert own.keys() == expected.keys()
    assert all(own[i] == (None if expected[i] is None else pytest.approx(expected[i])) for i in own)


@pytest.fixture
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_key_over_many_ranges_carries_on(spark, many_ranges):
    """One key holds a third of the rows; the ranges stay of about equal size, and its sums go on over their borders."""
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 50 + 10).alias("k"), "id", F.lit(1).alias("n"))
    placed = skew._placed(rows, ["k", "id"])
    sizes = [r["count"] for r in placed.groupBy("__part").count().collect()]
    assert len(sizes) > 5 and max(sizes) < 9000 / len(sizes) * 2
    found = skew.keyed_running_totals(rows, "k", ["id"], {"before": "n"}).collect()
    seen = {}
    for r in sorted(found, key=lambda r: (r["k"], r["id"])):
        assert r["before"] == seen.get(r["k"], 0)
        seen[r["k"]] = r["before"] + 1
    assert len(found) == 9000


def test_missing_keys_are_a_key(spark, many_ranges):
    rows = spark.createDataFrame([(None, i, 1) for i in range(20)] + [(1, i, 1) for i in range(20)], "k int, id int, n int").repartition(4)
    found = skew.keyed_running_totals(rows, "k", ["id"], {"before": "n"}).collect()
    assert all(r["before"] == r["id"] for r in found)
    assert skew.keyed_running_totals(rows.limit(0), "k", ["id"], {"before": "n"}).collect() == []


def test_increments_of_means_equal_one_count(spark, folder):
    rows = lines(spark)
    parts = [rows.filter(F.pmod("id", F.lit(3)) == i) for i in range(3)]
    for part in [*parts, rows.limit(0)]:
        growing.grow_means(spark, folder, part, "horse", "value", buckets=8)
    expected = {r["horse"]: r["m"] for r in rows.filter("horse IS NOT NULL AND value IS NOT NULL").groupBy("horse").agg(F.avg("value").alias("m")).collect()}
    found = {r["horse"]: r["m"] for r in growing.stored_means(spark, folder, "horse", "m").collect()}
    assert found == {k: pytest.approx(v) for k, v in expected.items()}
    before = growing.stored_means(spark, folder, "horse", "m", number=1)
    assert {r["horse"] for r in before.collect()} == {r["horse"] for r in parts[0].filter("horse IS NOT NULL AND value IS NOT NULL").collect()}


def test_only_touched_buckets_are_written(spark, folder):
    rows = spark.range(500).select(F.col("id").alias("k"), F.lit(1.0).alias("v"))
    first = growing.grow_means(spark, folder, rows, "k", "v", buckets=16)
    second = growing.grow_means(spark, folder, rows.filter("k = 3"), "k", "v", buckets=16)
    old, new = ({f["path"] for f in c.tables["sums"].files} for c in (first, second))
    assert len({f["part"] for f in first.tables["sums"].files}) == 16
    gone = [f for f in first.tables["sums"].files if f["path"] not in new]
    assert len({f["part"] for f in gone}) == 1 and len(new - old) == 1
    assert second.tables["sums"].rows == 500
    found = {r["k"]: r["m"] for r in growing.stored_means(spark, folder, "k", "m").collect()}
    assert found == {k: 1.0 for k in range(500)}


def test_codes_never_change(spark, folder):
    def values(*names):
        return spark.createDataFrame([(n,) for n in names], "v string")

    growing.grow_codes(spark, folder, values("m", "b", None, "b"), "v")
    assert dict(growing.stored_codes(spark, folder, "v", "c").collect()) == {"b": 0, "m": 1}
    growing.grow_codes(spark, folder, values("z", "a", "m"), "v")
    growing.grow_codes(spark, folder, values("a", "b"), "v")
    codes = growing.stored_codes(spark, folder, "v", "c")
    assert dict(codes.collect()) == {"b": 0, "m": 1, "a": 2, "z": 3}
    # what was coded earlier reads the same codes
    early = growing.stored_codes(spark, folder, "v", "c", number=1)
    rows = values("m", "z")
    assert {r["v"]: r["c"] for r in encode_with(rows, {"v": early}).collect()} == {"m": 1, "z": None}
    assert {r["v"]: r["c"] for r in encode_with(rows, {"v": codes}).collect()} == {"m": 1, "z": 3}


def test_of_two_writers_one_fails(spark, folder):
    start = growing.grow_codes(spark, folder, spark.createDataFrame([("a",)], "v string"), "v")
    growing.grow_codes(spark, folder, spark.createDataFrame([("b",)], "v string"), "v", after=start)
    with pytest.raises(commits.ConflictError):
        growing.grow_codes(spark, folder, spark.createDataFrame([("c",)], "v string"), "v", after=start)
    assert dict(growing.stored_codes(spark, folder, "v", "c").collect()) == {"a": 0, "b": 1}


def test_places_within_dates(spark):
    rows = spark.createDataFrame([(d, i) for d in ("x", "y", None) for i in (3, 1, 1, 2)], "d string, i int").repartition(3)
    found = {(r["d"], r["place"]): r["i"] for r in aggregates.placed_ids(rows, "d", "i").collect()}
    assert found == {(d, p): i for d in ("x", "y", None) for p, i in enumerate((1, 1, 2, 3))}
