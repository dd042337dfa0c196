import os
import shutil
import time

from furlong.schemas import PAGE
from furlong.sources.pages import page_table
from furlong.streaming.ingest import first_copies, ingest, land_batch, page_stream, read_landed


def write(folder, date, race_id, html, at):
    path = f"{folder}/race_date={date}"
    os.makedirs(path, exist_ok=True)
    name = f"{path}/{race_id}.html"
    with open(name, "w") as out:
        out.write(html)
    os.utime(name, (at, at))


def run(spark, folder):
    source = page_stream(spark, f"{folder}/in")
    ingest(source, f"{folder}/table", f"{folder}/progress", order=["landed_at"])
    landed = read_landed(spark, f"{folder}/table", source.schema)
    return sorted((r["race_date"], r["race_id"], r["html"]) for r in landed.collect())


def test_increments_equal_one_batch(spark, folder):
    now = time.time() - 100
    write(f"{folder}/in", "20240106", "01", "a\nb", now)
    write(f"{folder}/in", "20240106", "02", "", now)
    first = [("20240106", "01", "a\nb")]
    assert run(spark, folder) == first
    assert run(spark, folder) == first
    write(f"{folder}/in", "20240107", "01", "c", now + 10)
    write(f"{folder}/in", "20240105", "09", "old", now + 20)
    both = sorted([*first, ("20240107", "01", "c"), ("20240105", "09", "old")])
    assert run(spark, folder) == both
    shutil.copytree(f"{folder}/in", f"{folder}/again/in")
    assert run(spark, f"{folder}/again") == both


def test_a_page_without_a_date_lands_once(spark, folder):
    batch = spark.createDataFrame([(None, "01", "a"), ("20240106", "02", "b")], PAGE)
    for batch_id, rows in enumerate((batch, batch, batch.filter("race_date IS NULL"))):
        land_batch(rows, batch_id, f"{folder}/table", ["race_id"], "html", [], "race_date")
    assert sorted(r["race_id"] for r in read_landed(spark, f"{folder}/table", PAGE).collect()) == ["01", "02"]


def test_a_batch_may_run_twice(spark, folder):
    table = f"{folder}/table"
    keys = ["race_date", "race_id"]
    batches = [[("20240106", "01", "a"), ("20240106", "01", "a")], [("20240106", "01", "later"), ("20240107", "01", "b"), ("20240107", "02", "")]]
    for batch_id in (0, 1, 1):
        batch = spark.createDataFrame(batches[batch_id], PAGE)
        land_batch(batch, batch_id, table, keys, "html", [], "race_date")
    found = read_landed(spark, table, PAGE).select("race_date", "race_id", "html")
    assert sorted(tuple(r) for r in found.collect()) == [("20240106", "01", "a"), ("20240107", "01", "b")]


def test_the_landed_table_is_a_source_of_pages(spark, folder):
    for batch_id, rows in enumerate([[("20240106", "01", "a")], [("20240107", "01", "b"), ("20240106", "02", "c")]]):
        land_batch(spark.createDataFrame(rows, PAGE), batch_id, f"{folder}/t", ["race_date", "race_id"], "html", [], "race_date")
    found = page_table(spark, f"{folder}/t")("20240107", None)
    assert found.columns == ["race_date", "race_id", "html"]
    assert [tuple(r) for r in found.collect()] == [("20240107", "01", "b")]
    assert page_table(spark, f"{folder}/t")(None, None).count() == 3


def test_an_unpartitioned_table(spark, folder):
    schema = "id int, html string"
    for batch_id, rows in enumerate([[(1, "a"), (2, "b")], [(2, "x"), (3, "c")], []]):
        land_batch(spark.createDataFrame(rows, schema), batch_id, f"{folder}/t", ["id"], "html", [], None)
    found = read_landed(spark, f"{folder}/t", spark.createDataFrame([], schema).schema)
    assert dict(found.collect()) == {1: "a", 2: "b", 3: "c"}


def test_first_copy_wins(spark):
    df = spark.createDataFrame([(1, "new", 5), (1, "old", 2), (2, "x", 1)], "id int, html string, at int")
    assert {(r["id"], r["html"]) for r in first_copies(df, ["id"], ["at"]).collect()} == {(1, "old"), (2, "x")}


def test_repeats_within_the_limit_are_dropped_by_state(spark, folder):
    """The table is not looked at; the state holds the keys of the limit only."""
    hour = 3600
    start = 1_700_000_000
    increments = [
        [("20240106", "01", "a", 0), ("20240106", "02", "", 0), ("20240106", "03", "c", 1)],
        [("20240106", "01", "again", 2), ("20240107", "04", "d", 3)],
        [("20240107", "05", "e", 100)],
        [("20240107", "04", "late", 3), ("20240107", "06", "f", 101), ("20240106", "01", "after the limit", 101)],
    ]
    from pyspark.sql import functions as F

    state = []
    for rows in increments:
        df = spark.createDataFrame([(d, i, h, start + at * hour) for d, i, h, at in rows], "race_date string, race_id string, html string, at long")
        df.withColumn("landed_at", F.timestamp_seconds("at")).drop("at").coalesce(1).write.mode("append").parquet(f"{folder}/in")
        source = spark.readStream.schema("race_date string, race_id string, html string, landed_at timestamp").parquet(f"{folder}/in")
        ingest(source, f"{folder}/table", f"{folder}/progress", keys=["race_date", "race_id"], within="24 hours")
        landed = read_landed(spark, f"{folder}/table", source.schema)
        state.append(sorted((r["race_id"], r["html"]) for r in landed.collect()))
    assert state[0] == [("01", "a"), ("03", "c")]
    assert state[1] == [("01", "a"), ("03", "c"), ("04", "d")]
    assert state[2] == [*state[1], ("05", "e")]
    # a page that is late by more than the limit is dropped; a key may land again once the limit is over
    assert state[3] == sorted([*state[2], ("06", "f"), ("01", "after the limit")])
