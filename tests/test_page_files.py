import os

import pytest

from furlong.sources import page_files
from furlong.sources.pages import scan_pages

SCHEMA = "race_date string, race_id string, html string"
ROWS = [(f"202401{d:02d}", f"{d}{i}", f"<p>{d}é{i}\r\n</p>" * (d * 30)) for d in range(1, 9) for i in range(5)]


@pytest.fixture
def written(spark, folder):
    page_files.register(spark)
    path = f"{folder}/pages"
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.format("page_files").mode("append").save(path)
    return path


def test_pages_come_back(spark, written):
    found = page_files.read(spark, written)
    assert sorted(tuple(r) for r in found.collect()) == sorted(ROWS)
    assert sorted(tuple(r) for r in scan_pages(spark, written).collect()) == sorted(ROWS)
    assert not [n for _, _, names in os.walk(written) for n in names if n.startswith("_")]


def test_a_range_of_dates_is_pushed_down(spark, written):
    found = page_files.read(spark, written).filter("race_date >= '20240103' AND race_date < '20240105' AND race_id <> '31'")
    assert sorted(tuple(r) for r in found.collect()) == sorted(r for r in ROWS if r[0] in ("20240103", "20240104") and r[1] != "31")
    reader = page_files.PageReader({"path": written})
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, LessThan

    left = list(reader.pushFilters([GreaterThanOrEqual(("race_date",), "20240103"), LessThan(("race_date",), "20240105"), EqualTo(("race_id",), "3")]))
    assert [f.attribute for f in left] == [("race_id",)]
    assert {os.path.basename(os.path.dirname(f)) for s in reader.partitions() for f in s.files} == {"race_date=20240103", "race_date=20240104"}


def test_splits_are_bounded_by_bytes(spark, written):
    page_files.OPEN_BYTES, before = 0, page_files.OPEN_BYTES
    try:
        splits = page_files.PageReader({"path": written, "splitBytes": "5000"}).partitions()
    finally:
        page_files.OPEN_BYTES = before
    sizes = [sum(os.path.getsize(f) for f in s.files) for s in splits]
    assert len(splits) > 5 and max(sizes) < 5000 + max(len(r[2].encode()) for r in ROWS) and sum(len(s.files) for s in splits) == len(ROWS)


def test_a_write_that_breaks_off_shows_nothing(spark, folder):
    page_files.register(spark)
    path = f"{folder}/pages"
    bad = spark.createDataFrame([*ROWS, ("20240101", None, "x")], SCHEMA).coalesce(1)
    with pytest.raises(Exception, match="needs a date and an id"):
        bad.write.format("page_files").mode("append").save(path)
    os.makedirs(path, exist_ok=True)
    assert page_files.read(spark, path).count() == 0
    with pytest.raises(Exception, match="only added"):
        spark.createDataFrame(ROWS, SCHEMA).write.format("page_files").mode("overwrite").save(path)


def test_an_empty_folder(spark, folder):
    page_files.register(spark)
    assert page_files.read(spark, folder).collect() == []
