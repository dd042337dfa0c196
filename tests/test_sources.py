import os

import pytest
from pyspark.sql import functions as F

from furlong.bindings.render import encode_text
from furlong.functions.encode import decode_bytes
from furlong.plans.monthly import store_month
from furlong.sources import extract, pages, tables


def land(folder, date, race_id, html, encoding="utf-8"):
    path = f"{folder}/race_date={date}" if date else folder
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{race_id}.html", "wb") as out:
        out.write(html.encode(encoding))


@pytest.fixture
def landed(folder):
    for date, race_id in (("20231231", "01"), ("20240106", "0601"), ("20240106", "0602"), ("20240107", "01")):
        land(folder, date, race_id, f"<p>一\n二 {date}</p>")
    land(folder, None, "stray", "<p>no date</p>")
    land(folder, "x1", "odd", "<p>no date</p>")
    return folder


def test_scan_keeps_whole_texts_and_leading_zeros(spark, landed):
    found = {(r["race_date"], r["race_id"]): r["html"] for r in pages.scan_pages(spark, landed).collect()}
    assert set(found) == {("20231231", "01"), ("20240106", "0601"), ("20240106", "0602"), ("20240107", "01")}
    assert found["20240107", "01"] == "<p>一\n二 20240107</p>"


@pytest.mark.parametrize(
    "first, last, count", [("20240106", "20240106", 2), ("20240106", None, 3), (None, "20240106", 3), (None, None, 4)]
)
def test_scan_range(spark, landed, first, last, count):
    assert pages.scan_pages(spark, landed, first, last).count() == count


def test_range_is_a_partition_filter(spark, landed):
    plan = pages.scan_pages(spark, landed, "20240106", "20240107")._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "(race_date" in filters and ">= 20240106" in filters


def test_folders_outside_the_range_are_not_listed(spark, landed):
    files = pages.scan_pages(spark, landed, "20240106", "20240106").inputFiles()
    assert len(files) == 2 and all("race_date=20240106" in f for f in files)
    assert tables.folders_in_range(spark, landed, "race_date", "20240107", None) == [f"{landed}/race_date=20240107", f"{landed}/race_date=x1"]
    assert tables.folders_in_range(spark, landed, "other", "20240107", None) == []
    assert pages.scan_pages(spark, landed, "20250101").count() == 0


def test_a_table_range_lists_its_folders_only(spark, folder):
    df = spark.createDataFrame([("20240106", 1), ("20240107", 2), ("20240201", 3)], "race_date string, n int")
    tables.write_partitioned(df, f"{folder}/t", "race_date")
    some = tables.read_dates(spark, f"{folder}/t", "race_date", "20240107", "20240131")
    assert [tuple(r) for r in some.select("race_date", "n").collect()] == [("20240107", 2)]
    assert all("race_date=20240107" in f for f in some.inputFiles())
    assert tables.read_dates(spark, f"{folder}/t", "race_date", "20250101").count() == 0


def test_scan_decodes(spark, folder):
    land(folder, "20240106", "01", "<p>騎手</p>", "euc_jp")
    (row,) = pages.scan_pages(spark, folder, charset="euc_jp").collect()
    assert tuple(row) == ("20240106", "01", "<p>騎手</p>")


def test_undecodable_bytes_are_replaced(spark):
    df = spark.createDataFrame([(b"a\xff",), (None,)], "c binary").select(decode_bytes("c").alias("t"))
    assert [r["t"] for r in df.collect()] == ["a�", None]


def test_encode_keeps_what_the_charset_lacks(spark):
    df = spark.createDataFrame([("馬😀",)], "t string").select(decode_bytes(encode_text("t")).alias("t"))
    assert df.first()["t"] == "馬&#128512;"


def test_keys_from_paths(spark):
    paths = spark.createDataFrame([("b/race_result/race_date=20240106/0601.html",), ("b/race_result/0602.html",)], "path string")
    found = pages.keys_from_paths(paths, "path").collect()
    assert [(r["race_date"], r["race_id"]) for r in found] == [("20240106", "0601")]


def test_partitioned_write_and_read(spark, folder):
    df = spark.createDataFrame([("20240106", 1), ("20240107", 2), ("20240201", 3)], "race_date string, n int")
    tables.write_partitioned(df, f"{folder}/t", "race_date")
    assert sorted(d for d in os.listdir(f"{folder}/t") if "=" in d) == ["race_date=20240106", "race_date=20240107", "race_date=20240201"]
    some = tables.read_dates(spark, f"{folder}/t", "race_date", "20240107")
    assert dict(some.dtypes)["race_date"] == "string"
    assert sorted(r["n"] for r in some.collect()) == [2, 3]
    assert "PartitionFilters: [isnotnull(race_date" in some._jdf.queryExecution().executedPlan().toString()


def test_a_hot_date_is_split_over_files(spark, folder):
    df = spark.range(1000).select(F.lit("20240106").alias("race_date"), "id")
    tables.write_partitioned(df, f"{folder}/t", "race_date", max_records=100)
    files = [f for f in os.listdir(f"{folder}/t/race_date=20240106") if f.endswith(".parquet")]
    assert len(files) >= 10
    assert tables.read_table(spark, f"{folder}/t").count() == 1000


def test_months(spark, folder):
    df = spark.createDataFrame([("20240106",), ("20240131",), ("20241201",)], "race_date string")
    tables.write_monthly(df, f"{folder}/m", "race_date")
    assert sorted(d for d in os.listdir(f"{folder}/m") if "=" in d) == ["ym=202401", "ym=202412"]


def test_versions(spark, folder):
    df = spark.range(5)
    assert not tables.is_published(spark, tables.version_path(folder, "v1", "t"))
    assert tables.read_or_build(spark, folder, "v1", "t", lambda: df).count() == 5
    assert tables.read_or_build(spark, folder, "v1", "t", lambda: spark.range(9)).count() == 5
    assert os.path.isdir(f"{folder}/data_version=v1/t.parquet")
    with pytest.raises(FileExistsError):
        tables.publish(df, folder, "v1", "t")


def test_unfinished_write_is_no_version_and_no_rubbish(spark, folder):
    path = tables.version_path(folder, "v1", "t")
    spark.range(5).write.parquet(path)
    with pytest.raises(FileExistsError, match="unfinished"):
        tables.read_or_build(spark, folder, "v1", "t", lambda: spark.range(9))
    tables.publish(spark.range(9), folder, "v1", "t", replace=True)
    assert tables.read_or_build(spark, folder, "v1", "t", lambda: spark.range(1)).count() == 9


def test_a_version_without_success_marks_is_finished(spark, folder):
    spark.sparkContext._jsc.hadoopConfiguration().set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        tables.publish(spark.range(5), folder, "v1", "t")
        with pytest.raises(FileExistsError, match="is there"):
            tables.publish(spark.range(9), folder, "v1", "t")
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_a_second_month_leaves_the_first(spark, folder):
    schema = "race_date string, n int"
    for rows in ([("20240106", 1), ("20240207", 2)], [("20240301", 3)], [("20240208", 4)]):
        store_month([spark.createDataFrame(rows, schema)], f"{folder}/m")
    assert sorted(r["n"] for r in spark.read.parquet(f"{folder}/m").collect()) == [1, 3, 4]


def test_bad_pages_fail_or_are_kept(spark):
    df = spark.createDataFrame([(1, "<table><tr><th>a</tr><tr><td>x</table>"), (2, "<p>"), (3, None)], "id int, html string")
    with pytest.raises(Exception, match="page \\(2,\\): no table"):
        extract.read_table(df, ["id"], "html", {"a": "a"}).collect()
    kept = extract.read_table(df, ["id"], "html", {"a": "a"}, errors="keep").collect()
    assert {(r["id"], r["a"], r["error"]) for r in kept} == {(1, "x", None), (2, None, "ValueError: no table")}
    with pytest.raises(Exception, match="no column b"):
        extract.read_table(df.filter("id = 1"), ["id"], "html", {"b": "b"}).collect()


def test_an_empty_table_is_passed_over(spark):
    page = '<table style="display:none"><tr><th>a<tr><td>h</table>' "<table><tr><td> </td></tr></table><table><tr><th>a</tr><tr><td>x</table>"
    df = spark.createDataFrame([(1, page)], "id int, html string")
    assert [r["a"] for r in extract.read_table(df, ["id"], "html", {"a": "a"}).collect()] == ["x"]


def test_headings(spark):
    page = '<div class="Box"><p class="Name">\n 一 <b>二</b></p></div>'
    df = spark.createDataFrame([(1, page), (2, "<p>")], "id int, html string")
    found = extract.read_headings(df, ["id"], "html", {"name": ("Box", "Name"), "box": ("Box",)})
    assert [tuple(r) for r in found.collect()] == [(1, "一二", "一二"), (2, None, None)]


def test_short_rows_and_blank_cells_are_null(spark):
    page = "<table><tr><th>a<th>b</tr><tr><td>1</tr><tr><td> <td>2</table>"
    df = spark.createDataFrame([(1, page)], "id int, html string")
    found = extract.read_table(df, ["id"], "html", {"b": "b", "a": "a"}).collect()
    assert [(r["a"], r["b"]) for r in found] == [("1", None), (None, "2")]


def test_links_and_labels(spark):
    page = (
        '<table class="T"><tr><td><span>美浦</span><a href="https://x/trainer/result/recent/0116/">加藤</a></td>'
        '<td><a href="/horse/2021_１"> 馬 </a><a href="/horse/">none</a><a>bare</a></td></tr></table>'
        '<a href="/horse/99">outside</a>'
    )
    df = spark.createDataFrame([(1, page)], "id int, html string")
    horses = extract.read_links(df, ["id"], "html", "horse", "horse_name", "horse", within_class="T")
    assert [tuple(r) for r in horses.collect()] == [(1, " 馬 ", "2021_１")]
    trainers = extract.read_links(df, ["id"], "html", "trainer/result/recent", "trainer_name", "trainer", "T", with_label=True)
    assert trainers.columns == ["id", "trainer_name", "trainer_id", "trainer_label"]
    assert [tuple(r) for r in trainers.collect()] == [(1, "美浦加藤", "0116", "美浦")]


def test_only_key_and_text_reach_python(spark, folder):
    spark.createDataFrame([(1, "<p>", "x")], "id int, html string, other string").write.parquet(f"{folder}/p")
    df = extract.read_cells(spark.read.parquet(f"{folder}/p"), ["id"], "html")
    assert "ReadSchema: struct<id:int,html:string>" in df._jdf.queryExecution().executedPlan().toString()


def test_scans_with_few_splits_are_spread(spark, folder):
    spark.range(100).coalesce(1).write.parquet(f"{folder}/t")
    table = spark.read.parquet(f"{folder}/t")
    assert tables.spread_scan(table, ["id"]).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    spark.range(0, 100, 1, 64).write.parquet(f"{folder}/w")
    wide = spark.read.parquet(f"{folder}/w")
    assert tables.spread_scan(wide, ["id"]) is wide
