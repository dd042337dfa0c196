import pytest

from furlong import fixed_values as fixed
from furlong.plans import monthly
from furlong.schemas import PAGE
from furlong.sources import tables
from tests.pages import result_page, runner


def test_dates_of_a_calendar(spark):
    page = (
        '<a href="?kaisai_date=20230101">outside</a><table class="Calendar_Table"><tr><td>'
        '<a href="../top/race_list.html?kaisai_date=20240106">6</a><a href="/other">x</a><a>y</a>'
        '<a href="race_list.html?kaisai_date=20240107&amp;rf=1">7</a><a href="?kaisai_date=2024">z</a></td></tr></table>'
    )
    df = spark.createDataFrame([("202401", page)], "ym string, html string")
    assert [(r["ym"], r["race_date"]) for r in monthly.race_dates(df, ["ym"]).collect()] == [("202401", "20240106"), ("202401", "20240107")]


DAY = (
    '<ul><li class="RaceList_DataItem"><a href="../race/result.html?race_id=202406010101&rf=race_list">1R</a><a href="?race_id=9">movie</a></li>'
    '<li class="RaceList_DataItem"><a href="/race/202406010199">no id</a></li><li><a href="?race_id=7">other item</a></li>'
    '<li class="RaceList_DataItem x"><a href="../race/result.html?race_id=202406010102">2R</a></li></ul>'
)


def test_ids_of_a_day_and_pages_to_fetch(spark):
    days = spark.createDataFrame([("20240106", DAY), ("20240107", DAY)], "race_date string, html string")
    found = monthly.race_ids(days)
    assert {(r["race_date"], r["race_id"]) for r in found.collect()} == {
        (date, race) for date in ("20240106", "20240107") for race in ("202406010101", "202406010102")
    }
    landed = spark.createDataFrame(
        [("20240106", "202406010101", "<p>"), ("20240107", "202406010101", "")], "race_date string, race_id string, html string"
    )
    assert {tuple(r) for r in monthly.pages_to_fetch(days, landed).collect()} == {
        ("20240106", "202406010102"), ("20240107", "202406010101"), ("20240107", "202406010102"),
    }


def test_history_and_profile(spark):
    head = "".join(f"<th>{name.replace(' ', '<br>')}</th>" for name in fixed.HISTORY_COLUMNS + ["映 像"])
    rows = "".join("<tr>" + "".join(f"<td>{i}-{j}</td>" for j in range(24)) + "</tr>" for i in range(2))
    page = (
        '<table class="db_prof_table no_OwnerUnit"><tr><th>生年月日</th><td>2021年</td></tr><tr><th>調教師</th><td></td></tr></table>'
        f'<table class="db_prof_table"><tr><td>second</td></tr></table><table class="db_h_race_results nk">'
        f"<thead><tr>{head}</tr></thead><tbody>{rows}</tbody></table>"
    )
    df = spark.createDataFrame([("h1", page)], "horse_id string, html string")
    history = monthly.horse_history(df, ["horse_id"])
    assert history.columns == ["horse_id", *fixed.HISTORY_COLUMNS]
    assert [(r["日付"], r["賞金"]) for r in history.collect()] == [("0-0", "0-22"), ("1-0", "1-22")]
    profile = monthly.horse_profile(df, ["horse_id"]).collect()
    assert [(r["row_no"], r["cells"]) for r in profile] == [(0, ["生年月日", "2021年"]), (1, ["調教師", None])]


def test_a_month_is_stored(spark, folder):
    schema = "race_date string, horse_id string"
    frames = [
        spark.createDataFrame([("20240106", "h2"), ("20240106", "h1")], schema),
        spark.createDataFrame([("20240106", "h1"), ("20240207", "h3")], schema),
    ]
    monthly.store_month(frames, f"{folder}/m")
    january = tables.read_dates(spark, f"{folder}/m", "ym", "202401", "202401")
    assert january.count() == 3
    lists = {r["race_date"]: r["horse_ids"] for r in monthly.horses_per_date(january).collect()}
    assert lists == {"20240106": ["h1", "h1", "h2"]}


@pytest.mark.parametrize("broken", ["", "<p>nothing</p>"])
def test_collect_month(spark, folder, broken):
    calendar = '<table class="Calendar_Table"><tr><td><a href="?kaisai_date=20240106">6</a></table>'
    page = result_page([(runner(), ("h01", "j01", "t01")), (runner(horse_number="6", horse_name="コマ", jockey_name="騎手乙", trainer_name="伊藤"), ("h02", "j02", "t02"))])
    month = monthly.collect_month(
        spark,
        spark.createDataFrame([(calendar,)], "html string"),
        spark.createDataFrame([("20240106", DAY), ("20240107", DAY)], "race_date string, html string"),
        spark.createDataFrame([("20240106", "202406010101", page), ("20240106", "other", page), ("20240106", "202406010102", broken)], PAGE),
        f"{folder}/m",
    )
    assert [r["race_id"] for r in month.rejects.collect()] == [reject for reject in ["202406010102"] if broken]
    rows = month.rows.collect()
    assert {(r["race_id"], r["horse_number"], r["馬名"], r["着 順"]) for r in rows} == {
        ("202406010101", "5", "ウマ", "1"), ("202406010101", "6", "コマ", "1"),
    }
    assert [(r["race_date"], r["horse_ids"]) for r in month.horses.collect()] == [("20240106", ["h01", "h02"])]
    assert [tuple(r) for r in month.missing.collect()] == ([] if broken else [("20240106", "202406010102")])
