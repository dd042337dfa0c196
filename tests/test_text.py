import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from furlong.functions import text
from furlong.functions.encode import label_code
from furlong.operators import project
from furlong import fixed_values as fixed


def values(spark, column, inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, c string").select("i", column.alias("o"))
    return [r["o"] for r in sorted(df.collect())]


def test_numbers(spark):
    inputs = ["牡3", "x12y34", "none", "", None]
    assert values(spark, text.first_int("c"), inputs) == [3, 12, None, None, None]
    assert values(spark, text.leading_int("c"), ["10:10発走", " 9", None]) == [10, None, None]
    assert values(spark, text.signed_int_in_parens("c"), ["480(+4)", "480(-12)", "(0)", "計不", "()", None]) == [4, -12, 0, None, None, None]


def test_full_width_digits_match_but_do_not_cast(spark):
    assert values(spark, text.first_match("c", f"({text.DIGITS}+)"), ["牡３"]) == ["３"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, text.first_int("c"), ["牡３"])
    assert values(spark, text.first_int("c", strict=False), ["牡３"]) == [None]


def test_trim(spark):
    assert values(spark, text.trim_space("c"), ["　馬　 名 \n", " ", None]) == ["馬　 名", "", None]


def test_split_fields(spark):
    line = " 10:10発走 / ダ1400m (左)　/ 天候:晴"
    df = spark.createDataFrame([(line,), ("",), (None,)], "c string").select(*text.split_fields("c", 4))
    assert [tuple(r) for r in df.collect()] == [("10:10発走", "ダ1400m(左)", "天候:晴", None), ("", None, None, None), (None,) * 4]


def test_lists(spark):
    assert values(spark, text.split_blank("c"), ["5 3 8", "5  3", "", None]) == [["5", "3", "8"], ["5", "", "3"], [""], None]
    assert values(spark, text.digit_runs("c"), ["1,230円", "150円200円", "なし", None]) == [["1230"], ["150200"], [], None]
    assert values(spark, text.digit_runs("c"), ["150円 200円 1,330円"]) == [["150", "200", "1330"]]


def test_links_and_paths(spark):
    assert values(spark, text.query_value("c", "race_id"), ["r.html?race_id=2024_01&x=1", "r.html"]) == ["2024_01", None]
    assert values(spark, text.query_value("c", "kaisai_date", fixed.DATE_VALUE), ["?kaisai_date=20240106", "?kaisai_date=2024"]) == ["20240106", None]
    assert values(spark, text.id_after("c", "jockey/result/recent"), ["/jockey/result/recent/01169/", "/jockey/1"]) == ["01169", None]
    assert values(spark, text.stem_of_path("c"), ["a/b/0601.html", "a/b.txt"]) == ["0601", None]
    assert values(spark, text.path_value("c", "race_date"), ["a/race_date=20240106/b", "a/b"]) == ["20240106", None]
    assert spark.range(1).select(text.year_month(F.lit(2024), F.lit(1))).first()[0] == "202401"


def test_flat_pages(spark):
    page = '<html lang="fr"><title> a &amp;amp; b </title><h1 class="x">c</h1><h1>d</h1><a class="k" href="/p">q &lt;</a><a href="/r"><b>s</b></a>'
    assert values(spark, text.attribute("c", "html", "lang"), [page, "<p>"]) == ["fr", None]
    assert values(spark, text.element_text("c", "title"), [page, "<p>"]) == ["a &amp; b", None]
    assert values(spark, text.element_text("c", "h1"), [page]) == ["c"]
    assert [[tuple(x) for x in v] for v in values(spark, text.flat_links("c"), [page])] == [[("/p", "q <")]]


@pytest.mark.parametrize(
    "value, code", [("天候:晴", 0), ("小雨", 2), ("雨", 3), ("小雪", 4), ("雪", 5), ("雨小雪", 3), ("晴小雨", 0), ("霧", -1), ("", -1), (None, -1)]
)
def test_label_codes(spark, value, code):
    assert values(spark, label_code("c", fixed.WEATHER_CODES), [value]) == [code]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="晴曇小雨雪 x", max_size=6), min_size=1, max_size=30))
def test_label_code_is_minus_one_exactly_without_a_label(spark, inputs):
    pattern = "|".join(fixed.WEATHER_CODES)
    found = values(spark, label_code("c", fixed.WEATHER_CODES), inputs)
    for value, code in zip(inputs, found):
        match = re.search(pattern, value)
        assert code == (fixed.WEATHER_CODES[match.group()] if match else -1)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet=" \t　  ab", max_size=8), min_size=1, max_size=30))
def test_trim_is_python_strip_and_idempotent(spark, inputs):
    once = values(spark, text.trim_space("c"), inputs)
    assert once == [value.strip() for value in inputs]
    assert values(spark, text.trim_space("c"), once) == once


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.tuples(st.text("ab", max_size=2), st.integers(0, 9)), max_size=5), min_size=1, max_size=10))
def test_explode_then_collect_gives_the_lists_back(spark, inputs):
    rows = [(i, [a for a, _ in pairs], [b for _, b in pairs]) for i, pairs in enumerate(inputs)]
    df = spark.createDataFrame(rows, "i int, a array<string>, b array<int>")
    found = {i: [] for i in range(len(inputs))}
    for r in project.explode_together(df, ["a", "b"]).collect():
        found[r["i"]].append((r["a"], r["b"]))
    assert found == {i: [*map(tuple, pairs)] or [(None, None)] for i, pairs in enumerate(inputs)}


def test_concat_refuses_other_schemas(spark):
    one, two = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(1,)], "a long")
    with pytest.raises(ValueError, match="frame 1"):
        project.concat_rows([one, two])
    assert project.concat_rows([one, one]).count() == 2


def test_renames_and_drops_need_the_column(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        project.rename_columns(df, {"b": "c"})
    with pytest.raises(ValueError):
        project.drop_columns(df, "b")


def test_filters_drop_nulls(spark):
    df = spark.createDataFrame([("2歳新馬",), ("障害",), (None,)], "race_name string")
    assert [r[0] for r in project.drop_containing(df, "race_name", fixed.DEBUT_RACE).collect()] == ["障害"]
    assert [r[0] for r in project.drop_listed(df, "race_name", ("障害",)).collect()] == ["2歳新馬"]


def test_literals_are_text(spark):
    df = project.add_literals(spark.range(1), {"a": "x", "b": None})
    assert dict(df.dtypes) == {"id": "bigint", "a": "string", "b": "string"}
    assert tuple(df.first()) == (0, "x", None)


def test_label_and_name_are_null_together(spark):
    df = spark.createDataFrame([("美浦", "加藤"), (None, "加藤"), ("美浦", None)], "a string, b string")
    assert [r[0] for r in df.select(project.join_text("a", "b")).collect()] == ["美浦加藤", None, None]


def test_entities_are_decoded_once(spark):
    import html

    texts = [
        "a &amp; b", "&lt;b&gt;&quot;&apos;", "&#65;&#x42;&#X43;&#12354;&#x1F600;", "&amp;lt; &#38;lt; &#38;#65;", "no entity", "", None,
        "&;&#;&#x;&unknown;&amp", "&#39;&nbsp;&middot;&copy;", "&#xD800;&#1114112;", "x\ny &#10; z",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = {r["i"]: r["u"] for r in df.select("i", text.unescape_basic("t").alias("u")).collect()}
    # without its semicolon an entity stays here
    expected = [None if t is None else html.unescape(re.sub("&amp$", "&amp;amp", t)) for t in texts]
    assert [found[i] for i in range(len(texts))] == expected
