"""One query per operator over whole given tables."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict
from functools import wraps

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from furlong import fixed_values as fixed
from furlong.bindings import render
from furlong.functions import text
from furlong.functions.encode import decode_bytes, label_code
from furlong.operators import aggregates, joins, project
from furlong.plans import boosting, model, monthly, race_result, search
from furlong.plans.features import preprocess
from furlong.session import configure, cut_lineage, scratch_path
from furlong.sources import commits, extract, flat, growing, page_files, tables
from furlong.sources.pages import scan_pages
from furlong.streaming.ingest import LANDED_AT, ingest, read_landed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TRAIN_FIRST, TRAIN_LAST = "19960101", "19981231"
PART_CODES = {"widget": 0, "bolt": 1, "gear": 2}


def query(function: Query) -> Query:
    """Register under the function's name; apply the library's session settings first."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_for_python(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table whose rows are read in Python next: at least one split per slot."""
    return tables.spread_scan(load(spark, sf_dir, name), [key])


def yyyymmdd(column: str) -> Column:
    return F.date_format(column, "yyyyMMdd")


def races(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").withColumn("race_date", yyyymmdd("o_orderdate"))


# -- features ------------------------------------------------------------------


@query
def feature_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    orders = project.drop_listed(orders, "o_orderstatus", ("P",)).select("o_orderkey")
    parts = project.drop_containing(load(spark, sf_dir, "part"), "p_name", "ring")
    parts = parts.select(
        "p_partkey",
        label_code("p_name", PART_CODES).alias("part_code"),
        text.first_int("p_brand").alias("brand_no"),
    )
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    rows = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .drop("o_orderkey", "p_partkey")
    )
    # the joined rows are needed twice, for the means and for the deviations: join once
    rows = cut_lineage(rows, "typed")
    out = aggregates.deviation_from_mean(rows, "l_partkey", "l_quantity", "mean", "dev")
    return out.withColumns({"mean": F.round("mean", 6), "dev": F.round("dev", 6)})


@query
def typed_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_size").cast("string").alias("size"), F.col("p_retailprice").cast("string").alias("price")
    )
    return part.select(
        "p_partkey",
        text.to_number(F.col("size"), "int").alias("size_int"),
        text.to_number(F.col("price"), "double").alias("price_double"),
        text.to_number(F.col("size"), "float").alias("size_float"),
        project.is_first(F.col("size").cast("int")).alias("label"),
    )


@query
def rename_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"s_suppkey": "trainer_id", "s_name": "trainer_name", "s_acctbal": "balance"}
    return project.drop_columns(project.rename_columns(load(spark, sf_dir, "supplier"), names), "s_nationkey")


@query
def add_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.add_literals(load(spark, sf_dir, "supplier"), {"race_date": "20240106", "race_name": None})


@query
def regex_first_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part")
    return part.select("p_partkey", text.first_int("p_brand").alias("brand_no"), text.first_int("p_type").alias("type_no"))


@query
def regex_anchored_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        text.leading_int("o_orderpriority").alias("priority"),
        text.leading_int("o_orderstatus").alias("status_no"),
    )


@query
def regex_signed_paren(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", text.signed_in_parens("text").alias("number"))


@query
def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part")
    name = F.nullif("p_name", F.lit("red bolt"))
    return part.select("p_partkey", label_code(name, PART_CODES).alias("code"))


@query
def trim_unicode(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load(spark, sf_dir, "customer")
    padded = F.concat(F.lit("　 \t"), "c_name", F.lit(" 　\n "))
    label = F.nullif("c_mktsegment", F.lit("MACHINERY"))
    return customer.select(
        "c_custkey", text.trim_space(padded).alias("name"), project.join_text(label, F.col("c_name")).alias("labelled")
    )


@query
def strip_split_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part")
    line = F.concat_ws(
        "　/ ",
        "p_brand",
        F.col("p_size").cast("string"),
        F.when(F.col("p_size") > 10, F.col("p_name")),
        F.when(F.col("p_size") > 30, F.col("p_type")),
    )
    fields = text.split_fields(line, 4)
    names = ["start_at", "distance", "weather", "field_condition"]
    return part.select("p_partkey", *[field.alias(name) for field, name in zip(fields, names)])


@query
def replace_extract_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    priced = F.concat(F.format_number(F.floor("o_totalprice"), 0), F.lit("円 "), "o_orderpriority")
    return orders.select("o_orderkey", F.array_join(text.digit_runs(priced), "|").alias("digits"))


@query
def dict_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("supplier"),
        F.nullif("l_returnflag", F.lit("N")).alias("flag"),
    )
    return aggregates.dictionary_encode(lines, ["supplier", "flag"])


# -- filters -------------------------------------------------------------------


@query
def filter_not_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part").withColumn("p_name", F.nullif("p_name", F.lit("red bolt")))
    return project.drop_containing(part, "p_name", "ring").select("p_partkey", "p_name")


@query
def filter_not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("O")))
    return project.drop_listed(orders, "o_orderstatus", ("P",)).select("o_orderkey", "o_orderstatus")


@query
def filter_date_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = project.between_days(load(spark, sf_dir, "orders"), "o_orderdate", "19960101", "19961231")
    return orders.select("o_orderkey", yyyymmdd("o_orderdate").alias("race_date"))


@query
def time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = model.split_name("race_date", TRAIN_FIRST, TRAIN_LAST)
    return races(spark, sf_dir).select("o_orderkey", "race_date", split.alias("split"))


# -- joins ---------------------------------------------------------------------


def page_names(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Names listed on a page, padded, and the names and ids of its links."""
    pages = load(spark, sf_dir, "pages")
    items = flat.item_links(pages, ["page_id"], "html")
    rows = items.select("page_id", "item_no", F.concat(F.lit("　"), "text").alias("name"))
    links = text.flat_links("html")
    ids = pages.select("page_id", F.explode(links).alias("link")).select(
        "page_id", F.col("link.text").alias("name"), text.id_after("link.href", "").alias("name_id")
    )
    return rows, ids


@query
def name_join_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, ids = page_names(spark, sf_dir)
    return joins.attach_ids(rows, ids, ["page_id"], "name", one_page_scope=True)


@query
def name_join_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem")
    name = F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    rows = lines.select("l_orderkey", "l_linenumber", F.concat(F.lit("　"), name, F.lit(" ")).alias("name"))
    ids = lines.select("l_orderkey", name.alias("name"), F.col("l_partkey").alias("part_id"))
    return joins.attach_ids(rows, ids, ["l_orderkey"], "name", dedupe=True)


def user_payouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest value per user, purchases against sign-ups."""
    events = load(spark, sf_dir, "events")

    def side(kind: str, name: str) -> DataFrame:
        return events.filter(F.col("event_type") == kind).groupBy("user_id").agg(F.max("value").alias(name))

    return joins.combine_payouts(side("purchase", "win_payout"), side("signup", "place_payout"), ["user_id"])


@query
def full_outer_payout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_payouts(spark, sf_dir)


@query
def left_join_payout(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return joins.attach_payouts(events, user_payouts(spark, sf_dir), ["user_id"])


@query
def group_mean_join_dev(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem")
    # the lines of one flag have no horse
    key = F.when(F.col("l_returnflag") != "N", F.col("l_partkey")).alias("horse_id")
    rows = lines.select("l_orderkey", "l_linenumber", key, "l_quantity")
    out = aggregates.deviation_from_mean(rows, "horse_id", "l_quantity", "mean", "dev")
    return out.withColumns({"mean": F.round("mean", 6), "dev": F.round("dev", 6)})


@query
def stored_mean_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    means = aggregates.mean_per_key(lines.filter(F.col("l_shipdate") < cut), "l_partkey", "l_quantity", "mean")
    root = scratch_path(spark, "means")
    tables.publish(means, root, "v1", "weight_diff_avg")
    stored = tables.read_version(spark, root, "v1", "weight_diff_avg")
    rows = lines.filter(F.col("l_shipdate") >= cut).drop("l_shipdate")
    out = aggregates.add_deviation(joins.attach_mean(rows, stored, "l_partkey"), "l_quantity", "mean", "dev")
    return out.withColumns({"mean": F.round("mean", 6), "dev": F.round("dev", 6)})


@query
def stored_code_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes given to the parts of earlier lines, stored, and looked up for later ones; new parts have none."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    cut = F.lit("1993-01-01").cast("timestamp_ntz")
    root = scratch_path(spark, "codes")
    codes = aggregates.dictionary(lines.filter(F.col("l_shipdate") < cut), "l_partkey", "l_partkey_cat")
    tables.publish(codes, root, "v1", "l_partkey_codes")
    stored = tables.read_version(spark, root, "v1", "l_partkey_codes")
    later = lines.filter(F.col("l_shipdate") >= cut).drop("l_shipdate")
    return aggregates.encode_with(later, {"l_partkey": stored})


def day_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").withColumn("day", F.to_date("l_shipdate"))


@query
def mean_before_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per line the mean quantity of its part on earlier days only."""
    lines = day_lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "day", "l_quantity")
    found = aggregates.mean_before(lines, "l_partkey", "day", "l_quantity", "mean_before")
    return found.select("l_orderkey", "l_linenumber", F.round("mean_before", 6).alias("mean_before"))


#: Ends of the increments in which rows arrive.
ARRIVALS = ("1997-01-01", "1999-01-01", "2100-01-01")


def arrivals(lines: DataFrame) -> list[DataFrame]:
    """Lines in three increments by day."""
    ends = ("0001-01-01", *ARRIVALS)
    return [lines.filter((F.col("day") >= F.lit(a).cast("date")) & (F.col("day") < F.lit(b).cast("date"))) for a, b in zip(ends, ends[1:])]


@query
def growing_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means per part after three increments; of the second commit as well."""
    root = scratch_path(spark, "means")
    for part in arrivals(day_lines(spark, sf_dir)):
        growing.grow_means(spark, root, part, "l_partkey", "l_quantity")
    now = growing.stored_means(spark, root, "l_partkey", "mean")
    before = growing.stored_means(spark, root, "l_partkey", "mean_before", number=2)
    return now.join(before, "l_partkey", "left").withColumns({c: F.round(c, 6) for c in ("mean", "mean_before")})


@query
def growing_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of suppliers of dear lines: those of the first increment keep theirs, new ones follow in order."""
    root = scratch_path(spark, "codes")
    for part in arrivals(day_lines(spark, sf_dir).filter("l_extendedprice > 90000")):
        growing.grow_codes(spark, root, part, "l_suppkey")
    return growing.stored_codes(spark, root, "l_suppkey", "code")


@query
def co_located_mean_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and means bucketed by part on disk, joined without a shuffle."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    means = aggregates.mean_per_key(lines, "l_partkey", "l_quantity", "mean")
    stored = [tables.write_bucketed(df, scratch_path(spark, name), "l_partkey", 8) for name, df in (("lines", lines), ("means", means))]
    joined = stored[0].join(stored[1].hint("merge"), "l_partkey", "left")
    return joined.withColumn("mean", F.round("mean", 6))


@query
def missing_worklist_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.still_missing(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), ["doc_id"])


@query
def tiered_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    # the local copy is empty for all but English, the stored one for German
    local = docs.select("doc_id", F.when(F.col("lang") == "en", F.col("text")).otherwise("").alias("text"))
    stored = docs.select(
        "doc_id", F.when(F.col("lang") != "de", F.concat(F.lit("stored "), "text")).otherwise("").alias("text")
    )
    return joins.first_tier([local, stored], ["doc_id"], "text")


# -- lists and stacks ----------------------------------------------------------


@query
def ids_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.placed_ids(races(spark, sf_dir), "race_date", "o_custkey")


@query
def collect_list_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = aggregates.ids_per_date(races(spark, sf_dir).select("race_date", "o_custkey"), "race_date", "o_custkey")
    return lists.select(
        "race_date", "part", F.array_join(F.col("o_custkeys").cast("array<string>"), " ").alias("ids")
    )


@query
def vertical_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, supplier = load(spark, sf_dir, "customer"), load(spark, sf_dir, "supplier")
    return project.concat_rows(
        [
            customer.select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")),
            supplier.select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance")),
            customer.select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")),
        ]
    )


@query
def explode_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a ticket row of three horse numbers and three payouts per order
    yen = F.concat(F.format_number(F.floor("o_totalprice"), 0), F.lit("円"))
    tickets = load(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat_ws(" ", "o_custkey", F.substring("o_orderpriority", 1, 1), "o_orderstatus").alias("horse_numbers"),
        F.concat_ws(" ", yen, F.lit("150円"), F.lit("1,330円")).alias("payouts"),
    )
    listed = tickets.select(
        "o_orderkey", text.split_blank("horse_numbers").alias("horse_number"), text.digit_runs("payouts").alias("payout")
    )
    return project.explode_together(listed, ["horse_number", "payout"]).withColumn("payout", F.col("payout").cast("int"))


# -- pages ---------------------------------------------------------------------


@query
def url_param_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages")
    return pages.select(
        "page_id",
        text.query_value("url", "page").alias("page_no"),
        text.first_match("url", r"^https?://[^/]+/([a-z]+)/").alias("lang"),
        text.id_after("url", "/[a-z]+").alias("path_id"),
    )


@query
def href_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages")
    links = pages.select("page_id", F.posexplode(text.flat_links("html")).alias("link_no", "link"))
    return links.select(
        "page_id", "link_no", F.col("link.text").alias("name"), text.id_after("link.href", "").alias("link_id")
    )


@query
def link_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat.page_links(load(spark, sf_dir, "pages"), ["page_id"], "html", "")


@query
def list_item_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = flat.item_links(load(spark, sf_dir, "pages"), ["page_id"], "html")
    return items.select("page_id", "item_no", text.id_after("href", "").alias("item_id"))


@query
def page_info_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "pages").select(
        "page_id",
        text.attribute("html", "html", "lang").alias("lang"),
        text.element_text("html", "title").alias("title"),
        text.element_text("html", "h1").alias("heading"),
    )


ORDER_COLUMNS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@query
def first_table_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = render.table_pages(load_for_python(spark, sf_dir, "orders", "o_orderkey"), "o_orderkey", ORDER_COLUMNS)
    rows = extract.read_table(pages, ["o_orderkey"], "html", {c: c for c in ORDER_COLUMNS})
    return rows.withColumns({"o_custkey": F.col("o_custkey").cast("long"), "o_totalprice": F.col("o_totalprice").cast("double")})


@query
def card_table_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load_for_python(spark, sf_dir, "part", "p_partkey")
    columns = {"馬名": F.col("p_name"), "性齢": F.col("p_brand"), "枠": F.col("p_size").cast("string")}
    pages = render.card_pages(part, "p_partkey", columns)
    return extract.read_table(
        pages, ["p_partkey"], "html", {"馬名": "horse_name", "枠": "frame"}, css_class="card", header_rows=2
    )


@query
def class_table_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load_for_python(spark, sf_dir, "customer", "c_custkey")
    cells = [
        [F.lit("name"), F.col("c_name")],
        [F.lit("segment"), F.concat(F.lit("<&> "), "c_mktsegment")],
        [F.lit("nation"), F.col("c_nationkey").cast("string")],
    ]
    pages = render.stacked_table_pages(customer, "c_custkey", cells)
    return extract.read_stacked_tables(pages, ["c_custkey"], "html", ["field", "value"], "wanted")


@query
def horse_history_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load_for_python(spark, sf_dir, "orders", "o_orderkey")
    header = fixed.HISTORY_COLUMNS
    cells = [F.concat(F.lit(f"c{i} "), F.col("o_orderkey").cast("string")) for i in range(len(header))]
    pages = orders.select("o_orderkey", render.table(header, [cells], fixed.HISTORY_TABLE_CLASS).alias("html"))
    return monthly.horse_history(pages, ["o_orderkey"])


@query
def horse_profile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load_for_python(spark, sf_dir, "customer", "c_custkey")
    tables_of_a_page = [
        render.table(["item", "entry"], [[F.lit(kind), render.escape_html(F.col(column))]], fixed.PROFILE_TABLE_CLASS)
        for kind, column in (("name", "c_name"), ("second", "c_mktsegment"))
    ]
    pages = customer.select("c_custkey", F.concat(*tables_of_a_page).alias("html"))
    rows = monthly.horse_profile(pages, ["c_custkey"])
    return rows.withColumn("cells", F.array_join("cells", "|"))


@query
def path_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    date, number = yyyymmdd("o_orderdate"), F.col("o_orderkey").cast("string")
    path = F.concat(F.lit("file:/in/race_date="), date, F.lit("/"), number, F.lit(".html"))
    return load(spark, sf_dir, "orders").select(
        "o_orderkey", text.path_value(path, "race_date").alias("race_date"), text.stem_of_path(path).alias("race_id")
    )


@query
def calendar_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = render.calendar_pages(load(spark, sf_dir, "orders"))
    return monthly.race_dates(pages, ["o_orderkey"])


@query
def day_race_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly.race_ids(render.day_pages(load(spark, sf_dir, "orders")))


@query
def day_work_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = render.day_pages(load(spark, sf_dir, "orders"))
    # the pages of one status have landed, those of another landed empty, the rest did not
    landed = races(spark, sf_dir).filter(F.col("o_orderstatus") != "P").select(
        "race_date",
        F.col("o_orderkey").cast("string").alias("race_id"),
        F.when(F.col("o_orderstatus") == "F", "<p>").otherwise("").alias("html"),
    )
    return monthly.pages_to_fetch(days, landed)


@query
def race_result_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = render.race_pages(load_for_python(spark, sf_dir, "orders", "o_orderkey"))
    return race_result.build_race_results(pages, errors="raise").rows


@query
def race_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = render.race_pages(load_for_python(spark, sf_dir, "orders", "o_orderkey"))
    raw = cut_lineage(race_result.build_race_results(pages, dedupe_ids=True, errors="raise").rows, "race_result")
    feature = preprocess(raw)["feature"]
    return feature.withColumns({c: F.round(c, 6) for c in ("weight_diff_avg", "horse_weight_diff_dev")})


@query
def decode_charset(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = load_for_python(spark, sf_dir, "documents", "doc_id").select("doc_id", render.encode_text("text").alias("content"))
    return raw.select("doc_id", decode_bytes("content").alias("text"))


# -- sources and sinks ---------------------------------------------------------


@query
def versioned_write_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "data")
    orders = load(spark, sf_dir, "orders").drop("o_orderdate")
    customers = load(spark, sf_dir, "customer")
    tables.publish_all({"orders": orders, "customer": customers}, root, "v1")

    def never() -> DataFrame:
        raise AssertionError("the version is there, nothing is built")

    return tables.read_or_build(spark, root, "v1", "orders", never)


@query
def commit_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables in two commits and a third that broke off: rows of each table as of each commit."""
    root = scratch_path(spark, "commits")
    orders, customers = load(spark, sf_dir, "orders").drop("o_orderdate"), load(spark, sf_dir, "customer")
    commits.commit(spark, root, {"orders": orders.filter("o_orderstatus = 'F'"), "customer": customers}, note="first")
    commits.commit(spark, root, {"orders": orders}, note="all")
    commits.write_files(orders.filter("o_orderstatus = 'P'"), root)  # never named by a manifest
    found = None
    for number in (1, 2, None):
        for name, key, value in (("orders", "o_orderkey", "o_totalprice"), ("customer", "c_custkey", "c_acctbal")):
            table = commits.read_version(spark, root, name, number)
            rows = table.select(
                F.lit(number or 0).alias("number"), F.lit(name).alias("name"), F.col(key).cast("long").alias("key"), F.col(value).alias("value")
            )
            found = rows if found is None else found.unionByName(rows)
    return found


@query
def page_files_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written one file each and read again, within a range of dates, by two sources."""
    page_files.register(spark)
    path = scratch_path(spark, "page-files")
    date = F.format_string("202403%02d", F.col("page_id") % 28 + 1)
    pages = load(spark, sf_dir, "pages").select(date.alias("race_date"), F.col("page_id").cast("string").alias("race_id"), "html")
    pages.write.format("page_files").mode("append").save(path)
    found = page_files.read(spark, path).filter(F.col("race_date").between("20240305", "20240320"))
    scanned = scan_pages(spark, path, "20240305", "20240320")
    digest = [F.col("race_date"), F.col("race_id").cast("long").alias("page_id"), F.md5("html").alias("html_md5")]
    return found.select(F.lit("files").alias("source"), *digest).unionByName(scanned.select(F.lit("text").alias("source"), *digest))


@query
def partitioned_write_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "monthly")
    tables.write_monthly(races(spark, sf_dir).drop("o_orderdate"), path, "race_date")
    return tables.read_dates(spark, path, "ym", "199601", "199612")


@query
def incremental_ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "ingest")
    pages = load(spark, sf_dir, "pages").withColumn("lang", text.attribute("html", "html", "lang"))
    # the second increment holds every page, so all of the first arrive twice
    for increment in (pages.filter(F.col("url").contains("?")), pages):
        increment.write.mode("append").parquet(f"{root}/arrived")
        stream = spark.readStream.schema(pages.schema).parquet(f"{root}/arrived")
        ingest(stream, f"{root}/landed", f"{root}/progress", keys=["page_id"], by="lang")
    return read_landed(spark, f"{root}/landed", pages.schema).drop("lang")


@query
def keyed_ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by user and kind in three increments; repeats within a day of the first are dropped by keyed state."""
    root = scratch_path(spark, "keyed")
    events = load(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias(LANDED_AT), F.col("event_type").alias("html"))
    thirds = F.ntile(3).over(Window.orderBy("day"))
    days = events.select(F.to_date(LANDED_AT).alias("day")).distinct().select("day", thirds.alias("third"))
    dated = cut_lineage(events.join(days, F.to_date(LANDED_AT) == F.col("day")).drop("day"), "events")
    schema = events.schema
    # every increment brings all events of the last one again
    for third in (1, 2, 3):
        dated.filter(F.col("third").between(third - 1, third)).drop("third").write.mode("append").parquet(f"{root}/arrived")
        stream = spark.readStream.schema(schema).parquet(f"{root}/arrived")
        ingest(stream, f"{root}/landed", f"{root}/progress", keys=["event_id"], by=None, within="100 days")
    return read_landed(spark, f"{root}/landed", schema).select("event_id", "user_id", F.col("html").alias("event_type"))


# -- models --------------------------------------------------------------------


@query
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = load(spark, sf_dir, "labels").join(load(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    return aggregates.roc_auc(scored, "n_chars", "quality").withColumn("auc", F.round("auc", 9))


@query
def roc_auc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem").select(
        "l_extendedprice", F.when(F.col("l_quantity") > 25, 1).otherwise(0).alias("label")
    )
    return aggregates.roc_auc(lines, "l_extendedprice", "label").withColumn("auc", F.round("auc", 9))


MODEL_FEATURES = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice", "status", "priority"]


def model_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Train and valid rows of one stored table: does a line cost more than 2,000 per piece? A tenth of the answers are wrong."""
    orders = races(spark, sf_dir).select(
        "o_orderkey",
        "race_date",
        "o_totalprice",
        label_code("o_orderstatus", {"F": 0, "O": 1, "P": 2}).alias("status"),
        text.leading_int("o_orderpriority").alias("priority"),
    )
    lines = load(spark, sf_dir, "lineitem")
    wrong = search.share_column(F.col("l_orderkey"), F.col("l_linenumber")) < 0.1
    rank = F.when((F.col("l_extendedprice") / F.col("l_quantity") > 2000) != wrong, 1).otherwise(2)
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("rank", rank)
    stored = cut_lineage(model.with_label(rows).select(*MODEL_FEATURES, "race_date", model.LABEL), "feature")
    return model.split_by_date(stored, "race_date", TRAIN_FIRST, TRAIN_LAST)


#: Grown fast and stopped early: a round is some jobs, however few the rows are.
MODEL_PARAMS = boosting.BoostParams(rate=0.9, leaves=8, max_depth=3, l2=1.0)
PATIENCE = 2


@query
def gbt_train_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole fit, by the operator's own parameters and up to its stop, stored, read again and used on the raw valid rows."""
    train, valid = model_parts(spark, sf_dir)
    prepared, params = boosting.prepare(train, valid, MODEL_FEATURES), boosting.BoostParams()
    fitted = boosting.fit(prepared, params)
    fitted.state.drop()
    prepared.drop()
    root = scratch_path(spark, "models")
    tables.publish_booster(spark, fitted.model, asdict(params), {"auc": fitted.auc}, root, "gbt", "v1")
    stored, _, metrics = tables.read_booster(spark, root, "gbt", "v1")
    scored = aggregates.roc_auc(boosting.score(stored, valid), boosting.SCORE, model.LABEL)
    stop = len(fitted.state.history) - fitted.rounds
    return scored.withColumns({"rounds": F.lit(fitted.rounds), "without_gain": F.lit(stop), "auc_in_fit": F.lit(metrics["auc"])})


@query
def assembled_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem").withColumn(model.LABEL, F.lit(1.0))
    small = F.when(F.col("l_quantity") < 40, F.col("l_quantity"))
    names = ["l_linenumber", "small", "l_tax"]
    vectors = model.assemble(lines.withColumn("small", small), names)
    values = vectors.select(vector_to_array("features").alias("v"))
    return values.groupBy(*[F.col("v")[i].alias(name) for i, name in enumerate(names)]).agg(F.count("*").alias("n"))


FLAGS = ["large", "cheap"]


def flag_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two flags per line and a label: a tree of depth 2 has a leaf for each of the four cells."""
    flags = [(F.col("l_quantity") > 25).alias("large"), (F.col("l_discount") > 0.05).alias("cheap")]
    label = F.when(F.col("l_extendedprice") * (1 - F.col("l_discount")) > 40000, 1.0).otherwise(0.0)
    return model.assemble(load(spark, sf_dir, "lineitem").select(*flags, label.alias(model.LABEL)), FLAGS)


@query
def gbt_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds of boosting, stored and read again: lines per label and score."""
    rows = flag_rows(spark, sf_dir)
    fitted = model.fit_boosted(rows, rows, {"maxDepth": 2}, max_rounds=2, patience=2)
    root = scratch_path(spark, "models")
    tables.publish_model(spark, fitted.model, {"maxDepth": 2}, {"auc": fitted.auc}, root, "gbt", "v1")
    stored, params, metrics = tables.read_model(spark, root, "gbt", "v1")
    scored = model.score(stored, rows).withColumn(model.SCORE, F.round(model.SCORE, 9))
    counts = scored.groupBy(model.LABEL, model.SCORE).agg(F.count("*").alias("n"))
    return counts.withColumns({"depth": F.lit(params["maxDepth"]), "auc": F.round(F.lit(metrics["auc"]), 9)})


@query
def importance_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tree: share of the gain and number of splits of each flag."""
    rows = flag_rows(spark, sf_dir)
    fitted = model.fit_boosted(rows, rows, {"maxDepth": 2}, max_rounds=1, patience=1)
    gain = model.importance(fitted.model, FLAGS).withColumn("gain", F.round("gain", 9))
    return gain.join(model.importance(fitted.model, FLAGS, "weight"), "feature")


BOOSTED_FLAGS = boosting.BoostParams(rate=0.3, leaves=4, l1=0.5, l2=3.0, least_rows=1, least_curvature=0.0)


@query
def boosted_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds with L1 and L2 terms, the second gone on to from the state of the first: lines per cell and margin."""
    flags = [(F.col("l_quantity") > 25).cast("int").alias("large"), (F.col("l_discount") > 0.05).cast("int").alias("cheap")]
    label = F.when(F.col("l_extendedprice") * (1 - F.col("l_discount")) > 40000, 1.0).otherwise(0.0)
    rows = cut_lineage(load(spark, sf_dir, "lineitem").select(*flags, label.alias(model.LABEL)), "flags")
    prepared = boosting.prepare(rows, rows, FLAGS)
    first = boosting.fit(prepared, BOOSTED_FLAGS, max_rounds=1)
    fitted = boosting.fit(prepared, BOOSTED_FLAGS, max_rounds=2, state=first.state)
    scored = boosting.margins(fitted.state.model, rows)
    return scored.groupBy(*FLAGS, F.round(boosting.MARGIN, 9).alias("margin")).agg(F.count("*").alias("n"))


@query
def boosted_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One split of all lines on a set of suppliers: margin and lines of each supplier."""
    label = F.when(F.col("l_extendedprice") > 40000, 1).otherwise(0)
    rows = load(spark, sf_dir, "lineitem").select("l_suppkey", label.alias(model.LABEL))
    rows = cut_lineage(rows, "suppliers")
    params = boosting.BoostParams(rate=0.3, leaves=2, l2=1.0)
    fitted = boosting.fit(boosting.prepare(rows, rows, [], ["l_suppkey"]), params, max_rounds=1)
    scored = boosting.margins(fitted.model, rows)
    return scored.groupBy("l_suppkey", F.round(boosting.MARGIN, 9).alias("margin")).agg(F.count("*").alias("n"))


@query
def hpo_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hundred draws of the leaf-wise search, and how many lines the row share of each takes in its first round."""
    drawn = search.draw_table(spark.range(100).withColumnRenamed("id", "trial"), search.SEARCH_SPACES["leaves"])
    shares = drawn.select("trial", "bagging_fraction").collect()  # one row per trial
    mark = search.share_column(F.col("l_orderkey"), F.col("l_linenumber"))
    lines = load(spark, sf_dir, "lineitem").select(mark.alias("mark"))
    counts = lines.agg(F.array(*[F.count_if(F.col("mark") < row["bagging_fraction"]) for row in sorted(shares)]).alias("rows"))
    per_trial = counts.select(F.posexplode("rows").alias("at", "rows")).select(F.col("at").cast("long").alias("trial"), "rows")
    return drawn.join(per_trial, "trial").withColumns({c: F.round(c, 9) for c, (kind, _, _) in search.SEARCH_SPACES["leaves"].items() if kind != "int"})


@query
def hpo_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trials of the leaf-wise search over rungs of growing rounds."""
    train, valid = model_parts(spark, sf_dir)
    prepared = boosting.prepare(train, valid, MODEL_FEATURES)
    _, trials = search.search(prepared, search.SEARCH_SPACES["leaves"], trials=6, max_rounds=6, least_rounds=2, rate=0.5, max_depth=3)
    for trial in trials:
        if trial.fitted is not None:
            trial.fitted.state.drop()
    prepared.drop()
    rows = [(t.number, t.auc, t.rounds, t.rung, json.dumps(t.drawn, sort_keys=True)) for t in trials]
    return spark.createDataFrame(rows, "trial int, auc double, rounds int, rung int, params string")


@query
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, valid = model_parts(spark, sf_dir)
    prepared = boosting.prepare(train, valid, MODEL_FEATURES)
    fitted = boosting.fit(prepared, MODEL_PARAMS, patience=PATIENCE)
    fitted.state.drop()
    prepared.drop()
    return boosting.importance(spark, fitted.model)
