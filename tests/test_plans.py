"""Physical plans, with automatic broadcasts switched off to see what a large cluster would run."""

import re

import pytest

from furlong.bindings.queries import QUERIES

FITTED = {"gbt_train_score", "hpo_random", "feature_importance"}


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = {}
    for name, query in QUERIES.items():
        if name not in FITTED:
            found[name] = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    yield found
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def shuffles(plan):
    return len(re.findall(r"Exchange (?:hash|range|Round)", plan))


def test_no_cross_joins(plans):
    for name, plan in plans.items():
        assert "Cartesian" not in plan and "NestedLoop" not in plan, name


def test_broadcasts_are_of_bounded_tables_only(plans):
    # forced broadcasts: one row per sorted range, or the list of hot keys
    for name, plan in plans.items():
        for join in re.findall(r"BroadcastHashJoin \[([^\]]*)\]", plan):
            assert "__part" in join or "__key_hash" in join or join.startswith("coalesce(__key#"), name


def test_python_is_left_to_pages_and_charsets(plans):
    using = {name for name, plan in plans.items() if "MapInArrow" in plan or "ArrowEvalPython" in plan}
    assert using == {
        "race_result_build", "horse_history_rows", "horse_profile_rows",
        "first_table_extract", "card_table_extract", "class_table_union", "decode_charset",
    }
    assert not any("BatchEvalPython" in plan for plan in plans.values())


@pytest.mark.parametrize(
    "name, count",
    [
        ("typed_select", 0), ("label_encode", 0), ("explode_zip", 0), ("href_extract", 0), ("vertical_concat", 0),
        ("missing_worklist_anti", 2), ("tiered_lookup", 2), ("group_mean_join_dev", 2), ("full_outer_payout", 2),
        ("name_join_dedup", 2), ("stored_mean_join", 2),
        # the given table, of one split, is dealt to all slots; the build itself shuffles nothing
        ("race_result_build", 1), ("filter_date_between", 0),
    ],
)
def test_shuffles(plans, name, count):
    assert shuffles(plans[name]) == count


def test_scans_read_what_is_needed(plans):
    schema = re.findall(r"ReadSchema: struct<([^>]*)>", plans["group_mean_join_dev"])
    assert set(schema) == {
        "l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double,l_returnflag:string",
        "l_partkey:bigint,l_quantity:double,l_returnflag:string",
    }
    assert "EqualTo(event_type,purchase)" in plans["full_outer_payout"]
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate,1996-01-01", plans["filter_date_between"])
    assert re.search(r"PartitionFilters: \[isnotnull\(ym#\d+\), \(ym#\d+ >= 199601\)", plans["partitioned_write_prune"])


def test_aggregates_combine_before_the_shuffle(plans):
    for name in ("group_mean_join_dev", "name_join_dedup", "missing_worklist_anti"):
        below = plans[name].split("Exchange hashpartitioning")[-1]
        assert "partial_" in below or "HashAggregate(keys" in below, name


def test_co_located_tables_are_joined_without_a_shuffle(spark, sf_dir):
    df = QUERIES["co_located_mean_join"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan.split("SortMergeJoin")[0]


@pytest.mark.parametrize("name", ["list_item_ids", "link_extract", "calendar_dates", "day_race_ids", "day_work_list"])
def test_flat_pages_are_read_in_the_jvm(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "InArrow" not in plan and "Python" not in plan


def test_a_round_sends_histograms_only(spark, sf_dir, monkeypatch):
    """What a round collects is bounded by leaves, features and bins; of ids one row per leaf."""
    from pyspark.sql.classic.dataframe import DataFrame

    from furlong.plans import boosting

    sent = []
    arrow, collect = DataFrame.toArrow, DataFrame.collect

    def counted(real):
        def run(self):
            found = real(self)
            sent.append(len(found))
            return found

        return run

    monkeypatch.setattr(DataFrame, "toArrow", counted(arrow))
    monkeypatch.setattr(DataFrame, "collect", counted(collect))
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("l_quantity", "l_orderkey", "int(l_extendedprice > 40000) AS label")
    prepared = boosting.prepare(rows, rows, ["l_quantity"], ["l_orderkey"], bins=16)
    sent.clear()
    boosting.fit(prepared, boosting.BoostParams(leaves=4), max_rounds=1)
    assert max(sent) <= max(3 * 2 * 17, 4096) and sum(sent) < 5000 < rows.count()
