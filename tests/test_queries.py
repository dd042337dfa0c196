"""Every query against its SQL, values and types."""

import pytest

import __spark_entry__ as driver
from furlong.bindings.oracle import ORACLE
from furlong.bindings.queries import QUERIES
from tests.compare import connect, duck_rows, duck_types, spark_rows

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT", "tinyint": "TINYINT",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns, rows = spark_rows(df)
    expected_columns, expected = duck_rows(duck, ORACLE[name])
    assert columns == expected_columns
    assert {c: TYPES[t] for c, t in df.dtypes} == duck_types(duck, ORACLE[name])
    assert rows == expected
    assert rows


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {"gbt_train_score", "hpo_random", "feature_importance"}


def test_the_driver_gets_them_all():
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLE) <= set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_the_scored_model_is_a_whole_fit(spark, sf_dir, monkeypatch):
    """As many rounds, leaves and rounds without gain as the operator allows by itself."""
    from inspect import signature

    from furlong.plans import boosting
    from furlong.sources import tables

    real, asked, stored = boosting.fit, [], []

    def short(*args, **kwargs):
        given = signature(real).bind(*args, **kwargs)
        given.apply_defaults()
        asked.append(given.arguments)
        return real(args[0], boosting.BoostParams(leaves=3), max_rounds=2)

    publish = tables.publish_booster
    monkeypatch.setattr(boosting, "fit", short)
    monkeypatch.setattr(tables, "publish_booster", lambda *args: (stored.append(args[2]), publish(*args)))
    row = QUERIES["gbt_train_score"](spark, sf_dir).first()
    (given,) = asked
    assert (given["max_rounds"], given["patience"], given["params"] or boosting.BoostParams()) == (300, 20, boosting.BoostParams())
    assert stored == [vars(boosting.BoostParams())] and row["auc"] == pytest.approx(row["auc_in_fit"], abs=1e-12)
