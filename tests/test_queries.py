"""Every registered query gives the rows of its SQL; those without SQL give rows."""

import pytest
from oracle import connect, differences

import __spark_entry__ as contract
from suite.registry import COVERS, ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, con, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    assert differences(got, con.execute(ORACLES[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.columns and df.count() > 0


def test_entry_gives_rows(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "year" and df.count() == 7


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES) == set(COVERS)


def test_draws_have_the_reference_runs_and_points(spark, sf_dir):
    drawn = QUERIES["predictive_draws"](spark, sf_dir)
    assert drawn.count() == 200_000 and drawn.select("run").distinct().count() == 200
    for name in ("weight_draws", "dropout_draws"):
        assert QUERIES[name](spark, sf_dir).count() == 1_000, name


@pytest.mark.parametrize("name", ["net_training_history", "net_training_batches", "two_head_training_history", "fit_flow_history"])
def test_fits_end_by_themselves(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).orderBy("step").collect()
    assert [r["stopped"] for r in rows[:-1]] == [None] * (len(rows) - 1) and rows[-1]["stopped"] == "patience"
    assert rows[-1]["loss"] < rows[0]["loss"] and len(rows) > 10
