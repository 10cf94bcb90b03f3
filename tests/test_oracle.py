"""Every named query equals its SQL twin on the test tables."""

import os

import pytest

import __spark_entry__ as driver
from compare import connect, differences

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


# Learned scores have no SQL form; other tests hold them against plain loops. So with the optional part's.
NO_TWIN = {"model_scores", "model_request_scores", "model_incremental"}


def test_every_query_but_the_learned_ones_has_a_twin():
    own = {q for q in driver.queries() if q != "pipeline" and not (q.startswith("op") and q[2].isdigit())}
    assert own - set(driver.oracle_sql()) == NO_TWIN
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    assert differences(driver.queries()[name](spark, SF_DIR), duck, driver.oracle_sql()[name]) == []


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns[:2] == ["image_id", "decision_point_minutes"]
    assert df.count() == 3 * 154


def test_model_scores_are_probabilities(spark):
    rows = driver.queries()["model_scores"](spark, SF_DIR).collect()
    assert len(rows) == 3 * 154
    assert all(0.0 <= r.moderation_probability <= 1.0 for r in rows)
