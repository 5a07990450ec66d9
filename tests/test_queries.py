"""Every query next to its SQL check, on the smallest data folder."""

import os

import pytest

import __spark_entry__ as contract
from tallyloom.operators import binning, cohort, ranking, segments, sequence
from tallyloom.plans.registry import ORACLE, QUERIES
from tallyloom.session import cut_lineage
from tests.compare import connect, rows_of
from tests.plan_checks import check_plan

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Checked rows may be none at the smallest scale.
MAY_BE_EMPTY = {"retail_negative_prices"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data absent")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_a_check():
    assert set(ORACLE) == set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_check(spark, duck, name, monkeypatch):
    def checked(df):
        """A frame that is about to be written must have a good plan too."""
        check_plan(name, df)
        return cut_lineage(df)

    for module in (binning, cohort, ranking, segments, sequence):
        monkeypatch.setattr(module, "cut_lineage", checked)
    df = contract.queries()[name](spark, FOLDER)
    check_plan(name, df)
    names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    duck.execute(f"CREATE OR REPLACE TEMP VIEW checked AS {contract.oracle_sql()[name]}")
    cursor = duck.execute("SELECT * FROM checked")
    want_names, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert names == want_names
    assert want or name in MAY_BE_EMPTY
    assert got == want


def test_entry(spark):
    assert contract.entry(spark).columns == ["customer", "dish_name"]
