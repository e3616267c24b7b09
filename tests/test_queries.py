"""Every registered query next to its SQL twin on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry
from compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_matches_sql(spark, con, name):
    good, note = compare(spark, con, name, SF_DIR)
    assert good, note


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
