"""Every registered query beside its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from check import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    ok, text = compare(spark, con, SF, name)
    assert ok, text


def test_hashed_search_finds_most(spark):
    r = entry.queries()["ann_recall"](spark, SF).first()
    assert 0.9 <= r["recall"] <= 1.0


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0
