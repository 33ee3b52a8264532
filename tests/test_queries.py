"""Every registered query against its SQL, on the smallest tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

from compare import differences, open_tables  # noqa: E402

from vellumark.plans.oracles import ORACLES  # noqa: E402
from vellumark.plans.queries import QUERIES  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

DATA = "/root/testdata/sf0.001"
MODELS = {"chunk_semantic", "enr_topic"}


@pytest.fixture(scope="module")
def db():
    return open_tables(DATA)


def test_only_models_lack_sql():
    assert set(QUERIES) - set(ORACLES) == MODELS
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    rows, bad = differences(queries()[name](spark, DATA), db, oracle_sql().get(name))
    assert not bad and rows > 0
