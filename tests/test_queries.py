"""Every registered query against its checking SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
import compare
from spendguard.plans.checks import CHECKS
from spendguard.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return compare.connect(SF)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    problem = compare.compare(spark, db, SF, name)
    # Some kinds of content or refusal do not occur in tables this small.
    assert problem in (None, "both empty")
