"""Every named query against its SQL restatement, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from loglathe.plans.registry import QUERIES
from oracles import ORACLES
from tools.compare import compare

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    (_, problem, _, _), = compare(spark, SF_DIR, {name})
    assert problem is None, problem


def test_entry(spark):
    assert entry.entry(spark).columns == ["n_events", "n_formats"]
