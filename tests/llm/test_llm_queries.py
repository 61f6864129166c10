"""Registered queries against their SQL, and what is registered."""

import re

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from compare import database, differences
from jobtide.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    assert differences(spark, FOLDER, name, database(FOLDER)) == []


def test_every_operator_is_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(contract.queries())
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
