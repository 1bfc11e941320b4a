"""Every registered query equals its SQL oracle."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from check_queries import compare, open_oracle
from gridtally.plans.oracles import ORACLES
from gridtally.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return open_oracle(FOLDER)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    assert compare(spark, oracle, FOLDER, name) is None


def test_the_rest_works_without_the_training_data_operators():
    code = (
        "import sys; sys.modules['gridtally.llm'] = sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e; from gridtally.plans.queries import QUERIES\n"
        "assert set(e.queries()) == set(QUERIES) == set(e.oracle_sql())"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(entry.__file__))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
