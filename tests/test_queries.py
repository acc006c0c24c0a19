"""Registered queries beside their oracles on the smallest driver tables."""

import os

import pytest

from checks.compare import differences, duck
from checks.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
DATASETS = ["preop_diagnoses", "tiva_cohort", "procedure_rollup", "surgeon_rollup", "cancer_rad_startdate", "site_a_referrals"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def _operator_queries():
    from checks import operators

    return [n for n, f in QUERIES.items() if n not in DATASETS and n in _names_in(operators)]


def _names_in(module):
    import inspect
    import re

    return set(re.findall(r'check\(\s*"(\w+)"', inspect.getsource(module)))


@pytest.mark.parametrize("name", [*_operator_queries(), *DATASETS])
def test_query_matches_oracle(spark, con, name):
    found, _ = differences(QUERIES[name](spark, FOLDER), con, ORACLES[name])
    assert not found


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
