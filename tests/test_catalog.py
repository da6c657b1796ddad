"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from bindings.catalog import QUERIES  # noqa: E402
from bindings.oracle import ORACLE_SQL  # noqa: E402
from tests.compare import compare, oracle_connection  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
FITS = ("fit_logistic", "fit_cbm_sequential", "fit_cbm_sequential_context", "fit_cbm_joint",
        "fit_cbm_joint_context", "fit_c_to_y_true", "fit_c_to_y_pred")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_only_fits_lack_sql():
    assert set(QUERIES) - set(ORACLE_SQL) == set(FITS)
    assert set(ORACLE_SQL) <= set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in FITS])
def test_matches_sql(spark, connection, name):
    built = []

    def query(session, sf_dir):
        built.append(QUERIES[name](session, sf_dir))
        return built[0]

    verdict = compare(spark, connection, SF_DIR, name, query, ORACLE_SQL[name])
    assert verdict.startswith("ok"), verdict
    plan = built[0]._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_entry(spark):
    assert len(entry.entry(spark).columns) == 45
