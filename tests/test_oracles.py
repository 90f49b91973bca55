"""Every registered query against its DuckDB oracle at sf0.01; the fitted ones without SQL by their properties."""

import math

import pytest

from rentrisk.operators import model as M
from rentrisk.plans.registry import ORACLES, QUERIES
from tests.conftest import SF001, SF01
from tests.oracle_check import compare

import __spark_entry__ as E


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    assert compare(spark, SF01, name, E.queries()[name], ORACLES[name]) > 0


def test_entry_offers_every_query():
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) - set(ORACLES) == {"lasso_cv_report", "best_params", "score_test"}


def test_fitted_queries(spark):
    report = E.queries()["lasso_cv_report"](spark, SF001).collect()
    assert len(report) == 1 and report[0].model and "regParam" in report[0].best_params
    best = E.queries()["best_params"](spark, SF001).collect()
    assert len(best) == 1 and best[0].reg_param in M.REG_PARAMS and best[0].avg_metric <= 1
    scored = E.queries()["score_test"](spark, SF001).collect()
    assert scored and all(r.label is not None and math.isfinite(r.prediction) for r in scored)
