"""Registered queries vs their DuckDB oracle on the smallest test tables."""
import math

import pytest

import __spark_entry__ as E
from sessionary.plans.sql_registry import ORACLE
from tests.conftest import SF_SMALL


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")),
                        key=repr)


def test_every_query_has_oracle_or_is_model_based():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    exp = duck.sql(ORACLE[name]).df()
    assert _rows(got) == _rows(exp)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert len(df.columns) == 40
    assert df.count() >= 0
