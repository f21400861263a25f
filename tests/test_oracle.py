"""Every registered query against its DuckDB oracle (rows, schema, values)."""

import pytest

from paylake.plans import verify
from paylake.plans.catalog import REGISTRY
from paylake.plans.oracle import all_sql
from tests.conftest import SF_SMALL

ORACLE = all_sql()
SLOW = {"cv_folds", "train_model"}


@pytest.fixture(scope="module")
def con():
    return verify.duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(k for k in REGISTRY if k in ORACLE))
def test_oracle_match(spark, con, name):
    r = verify.compare(spark, name, SF_SMALL, con)
    assert r["cols_match"], r
    assert not r["type_diff"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


@pytest.mark.parametrize("name", sorted(k for k in REGISTRY if k not in ORACLE and k not in SLOW))
def test_rows_only(spark, name):
    assert REGISTRY[name](spark, SF_SMALL).count() > 0


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
