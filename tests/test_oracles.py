"""Every registered query next to its SQL on the given tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "scripts"))

from check_oracles import connect, differences  # noqa: E402
from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries  # noqa: E402
from fixtures.adapters import Inputs  # noqa: E402
from fixtures.registry import MAKERS, ORACLES, QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, SF_DIR)


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(name, inputs, con):
    assert differences(MAKERS[name](inputs), ORACLES[name], con) == []


def test_registry_is_complete():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert Path(SMOKE_DIR).exists() and entry(spark).count() > 0
