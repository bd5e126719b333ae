import importlib.util
from pathlib import Path

import pytest

import check
from registry.oracles import ORACLES
from registry.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="the test tables are not here")


@pytest.fixture(scope="module")
def db():
    return check.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_its_sql(spark, db, name):
    # The smallest tables leave some results empty on both sides.
    assert check.compare(spark, db, name, SF_DIR) in (None, "no rows on either side")


def test_entry_file_loads_from_anywhere(spark, monkeypatch, tmp_path):
    monkeypatch.chdir(tmp_path)
    path = Path(check.__file__).parent / "__spark_entry__.py"
    spec = importlib.util.spec_from_file_location("entry_file", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert module.entry(spark).columns == ["realm_id", "payment_provider", "currency", "ts", "amount", "amount_usd"]
    assert set(module.oracle_sql()) <= set(module.queries())
