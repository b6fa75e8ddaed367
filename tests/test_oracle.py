"""Layer 1: every query key against its DuckDB oracle on the smallest data."""

import importlib.util

import pytest

from tests.conftest import ROOT, SF_SMALL
from tests.helpers import duck_rows, spark_rows
from voltcube.plans.registry import all_queries

_spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
entry = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(entry)

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()
OWN = all_queries()              # those of the training-data subpackage have tests of their own


def test_every_query_has_an_oracle():
    assert set(ORACLE) <= set(QUERIES) and set(OWN) <= set(ORACLE)
    assert len(OWN) >= 61


@pytest.fixture(scope="module")
def con(duck):
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(OWN))
def test_query_matches_oracle(spark, con, key):
    got = spark_rows(QUERIES[key](spark, SF_SMALL))
    want = duck_rows(con, ORACLE[key])
    assert got[0] == want[0], "column names differ"
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["continent", "year", "total_ev_sales", "grouping_level"]
    assert df.count() > 0


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_gdp_class_has_one_oracle_at_every_size(spark, duck, sf_dir):
    assert spark_rows(QUERIES["gdp_class"](spark, sf_dir)) == duck_rows(duck(sf_dir), ORACLE["gdp_class"])


def test_results_do_not_depend_on_the_folder_name(spark, duck, tmp_path):
    prod = tmp_path / "prod"
    prod.symlink_to("/root/testdata/sf0.01")
    for key in ("gdp_class", "rank_stock", "pipeline_rank_stock"):
        assert spark_rows(QUERIES[key](spark, str(prod))) == duck_rows(duck(str(prod)), ORACLE[key])
