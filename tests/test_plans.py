"""Plan shape: the properties the design relies on at scale, read from the
physical plan (no execution needed for most of them)."""

import re

import pytest

from tests.conftest import SF_SMALL
from voltcube.plans import emulated, olap
from voltcube.plans.roles import Roles
from voltcube.plans.warehouse import Warehouse

NO_PAIRS = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scan_columns(plan: str, table: str) -> list[str]:
    for line in plan.splitlines():
        if "FileScan parquet" in line and f"/{table}.parquet" in line:
            return re.search(r"FileScan parquet \[([^\]]*)\]", line).group(1).split(",")
    raise AssertionError(f"no scan of {table}")


@pytest.fixture(scope="module")
def roles(spark):
    return Roles(spark, SF_SMALL, materialize=False)


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse.load(spark, SF_SMALL)


def test_lineitem_scan_is_pruned(roles):
    p = plan_of(roles.market_base)
    cols = [re.sub(r"#\d+L?", "", c) for c in scan_columns(p, "lineitem")]
    assert sorted(cols) == sorted(["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_tax",
                                   "l_returnflag", "l_linestatus"])
    assert len(scan_columns(p, "orders")) == 3
    assert len(scan_columns(plan_of(roles.nation_year), "orders")) == 5


def test_orders_reduced_before_customer_join(roles):
    """The customer decides the nation, so counting customers needs no second distinct shuffle."""
    p = plan_of(roles.nation_year)
    # Customer-years, then nation-years; two more where the customer join is not a broadcast.
    assert p.count("Exchange hashpartitioning") == (2 if "BroadcastHashJoin" in p else 4), p
    assert "partial_count" in p[p.index("Join"):]


def test_lineitem_reduced_before_supplier_join(roles):
    p = plan_of(roles.country_energy)
    lines = p.splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line and "s_suppkey" in line)
    partial = [i for i, line in enumerate(lines) if "partial_sum" in line and "l_quantity" in line]
    assert partial and all(i > join for i in partial), "lineitem must be partially aggregated below the join"


def test_many_suppliers_need_no_sums_of_their_own(spark, tmp_path, monkeypatch):
    """More supplier-years than a task's cache holds made the energy sums grow faster than the lines: nations are looked
    up first, with the same rows as by sums per supplier, whatever keys are null, repeated or unknown."""
    from voltcube.plans import roles as module
    spark.range(8100).selectExpr("if(id % 1000 = 7, null, id) as s_suppkey", "cast(if(id % 90 = 5, null, id % 25) as int) as s_nationkey") \
         .unionByName(spark.createDataFrame([(3, 4), (3, 4), (11, 20)], "s_suppkey long, s_nationkey int")).write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(30000).selectExpr(
        "if(id % 77 = 0, null, (id * 31) % 8300) as l_suppkey", "if(id % 13 = 1, null, cast(id % 50 as double) + 0.25) as l_quantity",
        "if(id % 17 = 2, null, (id % 9) / 100) as l_tax", "if(id % 19 = 3, null, (id % 11) / 100) as l_discount",
        "if(id % 23 = 4, null, substr('ANRX', cast(id % 4 as int) + 1, 1)) as l_returnflag", "if(id % 29 = 5, null, substr('FO', cast(id % 2 as int) + 1, 1)) as l_linestatus",
        "if(id % 31 = 6, null, timestamp'1995-03-01' + make_interval(cast(id % 7 as int))) as l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")

    def energy():
        return Roles(spark, str(tmp_path), materialize=False).country_energy

    first = plan_of(energy())
    assert "BroadcastHashJoin" in first and not re.search(r"hashpartitioning\(l_suppkey", first), first
    rows = sorted(map(str, energy().collect()))
    assert len(rows) == 26 * 8
    monkeypatch.setattr(module, "BROADCAST_SUPPLIERS", 8000)
    assert re.search(r"hashpartitioning\(l_suppkey", plan_of(energy()))
    assert sorted(map(str, energy().collect())) == rows


@pytest.mark.parametrize("fn", [olap.rollup_dense, emulated.rank_selfjoin, emulated.growth_selfjoin,
                                emulated.rollup_union])
def test_no_pairwise_joins(wh, fn):
    p = plan_of(fn(wh))
    assert not any(k in p for k in NO_PAIRS), p


def test_rollup_is_one_pass(wh):
    p = plan_of(olap.cube_sales(wh))
    assert p.count("Expand") == 1
    assert "Union" not in p


ROW_PYTHON = ("BatchEvalPython",)   # row-at-a-time Python UDF; Arrow UDFs show as ArrowEvalPython


def _registered():
    from voltcube.plans.registry import all_queries
    return all_queries()


@pytest.fixture()
def written_plans(monkeypatch):
    """Plans of every table that is written while a query runs (role facts, clean tables, published tables)."""
    from pyspark.sql import DataFrameWriter
    plans, write = [], DataFrameWriter.parquet

    def spy(self, path, *a, **k):
        plans.append(plan_of(self._df))
        return write(self, path, *a, **k)

    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    return plans


def test_written_steps_have_no_pairwise_join_or_row_python(spark, written_plans, tmp_path):
    """All steps behind the registered queries, from the raw tables on: a new input path gives new stores."""
    new = tmp_path / "input"
    new.symlink_to(SF_SMALL)
    for fn in _registered().values():
        written_plans.append(plan_of(fn(spark, str(new))))
    assert len(written_plans) > len(_registered()) + 30
    assert any("_grams" in p for p in written_plans)
    for p in written_plans:
        assert not any(k in p for k in NO_PAIRS + ROW_PYTHON + ("ArrowEvalPython",)), p


def test_pivot_sum_shuffles_once(spark):
    from voltcube.operators.reshape import pivot_sum
    df = spark.createDataFrame([("k", "fast", 2.0)], "k string, p string, v double")
    assert plan_of(pivot_sum(df, ["k"], "p", ["fast", "slow"], "v")).count("Exchange hashpartitioning") == 1


def test_growth_window_runs_on_the_key(wh):
    p = plan_of(olap.lag_growth(wh))
    assert "Exchange hashpartitioning(key_c" in p and "hashpartitioning(country" not in p


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """First-row-per-key and pivot-first keep one running value per task for
    a key holding a third of the rows: a partial aggregate sits below the
    exchange, so the hot group is never gathered whole into one task."""
    from voltcube.operators.joins import first_per_key
    from voltcube.operators.reshape import pivot_first
    rows = [("hot" if i % 3 == 0 else f"k{i}", "A" if i % 2 else "B", float(i), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, p string, v double, seq int").repartition(8)
    for out in (first_per_key(df, ["k"], "seq", ["v"]), pivot_first(df, ["k"], "p", ["A", "B"], "v", "seq")):
        p = plan_of(out)
        below = p[p.index("Exchange hashpartitioning"):]
        assert "partial_" in below, p


def test_bucketed_facts_meet_without_a_shuffle(spark, wh):
    """With broadcasts off no exchange lies under the joins of the facts (and the sum by their keys)."""
    w = wh.colocated(spark, 4)
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        m = w.ev_market.groupBy("key_c", "key_y").count()
        facts = m.join(w.country_energy, ["key_c", "key_y"]).join(w.country_macro, ["key_c", "key_y"])
        assert "Exchange" not in plan_of(facts) and plan_of(facts).count("SortMergeJoin") == 2
        whole = plan_of(olap.drill_across_3(w))
        assert whole.count("Exchange hashpartitioning") == 1 and "hashpartitioning(country" in whole
        plain = wh.ev_market.groupBy("key_c", "key_y").count().join(wh.country_energy, ["key_c", "key_y"])
        assert "Exchange" in plan_of(plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
