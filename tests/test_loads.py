"""Loads into a versioned store: crashes, increments, keys that stay, checks seen while writing, pruned years."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.test_plans import plan_of
from voltcube import schema as S
from voltcube.plans.cleaning import Cleaning
from voltcube.plans.model import Model, load_clean
from voltcube.plans.model_queries import split_loads
from voltcube.plans.warehouse import Warehouse, declared, key_checks
from voltcube.session import file_system, scratch_path
from voltcube.sources.store import Load, PublishError, Staged, VersionedStore, extend_keys


@pytest.fixture()
def store(spark):
    return VersionedStore(spark, scratch_path(spark, "loads"))


def rows(df):
    return sorted(map(tuple, df.collect()))


def files(store, version, name):
    """{year: file names} of a partitioned table."""
    out = {}
    for r in store.read(name, version).select("key_y", F.input_file_name()).distinct().collect():
        out.setdefault(r[0], set()).add(r[1])
    return out


# -- commits ---------------------------------------------------------------------------
@pytest.mark.parametrize("left", [b"", b'{"version": 1, "folder": "x", "lines": 2, "tab', b'{"version": 1, "folder": "x", "lines": 2, "table_name": "t", "rows": 1, "schema_json": "{}"}\n'])
def test_a_publisher_that_died_blocks_nobody(spark, store, left):
    fs, p = file_system(spark, f"{store.commits_path}/v00000001.json")
    out = fs.create(p, False)
    out.write(bytearray(left))
    out.close()
    df = spark.createDataFrame([(1,)], "k int")
    assert store.current_version() is None
    assert store.publish({"t": df}) == 2 and store.current_version() == 2
    assert store.publish({"t": df.union(df)}) == 3 and store.read("t").count() == 2 and store.read("t", 2).count() == 1


class _Failing:
    """An output stream whose close fails, before or after the bytes are out."""

    def __init__(self, real, written):
        self.real, self.written = real, written

    def write(self, data):
        if self.written:
            self.real.write(data)

    def close(self):
        self.real.close()
        raise OSError("connection lost")


@pytest.mark.parametrize("written", [True, False])
def test_a_failing_close_keeps_the_data_of_a_visible_commit(spark, store, monkeypatch, written):
    from voltcube.sources import store as module
    df = spark.createDataFrame([(1,), (2,)], "k int")
    assert store.publish({"t": df.limit(1)}) == 1
    real = module.file_system

    def failing(spark, path):
        fs, p = real(spark, path)
        if "/commits/v" not in path:
            return fs, p
        return SimpleNamespace(create=lambda p, over: _Failing(fs.create(p, over), written), exists=fs.exists), p

    with monkeypatch.context() as m:
        m.setattr(module, "file_system", failing)
        if written:
            assert store.publish({"t": df}) == 2
        else:
            with pytest.raises(OSError):
                store.publish({"t": df})
    assert rows(store.read("t")) == ([(1,), (2,)] if written else [(1,)])
    fs, p = file_system(spark, f"{store.root}/data")
    assert len(list(fs.listStatus(p))) == (2 if written else 1)
    assert store.publish({"t": df.union(df)}) == 3 and store.read("t").count() == 4


def test_an_unreadable_log_deletes_nothing(spark, store, monkeypatch):
    load = Load(store)
    load.write("t", spark.createDataFrame([(1,)], "k int"))
    load.committing = True
    with monkeypatch.context() as m:
        m.setattr(store, "_lines", lambda: (_ for _ in ()).throw(OSError("away")))
        load.__exit__(OSError, OSError(), None)
    fs, p = file_system(spark, load.path)
    assert fs.exists(p)


def test_a_load_on_an_older_version_fails(spark, store):
    df = spark.createDataFrame([(1, 1), (2, 2)], "k int, key_y int")
    v1 = store.publish({"t": Staged(df, partition_by="key_y")})
    late = Load(store, v1)
    late.write("t", Staged(df.where("key_y = 2"), partition_by="key_y"), replaces=[2])
    store.publish({"t": Staged(df, partition_by="key_y")})
    with pytest.raises(PublishError, match="no longer"), late:
        late.commit()
    fs, p = file_system(spark, late.path)
    assert not fs.exists(p) and store.current_version() == 2


# -- increments ------------------------------------------------------------------------------
def test_only_touched_years_and_changed_tables_are_written(spark, store):
    c = Cleaning.load(spark, SF_SMALL)
    first, second = split_loads(c)
    v1 = load_clean(store, first)
    v2 = load_clean(store, second, base=v1)
    years = {r.key_y: r.year for r in store.read("year_dim", v2).collect()}
    for fact in Model.FACTS:
        old, new = files(store, v1, fact), files(store, v2, fact)
        assert {years[y] for y in old} == {1995, 1996, 1997, 1998} and {years[y] for y in new} > {1999}
        for y in new:
            assert (old.get(y) == new[y]) == (years[y] < 1998), (fact, y)
        assert store.read(fact, v2).count() == sum(r.rows for r in store.manifest(v2).collect() if r.table_name == fact)
    # Dimensions without new labels point at the folder they are in.
    folder = {d: store.folders(d, v2) == store.folders(d, v1) for d in Model.DIMS}
    assert folder == {"country_dim": store.read("country_dim", v1).count() == store.read("country_dim", v2).count(), "year_dim": False, "vehicle_type_dim": True, "powertrain_dim": True}
    # The rows are those of one load; loading again changes none.
    whole = VersionedStore(spark, scratch_path(spark, "loads"))
    load_clean(whole, c)
    by_name = lambda s: (s.read("ev_market").join(s.read("country_dim"), "key_c").join(s.read("year_dim"), "key_y").join(s.read("vehicle_type_dim"), "key_v")
                         .join(s.read("powertrain_dim"), "key_p").select("iso_code", "year", "vehicle_type", "powertrain", "ev_sales", "ev_stock", "ev_stock_share"))
    assert rows(by_name(store)) == rows(by_name(whole))
    before = rows(by_name(store))
    v3 = load_clean(store, second, base=v2)
    assert rows(by_name(store)) == before and all(store.folders(d, v3) == store.folders(d, v2) for d in Model.DIMS)


def test_a_load_of_nothing_writes_nothing(spark, store):
    c = Cleaning.load(spark, SF_SMALL)
    v1 = load_clean(store, c)
    none = SimpleNamespace(**{t: getattr(c, t).limit(0) for t, _ in Model.FACTS.values()})
    v2 = load_clean(store, none, base=v1)
    assert v2 == v1 + 1 and all(store.folders(t, v1) == store.folders(t, v2) for t in S.TABLES)


def test_replacing_a_year_by_nothing_leaves_it_out(spark, store):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 2)], "k int, key_y int")
    v1 = store.publish({"t": Staged(df, partition_by="key_y"), "u": df})
    with Load(store, v1) as load:
        load.write("t", Staged(df.limit(0), partition_by="key_y"), replaces=[2])
        v2 = load.commit()
    assert rows(store.read("t", v2)) == [(1, 1)] and rows(store.read("u", v2)) == rows(df) and rows(store.read("t", v1)) == rows(df)


def test_keys_stay(spark):
    dim = lambda names: spark.createDataFrame([(n, n.lower() if n else n) for n in names], "iso string, name string")
    first = extend_keys(None, dim(["M", "K", None]), "iso", "key")
    assert rows(first) == [(1, "K", "k"), (2, "M", "m")]
    again = extend_keys(first, dim(["A", "K", "Z", None]).withColumn("name", F.lit("new")), "iso", "key")
    assert rows(again) == [(1, "K", "k"), (2, "M", "m"), (3, "A", "new"), (4, "Z", "new")]
    assert rows(extend_keys(again, dim([None]), "iso", "key")) == rows(again)
    assert rows(extend_keys(first.limit(0), dim(["A"]), "iso", "key")) == [(1, "A", "a")]


# -- checks seen while writing -----------------------------------------------------------------
def test_values_that_do_not_fit_are_named_violations(spark, store):
    w = Warehouse.load(spark, SF_SMALL)
    bad = w.ev_market.withColumn("ev_sales_share", F.when(F.col("key_y") == 4, F.lit(1e9)).otherwise(F.col("ev_sales_share").cast("double")))
    bad = bad.withColumn("ev_sales", F.when(F.col("key_c") == 1, F.lit(1e30)).otherwise(F.col("ev_sales").cast("double")))
    bad = bad.withColumn("ev_stock", F.when(F.col("key_c") == 2, F.lit(float("nan"))).otherwise(F.col("ev_stock").cast("double")))
    n = {k: w.ev_market.where(c).count() for k, c in (("share", "key_y = 4"), ("sales", "key_c = 1"), ("stock", "key_c = 2"))}
    with Load(store) as load:
        load.write("ev_market", declared("ev_market", bad))
        assert load.violations == {"ev_market.ev_sales_share_range": n["share"], "ev_market.ev_sales_range": n["sales"], "ev_market.ev_stock_range": n["stock"]}
        with pytest.raises(PublishError, match="ev_sales_share_range"):
            load.commit()


def test_null_and_long_values_and_keys_are_violations(spark, store):
    w = Warehouse.load(spark, SF_SMALL)
    t = w.tables()
    t["country_dim"] = t["country_dim"].withColumn("iso_code", F.when(F.col("key_c") == 3, F.lit("LONG")).otherwise(F.col("iso_code"))).withColumn(
        "country", F.when(F.col("key_c") < 2, F.lit(None)).otherwise(F.col("country")))
    t["ev_infrastructure"] = t["ev_infrastructure"].withColumn("key_c", F.when(F.col("key_c") == 4, F.lit(99)).otherwise(F.col("key_c")))
    t["country_macro"] = t["country_macro"].unionByName(t["country_macro"].where("key_c = 5"))
    t["country_energy"] = t["country_energy"].withColumn("key_y", F.when(F.col("key_y") == 2, F.lit(None)).otherwise(F.col("key_y")))
    with pytest.raises(PublishError) as failed, Load(store) as load:
        for n in S.TABLES:
            load.write(n, declared(n, t[n]))
        found = {(r.table_name, r.rule) for r in key_checks(load)(load.staged)["keys and references"].collect()}
        assert found == {("ev_infrastructure", "key_c_references_country_dim"), ("country_macro", "primary_key")}
        load.commit(key_checks(load))
    for rule in ("country_dim.iso_code_length (1)", "country_dim.country_not_null (2)", "country_energy.key_y_not_null", "keys and references (2)"):
        assert rule in str(failed.value)


def test_an_empty_table_is_written_and_counted(spark, store):
    v = store.publish({"t": spark.createDataFrame([], "k int"), "p": Staged(spark.createDataFrame([], "k int, key_y int"), partition_by="key_y")})
    assert store.read("t", v).count() == 0 and store.read("p", v).columns == ["k", "key_y"] and store.read("p", v).count() == 0
    assert rows(store.manifest(v)) == [("p", 0), ("t", 0)]


def test_every_table_is_written_once(spark, tmp_path, monkeypatch):
    """From a new input on: role facts, then each table of a store one time, and no table read again for its rules."""
    from pyspark.sql import DataFrameWriter
    new = tmp_path / "once"
    new.symlink_to(SF_SMALL)
    written, write = [], DataFrameWriter.parquet

    def spy(self, path, *a, **k):
        written.append(path.rsplit("/", 1)[1])
        return write(self, path, *a, **k)

    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    Cleaning.load(spark, str(new))
    Warehouse.load(spark, str(new))
    roles = [n for n in written if n.startswith("role-")]
    assert sorted(n for n in written if not n.startswith("role-")) == sorted([*Cleaning.TABLES, *S.TABLES]) and len(roles) == 6


# -- years ------------------------------------------------------------------------------------
def test_years_of_a_dimension_prune_the_fact(spark):
    w = Warehouse.load(spark, SF_SMALL)
    j = w.ev_market.join(F.broadcast(w.year_dim.where("year = 1997").select("key_y")), "key_y").groupBy("key_c").agg(F.sum("ev_sales"))
    assert "dynamicpruning" in plan_of(j)
    scan = [line for line in plan_of(w.ev_market.where("key_y = 3")).splitlines() if "PartitionFilters" in line]
    assert scan and "key_y" in scan[0]
    read = w.ev_market.where("key_y = 3").select(F.input_file_name()).distinct().collect()
    assert all("key_y=3/" in r[0] for r in read) and len(w.ev_market.inputFiles()) > len(read)
