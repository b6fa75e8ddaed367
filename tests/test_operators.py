"""Layers 3-4: edge semantics and invariants on small fixtures."""

import random

import pytest
from pyspark.sql import functions as F

from voltcube.functions.scalar import band, clean_name, gdp_class, ieee_divide, nan_to_null, to_int_rounded
from voltcube.operators.checks import duplicate_keys, orphan_rows, violation_counts
from voltcube.operators.grouping import cube_levels, grouping_sets, rollup_levels, union_of_levels
from voltcube.operators.joins import first_per_key
from voltcube.operators.measures import AdditivityError, measure_agg
from voltcube.operators.reshape import pivot_first, pivot_sum
from voltcube.operators.resolve import resolve_names, similarity_join
from voltcube.operators.windows import lag_growth, offset_join_growth, rank_by_greater_count, rank_desc
from voltcube.params import HALF_DECADE_BANDS, PANDEMIC_BANDS
from voltcube.schema import FLOW, LEVEL, UNIT
from voltcube.session import scratch_path
from voltcube.sources.files import read_csv, write_csv
from voltcube.sources.store import PublishError, VersionedStore, insert_absent, merge_upsert


def test_rank_desc_puts_nulls_first(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, "b", None), (1, "c", 7.0), (1, "d", 7.0)], "y int, c string, v double")
    r = {x.c: x.ranking for x in rank_desc(df, ["y"], "v").collect()}
    assert r == {"b": 1, "c": 2, "d": 2, "a": 4}


def test_greater_count_rank_matches_selfjoin_semantics(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, "b", None), (1, "c", 7.0), (1, "d", 7.0), (2, "e", 1.0)],
                               "y int, c string, v double")
    r = {x.c: x.ranking for x in rank_by_greater_count(df, ["y"], "v").collect()}
    # NULL never counted and ranks 1; ties share a rank with gaps.
    assert r == {"b": 1, "c": 1, "d": 1, "a": 3, "e": 1}


def test_lag_and_offset_join_differ_after_gap(spark):
    df = spark.createDataFrame([("x", 2000, 10), ("x", 2001, 15), ("x", 2003, 30)], "k string, year int, v int")
    lag = {r.year: (r.previous_year, r.yearly_growth) for r in lag_growth(df, ["k"], "year", "v").collect()}
    off = {r.year: (r.previous_year, r.yearly_growth) for r in offset_join_growth(df, ["k"], "year", "v").collect()}
    assert lag == {2000: (None, None), 2001: (10, 5), 2003: (15, 15)}
    assert off == {2000: (None, 10), 2001: (10, 5), 2003: (None, 30)}


def test_grouping_forms_agree(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), (None, "x", 4), ("b", None, 8)], "p string, q string, n int")
    aggs = [F.sum("n").alias("s")]
    for levels in (rollup_levels(["p", "q"]), cube_levels(["p", "q"]), [("p",), ()]):
        a = sorted(map(tuple, grouping_sets(df, ["p", "q"], levels, aggs).collect()), key=str)
        b = sorted(map(tuple, union_of_levels(df, ["p", "q"], levels, aggs).collect()), key=str)
        assert a == b


def test_int_cast_rounds(spark):
    df = spark.createDataFrame([(30.9,), (30.5,), (-2.5,), (2.4,)], "v double")
    assert [r[0] for r in df.select(to_int_rounded("v")).collect()] == [31, 31, -3, 2]


def test_ieee_divide_then_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (-3.0, 0.0), (6.0, 3.0), (None, 1.0)], "a double, b double")
    raw = [r[0] for r in df.select(ieee_divide("a", "b")).collect()]
    assert raw[0] == float("inf") and raw[1] != raw[1] and raw[2] == float("-inf") and raw[3] == 2.0 and raw[4] is None
    assert [r[0] for r in df.select(nan_to_null(ieee_divide("a", "b"))).collect()] == [None, None, None, 2.0, None]


def test_bands_open_at_both_ends(spark):
    df = spark.createDataFrame([(2005,), (2014,), (2015,), (2020,), (2021,), (2030,)], "year int")
    got = [(r[0], r[1]) for r in df.select(band("year", HALF_DECADE_BANDS), band("year", PANDEMIC_BANDS)).collect()]
    assert got == [("2010-2014", "Pre-Pandemic"), ("2010-2014", "Pre-Pandemic"), ("2015-2019", "Pre-Pandemic"),
                   ("2020-2023", "Pandemic"), ("2020-2023", "Pandemic"), ("2020-2023", "Post-Pandemic")]


def test_gdp_class_null_is_low(spark):
    df = spark.createDataFrame([(2e12,), (1e12,), (5e11,), (1e11,), (None,)], "g double")
    assert [r[0] for r in df.select(gdp_class("g")).collect()] == \
        ["High GDP", "High GDP", "Medium GDP", "Medium GDP", "Low GDP"]


def test_clean_name_order_matters(spark):
    df = spark.createDataFrame([("Republic of Korea",), ("  Russian Federation ",), ("Korea, Democratic People's Republic of",)],
                               "n string")
    assert [r[0] for r in df.select(clean_name("n")).collect()] == ["korea", "russian", "korea,  "[:-2]]
    odd = spark.createDataFrame([("\tFrance\n",), ("\u00a0 Kingdom of\u2003Spain\x1f\u3000",)], "n string")
    assert [r[0] for r in odd.select(clean_name("n")).collect()] == ["france", "spain"]


def test_pivot_first_takes_first_non_null_in_order(spark):
    df = spark.createDataFrame([("k", "A", None, 1), ("k", "A", 5.0, 2), ("k", "A", 6.0, 3), ("k", "B", 1.0, 1),
                                ("m", "B", None, 1)], "k string, p string, v double, seq int")
    out = {r.k: (r.a, r.b, r.c) for r in pivot_first(df, ["k"], "p", ["A", "B", "C"], "v", "seq").collect()}
    assert out == {"k": (5.0, 1.0, None)}   # group "m" has no value at all and is dropped


def test_pivot_sum_fills_zero(spark):
    df = spark.createDataFrame([("k", "fast", 2.0), ("k", "fast", 3.0), ("m", "slow", 1.0)], "k string, p string, v double")
    df = df.unionByName(spark.createDataFrame([(None, "fast", 9.0)], df.schema))     # no index value: dropped
    out = {r.k: (r.fast, r.slow) for r in pivot_sum(df, ["k"], "p", ["fast", "slow"], "v").collect()}
    assert out == {"k": (5.0, 0.0), "m": (0.0, 1.0)}


def test_first_per_key_first_and_last(spark):
    df = spark.createDataFrame([("AZE", "Asia", 1), ("AZE", "Europe", 2), ("ARM", "Europe", 3)], "iso string, c string, seq int")
    assert {r.iso: r.c for r in first_per_key(df, ["iso"], "seq", ["c"]).collect()} == {"AZE": "Asia", "ARM": "Europe"}
    assert {r.iso: r.c for r in first_per_key(df, ["iso"], "seq", ["c"], last=True).collect()}["AZE"] == "Europe"


def grams(x):
    p = f"  {x} "
    return {p[i:i + 3] for i in range(len(x) + 1)}


def similarity(a, b):
    a, b = grams(a), grams(b)
    return len(a & b) / len(a | b)


def test_similarity_join_equals_brute_force(spark):
    rnd = random.Random(7)
    alphabet = "abcdeklmnorst "
    cands = sorted({"".join(rnd.choice(alphabet) for _ in range(rnd.randint(3, 14))) for _ in range(60)} | {""})
    queries = sorted({c[:-1] + rnd.choice(alphabet) if rnd.random() < .7 else "".join(rnd.sample(c, len(c)))
                      for c in rnd.sample(cands, 30)} | {"zzzz", "", "a", "aaaa"})
    qd = spark.createDataFrame([(q,) for q in queries], "q string")
    cd = spark.createDataFrame([(c,) for c in cands], "c string")
    for cutoff in (0.3, 0.5, 0.8):
        got = {(r.q, r.c): r.score for r in similarity_join(qd, "q", cd, "c", cutoff).collect()}
        want = {(q, c): similarity(q, c) for q in queries for c in cands if similarity(q, c) >= cutoff}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_similarity_candidates_are_few_and_no_gram_is_hot(spark):
    from voltcube.operators.resolve import candidate_pairs
    rnd = random.Random(11)
    parts = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 4))) for _ in range(900)]
    names = sorted({"".join(rnd.choice(parts) for _ in range(rnd.randint(2, 4))) for _ in range(2000)})
    df = spark.createDataFrame([(n,) for n in names], "n string")
    pairs = candidate_pairs(df, "n", df.withColumnRenamed("n", "c"), "c").count()
    assert pairs <= 0.03 * len(names) ** 2, pairs
    from pyspark.sql import functions as F
    from voltcube.operators.resolve import _prefixes
    from voltcube.functions.similarity import trigrams
    s = df.select(F.lit(0).alias("_g"), F.col("n").alias("_q"), trigrams(F.col("n")).alias("_grams"))
    freq = s.select("_g", F.explode("_grams").alias("gram")).groupBy("_g", "gram").agg(F.count("*").alias("_f"))
    joined = _prefixes(s, "_q", freq, 0.5).groupBy("gram").agg((F.count("*") * F.count("*")).alias("rows"))
    total, top = joined.agg(F.sum("rows"), F.max("rows")).first()
    assert total <= 0.03 * len(names) ** 2 and top <= 0.01 * total, (total, top)


def test_resolution_steps(spark):
    cands = spark.createDataFrame([("South Korea", "KOR", 1), ("Russia", "RUS", 2), ("Germany", "DEU", 3),
                                   ("United Kingdom", "GBR", 4), ("North Koreas", "PRK", 5)],
                                  "cand string, iso string, seq int")
    # "North Korea" scores high against "North Koreas" (fuzzy), but the alias
    # step comes first and wins: fuzzy steps only see names no exact step resolves.
    names = spark.createDataFrame([("germany",), ("RUS",), ("Kingdom of Germany",), ("Korea, Rep.",),
                                   ("Untied Kingdom",), ("Atlantis",), ("North Korea",), ("\u00a0Russia\t\n",)], "name string")
    got = {r.name: (r.iso_code, r.step) for r in resolve_names(names, cands).collect()}
    assert got == {"germany": ("DEU", 1), "RUS": ("RUS", 2), "Kingdom of Germany": ("DEU", 3),
                   "Korea, Rep.": ("KOR", 4), "Untied Kingdom": ("GBR", 5), "North Korea": ("KOR", 4), "\u00a0Russia\t\n": ("RUS", 3)}


def test_measure_agg_refuses_illegal_sums(spark):
    df = spark.createDataFrame([("a", 2000, 1, 2.0, 0.5)], "c string, year int, s int, stock double, share double")
    add = {"s": FLOW, "stock": LEVEL, "share": UNIT}
    assert measure_agg(df, ["c", "year"], add).count() == 1
    with pytest.raises(AdditivityError):
        measure_agg(df, ["c"], add)                                  # level summed over time
    with pytest.raises(AdditivityError):
        measure_agg(df, ["c", "year"], add, requested={"share": "sum"})   # unit summed
    assert measure_agg(df, ["c", "year"], add, requested={"share": "sum"}, allow=["share"]).count() == 1
    assert measure_agg(df, ["c"], add, requested={"stock": "max"}).count() == 1


def test_upsert_is_idempotent_and_last_wins(spark):
    t = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    u = spark.createDataFrame([(2, 21, 1), (2, 22, 2), (3, 30, 1)], "k int, v int, o int")
    once = merge_upsert(t, u, ["k"], order="o")
    twice = merge_upsert(once, u, ["k"], order="o")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [(1, 10), (2, 22), (3, 30)]


def test_insert_absent_first_wins(spark):
    t = spark.createDataFrame([("A", "x")], "k string, v string")
    n = spark.createDataFrame([("A", "y"), ("B", "z")], "k string, v string")
    assert sorted(map(tuple, insert_absent(t, n, ["k"]).collect())) == [("A", "x"), ("B", "z")]


def test_publish_is_all_or_nothing(spark):
    store = VersionedStore(spark, scratch_path(spark, "test-store"))
    good = spark.createDataFrame([(1,), (2,)], "k int")
    v1 = store.publish({"t": good}, lambda tabs: {"pk": duplicate_keys(tabs["t"], ["k"])})
    bad = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(PublishError):
        store.publish({"t": bad}, lambda tabs: {"pk": duplicate_keys(tabs["t"], ["k"])})
    assert store.current_version() == v1
    assert sorted(r.k for r in store.read("t").collect()) == [1, 2]


def test_read_all_uses_the_schema_recorded_at_publish(spark):
    store = VersionedStore(spark, scratch_path(spark, "test-store-schema"))
    df = spark.createDataFrame([(1, "a")], "k int, s string").selectExpr("k", "s", "cast(k as decimal(10,2)) as d")
    v = store.publish({"t": df})
    back = store.read_all(["t"], v)["t"]
    assert back.dtypes == df.dtypes and back.collect() == df.collect()


def test_an_unreadable_log_is_not_an_empty_store(spark, monkeypatch):
    store = VersionedStore(spark, scratch_path(spark, "test-store-log"))
    df = spark.createDataFrame([(1,)], "k int")
    assert store.current_version() is None and store.publish({"t": df}) == 1
    from pyspark.sql.readwriter import DataFrameReader

    def fail(self, *a, **k):
        raise OSError("storage is away")

    with monkeypatch.context() as m:
        m.setattr(DataFrameReader, "json", fail)
        with pytest.raises(OSError):
            store.current_version()
        with pytest.raises(OSError):
            store.publish({"t": df.union(df)})
    assert store.current_version() == 1 and [r.k for r in store.read("t").collect()] == [1]


def test_two_publishers_get_two_versions(spark, monkeypatch):
    root = scratch_path(spark, "test-store-race")
    a, b = VersionedStore(spark, root), VersionedStore(spark, root)
    df = spark.createDataFrame([(1,)], "k int")
    seen = a.current_version
    stale = iter([None])                # a looks at the log before b commits
    monkeypatch.setattr(a, "current_version", lambda: next(stale, None) or seen())
    real = b._commit
    assert b.publish({"t": df}) == 1
    assert a.publish({"t": df.union(df)}) == 2 and real is not None
    assert len(b.read("t", 1).collect()) == 1 and len(b.read("t", 2).collect()) == 2


def test_a_half_written_commit_is_no_version(spark):
    from voltcube.session import file_system
    store = VersionedStore(spark, scratch_path(spark, "test-store-half"))
    df = spark.createDataFrame([(1,)], "k int")
    store.publish({"t": df, "u": df})
    fs, p = file_system(spark, f"{store.commits_path}/v00000002.json")
    out = fs.create(p, False)
    out.write(bytearray(b'{"version": 2, "folder": "x", "lines": 2, "table_name": "t", "rows": 1, "schema_json": "{}"}\n'))
    out.close()
    assert store.current_version() == 1


def test_failed_publish_leaves_no_files(spark):
    from voltcube.session import file_system
    store = VersionedStore(spark, scratch_path(spark, "test-store-clean"))
    with pytest.raises(PublishError):
        store.publish({"t": spark.createDataFrame([(1,)], "k int")}, lambda t: {"never": t["t"]})
    fs, p = file_system(spark, f"{store.root}/data")
    assert len(list(fs.listStatus(p))) == 0


def test_only_a_local_master_gets_a_folder_of_its_own(spark, monkeypatch):
    from types import SimpleNamespace

    from voltcube.session import SharedFolderError, is_local, shared_dir
    assert is_local("local[4]") and not is_local("local-cluster[2,1,1024]") and not is_local("yarn")
    fake = SimpleNamespace(sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None), conf=SimpleNamespace(get=lambda k, d: d))
    with pytest.raises(SharedFolderError):
        shared_dir(fake)


def test_store_follows_path_files_and_parameters(spark, tmp_path):
    import shutil

    from voltcube.params import RoleParams
    from voltcube.plans.roles import Roles
    from voltcube.plans.stored import store_for
    from voltcube.plans.warehouse import Warehouse
    long = "x" * 90
    a, b = tmp_path / "a" / long / "data", tmp_path / "b" / long / "data"
    for d, src in ((a, "/root/testdata/sf0.001"), (b, "/root/testdata/sf0.01")):
        d.parent.mkdir(parents=True)
        d.symlink_to(src)
    roots = {store_for(Roles(spark, str(d)), "warehouse").root for d in (a, b)}
    assert len(roots) == 2
    assert Warehouse.load(spark, str(a)).ev_market.count() != Warehouse.load(spark, str(b)).ev_market.count()
    # Other files under the same path, and other parameters, give another store.
    own = tmp_path / "own"
    own.mkdir()
    shutil.copy("/root/testdata/sf0.001/nation.parquet", own)
    before = store_for(Roles(spark, str(own)), "warehouse").root
    shutil.copy("/root/testdata/sf0.001/region.parquet", own)
    assert store_for(Roles(spark, str(own)), "warehouse").root != before
    p = RoleParams(gap_mod=2, gap_year=1997)
    assert Roles(spark, str(a), p).ev_infrastructure.count() != Roles(spark, str(a)).ev_infrastructure.count()
    assert store_for(Roles(spark, str(a), p), "warehouse").root != store_for(Roles(spark, str(a)), "warehouse").root


def test_scratch_tables_go(spark):
    from voltcube import session
    path = scratch_path(spark, "test-scratch")
    spark.range(3).write.parquet(path)
    app = spark.sparkContext.applicationId
    others = [p for p in session._SCRATCH[app] if p != path]
    session._SCRATCH[app] = [path]
    assert session.clear_scratch(spark) == 1 and not session.file_system(spark, path)[0].exists(session.file_system(spark, path)[1])
    session._SCRATCH[app] = others


def test_package_imports_from_an_archive(tmp_path):
    import subprocess
    import sys
    import zipfile
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    with zipfile.ZipFile(tmp_path / "p.zip", "w") as z:
        for f in (root / "voltcube").rglob("*.py"):
            z.write(f, f.relative_to(root))
    code = f"import sys; sys.path.insert(0, {str(tmp_path / 'p.zip')!r}); import voltcube.plans.registry as r; assert '.zip' in r.__file__; r.all_queries()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path)


def test_first_of_two_names_and_pivots_do_not_depend_on_row_order(spark):
    from voltcube.plans.model import first_of_sources
    rows = [("B", "X1", 2000, "p"), ("A", "X1", 2001, "q"), ("A", "X1", 2000, "r")]
    co2 = spark.createDataFrame(rows, "country string, iso_code string, year int, continent string")
    for n in (1, 2, 3):
        got = first_of_sources(co2.limit(0), co2.repartition(n, "year"), "iso_code", ["country", "continent"]).collect()
        assert [tuple(r) for r in got] == [("X1", "A", "r")]


def test_checks_find_seeded_violations(spark):
    fact = spark.createDataFrame([(1, 1), (1, 1), (9, 2), (None, 3)], "key_c int, key_y int")
    dim = spark.createDataFrame([(1,)], "key_c int")
    assert duplicate_keys(fact, ["key_c", "key_y"]).count() == 1
    assert [r.key_c for r in orphan_rows(fact, dim, ["key_c"]).collect()] == [9]
    counts = {r.rule: r.violations for r in violation_counts(fact, "f", {"null_key": F.col("key_c").isNull()}).collect()}
    assert counts == {"null_key": 1}


def test_csv_keeps_literal_na(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("code", T.StringType())])
    df = spark.createDataFrame([("Namibia", "NA"), ("Nowhere", None), ("Empty", "")], schema)
    path = scratch_path(spark, "test-csv")
    write_csv(df, path)
    back = {r.name: r.code for r in read_csv(spark, path, schema).collect()}
    assert back == {"Namibia": "NA", "Nowhere": None, "Empty": None}
    kept = {r.name: r.code for r in read_csv(spark, path, schema, keep_empty=True).collect()}
    assert kept["Namibia"] == "NA" and kept["Nowhere"] == ""


def test_exact_mean_matches_decimal_arithmetic(spark):
    from decimal import ROUND_HALF_UP, Decimal

    from voltcube.functions.scalar import exact_mean
    rnd = random.Random(3)
    rows = [(g, Decimal(rnd.randint(-10 ** 7, 10 ** 7)).scaleb(-6)) for g in range(6) for _ in range(rnd.randint(1, 9))]
    rows += [(6, Decimal("0.000001")), (6, Decimal("0.000002"))]     # mean 0.0000015, a tie
    rows += [(7, Decimal("-0.000001")), (7, Decimal("-0.000002"))]                                      # mean -0.0000015
    df = spark.createDataFrame(rows, "g int, x decimal(10,6)")
    got = {r.g: r.m for r in df.groupBy("g").agg(exact_mean("x", 6, out_scale=6).alias("m")).collect()}
    for g in {g for g, _ in rows}:
        xs = [x for k, x in rows if k == g]
        exact = (sum(xs) / len(xs)).quantize(Decimal("0.000001"), rounding=ROUND_HALF_UP)
        assert got[g] == float(exact), (g, got[g], exact)


def test_hot_key_holding_a_third_of_rows(spark):
    n = 3000
    rows = [("hot" if i % 3 == 0 else f"k{i}", "A" if i % 2 else "B", float(i), i) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, p string, v double, seq int").repartition(8)
    first = {r.k: r.v for r in first_per_key(df, ["k"], "seq", ["v"]).collect()}
    assert first["hot"] == 0.0 and len(first) == 1 + (n - n // 3)
    piv = {r.k: (r.a, r.b) for r in pivot_first(df, ["k"], "p", ["A", "B"], "v", "seq").collect()}
    assert piv["hot"] == (3.0, 0.0)
    up = merge_upsert(df.select("k", "seq").dropDuplicates(["k"]), df.select("k", "seq"), ["k"], order="seq")
    assert {r.k: r.seq for r in up.collect()}["hot"] == max(i for i in range(n) if i % 3 == 0)


def test_units_are_those_of_decimals(spark):
    """Longs count what the decimals hold, ties, large values and negative ones too; products round as theirs do."""
    from voltcube.functions.scalar import from_units, scaled_units, to_decimal, to_units
    values = [None, 0.0, -0.0, 1.005, 2.675, -1.005, 0.07, 0.00005, -0.00005, 1.00005, 104949.5, 1 / 3, -2.5, 99999999.995, 7e13, -6e13, 12345678901234.0]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    for scale in (2, 4):
        both = df.select("x", to_decimal("x", 18, scale).alias("a"), from_units(to_units("x", 18, scale), 18, scale).alias("b"))
        assert both.where("not (a <=> b)").collect() == []
    rated = df.crossJoin(spark.createDataFrame([(0.0,), (0.07,), (-0.05,), (0.1,)], "t double"))
    both = rated.select("x", "t", (to_decimal("x", 18, 4) * (1 + to_decimal("t", 4, 2))).cast("decimal(18,4)").alias("a"),
                        from_units(scaled_units(to_units("x", 18, 4), 100 + to_units("t", 4, 2)), 18, 4).alias("b"))
    assert both.where("not (a <=> b)").collect() == []


def test_large_role_sums_are_sums_of_longs(spark):
    """Sums over lineitem and orders run on longs: decimals of more than 18 digits took most of a build's time."""
    import re

    from tests.conftest import SF_SMALL
    from voltcube.plans.roles import Roles
    roles = Roles(spark, SF_SMALL, materialize=False)
    for name in ("country_energy", "market_base", "nation_year"):
        plan = getattr(roles, name)._jdf.queryExecution().optimizedPlan().toString()
        lowest = [line for line in plan.splitlines() if "Aggregate [" in line][-1]
        assert "sum(" in lowest and not re.search(r"sum\([^()]*cast\([^()]* as decimal", lowest), lowest
        assert "decimal(28" not in lowest
