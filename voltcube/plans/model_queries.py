"""Query keys of the model, the sinks, the checks and the timing summary
(SURVEY 2.1, 2.5 A16-A17, 2.13)."""

from __future__ import annotations

from functools import reduce
from types import SimpleNamespace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltcube import schema as S
from voltcube.operators.checks import duplicate_keys, max_length, not_null, orphan_rows, out_of_range, profile, violation_counts
from voltcube.operators.joins import absent
from voltcube.operators.measures import measure_agg as measure_agg_op
from voltcube.plans.cleaning import Cleaning
from voltcube.plans.compare import summarize_timings
from voltcube.plans.model import Model, load_clean, load_pipeline
from voltcube.plans.olap import drill_across_3, r6, rank_stock
from voltcube.plans.roles import Roles
from voltcube.plans.warehouse import Warehouse, constraint_violations, declared, rejected_rows
from voltcube.session import scratch_path
from voltcube.sources.files import read_csv, read_parquet, write_csv, write_parquet
from voltcube.sources.store import Load, VersionedStore, insert_absent as insert_absent_op, merge_upsert

# Seeding rule for the checks: rows with key_c % SEED_MOD == 0 are made to
# violate a constraint, so a check is seen finding something.
SEED_MOD = 7


def _b(c):
    return F.col(c).cast("bigint").alias(c)


def _model(spark, sf_dir) -> Model:
    return Model(Cleaning.load(spark, sf_dir))


# -- model -----------------------------------------------------------------
def dim_build(spark, sf_dir) -> DataFrame:
    d = _model(spark, sf_dir).country_dim
    return d.select(_b("key_c"), "iso_code", "country", "continent", "continent_code")


def year_dim_build(spark, sf_dir) -> DataFrame:
    d = _model(spark, sf_dir).year_dim
    return d.select(_b("key_y"), _b("year"), "half_decade", "pandemic_period")


def _fact(spark, sf_dir, name: str) -> DataFrame:
    """A keyed fact with its whole numbers as bigint and its decimals as doubles."""
    f = _model(spark, sf_dir).fact(name)
    return f.select(*[_b(c) if t in ("int", "bigint") else r6(c).alias(c) for c, t in f.dtypes])


def key_resolve(spark, sf_dir) -> DataFrame:
    return _fact(spark, sf_dir, "ev_market")


def key_resolve_infra(spark, sf_dir) -> DataFrame:
    return _fact(spark, sf_dir, "ev_infrastructure")


def key_resolve_energy(spark, sf_dir) -> DataFrame:
    return _fact(spark, sf_dir, "country_energy")


def key_resolve_macro(spark, sf_dir) -> DataFrame:
    return _fact(spark, sf_dir, "country_macro")


def pipeline_rank_stock(spark, sf_dir) -> DataFrame:
    """Raw tables -> clean tables -> dimensions -> keyed facts -> checked load ->
    the stock ranking on the published store."""
    return rank_stock(load_pipeline(spark, sf_dir))


def key_skips(spark, sf_dir) -> DataFrame:
    return _model(spark, sf_dir).skips()


def coverage_gap(spark, sf_dir) -> DataFrame:
    """EV (country, year) pairs absent from each other clean table."""
    c = Cleaning.load(spark, sf_dir)
    tables = {"ev_market": c.market_clean, "ev_infrastructure": c.infra_clean, "co2": c.co2_clean, "energy": c.energy_clean}
    return absent(tables, ["iso_code", "year"], "ev_market", "missing_in").select("missing_in", "iso_code", _b("year"))


# -- sinks -----------------------------------------------------------------
def upsert_fact(spark, sf_dir) -> DataFrame:
    """Target = infrastructure fact; updates = one year's rows + 1 and the same
    rows under a new year key. Written, merged, written as a new table, read back."""
    infra = Roles(spark, sf_dir).ev_infrastructure.drop("charging_points_per_ev")
    path = scratch_path(spark, "upsert")
    write_parquet(infra, f"{path}/v1")
    target = read_parquet(spark, f"{path}/v1")
    base = target.where(F.col("key_y") == 3)
    measures = ["ev_charging_points", "fast_charging_points", "slow_charging_points"]
    changed = base.select("key_c", "key_y", *[(F.col(m) + 1).alias(m) for m in measures])
    added = base.select("key_c", F.lit(8).alias("key_y"), *measures)
    merged = merge_upsert(target, changed.unionByName(added), ["key_c", "key_y"])
    write_parquet(merged, f"{path}/v2")
    out = read_parquet(spark, f"{path}/v2")
    return out.select(_b("key_c"), _b("key_y"), *[_b(m) for m in measures])


def insert_absent(spark, sf_dir) -> DataFrame:
    """Target = countries with key < 20; new = every country under a lower-case
    name. Existing keys keep their row, the others come in."""
    cd = Roles(spark, sf_dir).country_dim
    target = cd.where(F.col("key_c") < 20).select("iso_code", "country", "continent")
    new = cd.select("iso_code", F.lower("country").alias("country"), "continent")
    return insert_absent_op(target, new, ["iso_code"])


def upsert_market(spark, sf_dir) -> DataFrame:
    """The 4-column key: updates are one year's market rows with doubled sales, then the
    same rows again with sales + 1 (the later statement wins), and new year rows."""
    w = Warehouse.load(spark, sf_dir)
    keys = ["key_c", "key_y", "key_v", "key_p"]
    target = w.ev_market.select(*keys, "ev_sales", "ev_stock")
    base = target.where(F.col("key_y") == 3)
    updates = (base.withColumn("ev_sales", F.col("ev_sales") * 2).withColumn("nr", F.lit(1))
                   .unionByName(base.withColumn("ev_sales", F.col("ev_sales") + 1).withColumn("nr", F.lit(2)))
                   .unionByName(base.withColumn("key_y", F.lit(8)).withColumn("nr", F.lit(1))))
    path = scratch_path(spark, "upsert-market")
    write_parquet(merge_upsert(target, updates, keys, order="nr"), path)
    return read_parquet(spark, path).select(*[_b(k) for k in keys], _b("ev_sales"), r6("ev_stock").alias("ev_stock"))


#: The loads of ``load_increment`` meet in this year and at this code: the first one has the years up to it, with the
#: codes up to this one not final yet; the second one brings these again and the years after.
SPLIT_YEAR, SPLIT_CODE = 1998, "N12"

#: Measure that ``load_increment`` adds up, by fact.
CONTROL = {"ev_market": "ev_sales", "ev_infrastructure": "ev_charging_points", "country_energy": "electricity_generation", "country_macro": "co2_emissions"}


def split_loads(c) -> tuple[SimpleNamespace, SimpleNamespace]:
    """The clean tables as two loads, the second correcting the first and going on from it."""
    again = (F.col("year") == SPLIT_YEAR) & (F.col("iso_code") <= SPLIT_CODE)
    first, second = {}, {}
    for name, (clean, measures) in Model.FACTS.items():
        df = getattr(c, clean)
        doubled = [F.when(again, F.col(x) * 2).otherwise(F.col(x)).alias(x) if x == measures[CONTROL[name]] else F.col(x) for x in df.columns]
        first[clean] = df.where(F.col("year") <= SPLIT_YEAR).select(*doubled)
        second[clean] = df.where((F.col("year") > SPLIT_YEAR) | again)
    return SimpleNamespace(**first), SimpleNamespace(**second)


def _written_by(store: VersionedStore, version: int, name: str, folders: list[str]) -> DataFrame:
    """A table's rows with the number of the load that wrote their file (1 for the first of ``folders``)."""
    file, number = F.input_file_name(), F.lit(None).cast("bigint")
    for i, f in enumerate(folders, 1):
        number = F.when(file.contains(f"/{f}/"), F.lit(i).cast("bigint")).otherwise(number)
    return store.read(name, version).withColumn("load", number)


def load_increment(spark, sf_dir) -> DataFrame:
    """Two loads in sequence into one store. Per fact, country and year: rows and the sum of a measure, as one load
    of everything gives them, and the load that wrote the files they are read from."""
    first, second = split_loads(Cleaning.load(spark, sf_dir))
    store = VersionedStore(spark, scratch_path(spark, "increment"))
    v1 = load_clean(store, first)
    v2 = load_clean(store, second, base=v1)
    dims = store.read_all(("country_dim", "year_dim"), v2)
    parts = []
    for fact, measure in CONTROL.items():
        order = [*store.folders(fact, v1), *store.folders(fact, v2).keys() - store.folders(fact, v1).keys()]
        j = _written_by(store, v2, fact, order).join(F.broadcast(dims["country_dim"]), "key_c").join(F.broadcast(dims["year_dim"]), "key_y")
        parts.append(j.groupBy(F.lit(fact).alias("fact_name"), "iso_code", _b("year"), "load").agg(
            F.count(F.lit(1)).cast("bigint").alias("n"), r6(F.sum(measure)).alias("total")))
    return reduce(DataFrame.unionByName, parts)


def dim_reload(spark, sf_dir) -> DataFrame:
    """Keys after a first load without the codes, years and vehicle types that sort first, and after a second load of
    everything: known labels keep theirs, unseen ones follow."""
    c = Cleaning.load(spark, sf_dir)
    late = (F.col("iso_code") > "N04") & (F.col("year") > 1995)
    first = SimpleNamespace(market_clean=c.market_clean.where(late & (F.col("vehicle_type") >= "F")),
                            **{t: getattr(c, t).where(late) for t in ("infra_clean", "co2_clean", "energy_clean")})
    store = VersionedStore(spark, scratch_path(spark, "reload"))
    v1 = load_clean(store, first)
    v2 = load_clean(store, c, base=v1)
    parts = []
    for dim, (label, key) in Model.DIMS.items():
        before = store.read(dim, v1).select(label, F.col(key).cast("bigint").alias("first_key"))
        parts.append(store.read(dim, v2).join(before, label, "left").select(
            F.lit(dim).alias("dim_name"), F.col(label).cast("string").alias("label"), "first_key", F.col(key).cast("bigint").alias("key")))
    return reduce(DataFrame.unionByName, parts)


def upsert_years(spark, sf_dir) -> DataFrame:
    """A published fact and an upsert of one year's rows (sales doubled) and of a year that is new: only the folders of
    these years are written; ``load`` is the load whose files a row is read from."""
    w = Warehouse.load(spark, sf_dir)
    keys = ["key_c", "key_y", "key_v", "key_p"]
    store = VersionedStore(spark, scratch_path(spark, "upsert-years"))
    v1 = store.publish({"ev_market": declared("ev_market", w.ev_market)})
    base = w.ev_market.where(F.col("key_y") == 3)
    updates = base.withColumn("ev_sales", F.col("ev_sales") * 2).unionByName(base.withColumn("key_y", F.lit(8)))
    with Load(store, v1) as load:
        years = [3, 8]
        known = store.read("ev_market", v1).where(F.col("key_y").isin(years))
        load.write("ev_market", declared("ev_market", merge_upsert(known, updates, keys)), replaces=years)
        v2 = load.commit()
    out = _written_by(store, v2, "ev_market", [*store.folders("ev_market", v1), load.folder])
    return out.select(*[_b(k) for k in keys], _b("ev_sales"), r6("ev_stock").alias("ev_stock"), "load")


def publish_snapshot(spark, sf_dir) -> DataFrame:
    """All warehouse tables published as one version; returns the manifest."""
    store = VersionedStore(spark, scratch_path(spark, "warehouse"))
    v = Warehouse.publish(store, Roles(spark, sf_dir))
    return store.manifest(v).select("table_name", _b("rows"))


def sink_roundtrip(spark, sf_dir) -> DataFrame:
    """Fact written as Parquet partitioned by year with bounded files, read back."""
    infra = Roles(spark, sf_dir).ev_infrastructure
    path = scratch_path(spark, "roundtrip")
    write_parquet(infra, path, partition_by=["key_y"], max_records_per_file=500)
    back = read_parquet(spark, path)
    return back.select(_b("key_c"), _b("key_y"), _b("ev_charging_points"), _b("fast_charging_points"),
                       _b("slow_charging_points"))


CSV_COUNTRY_SCHEMA = S.COUNTRY_DIM


def scan_csv(spark, sf_dir) -> DataFrame:
    """Country dimension through CSV: the literal 'NA' code survives, an empty
    field reads back as NULL."""
    cd = Roles(spark, sf_dir).country_dim
    path = scratch_path(spark, "csv")
    write_csv(cd, path)
    back = read_csv(spark, path, CSV_COUNTRY_SCHEMA)
    return back.select(_b("key_c"), "country", "iso_code", "continent", "continent_code")


# -- checks ------------------------------------------------------------------
def check_unique(spark, sf_dir) -> DataFrame:
    infra = Roles(spark, sf_dir).ev_infrastructure
    seeded = infra.unionByName(infra.where(F.col("key_c") % SEED_MOD == 0))
    return duplicate_keys(seeded, ["key_c", "key_y"]).select(_b("key_c"), _b("key_y"), _b("n"))


def check_fk(spark, sf_dir) -> DataFrame:
    r = Roles(spark, sf_dir)
    e = r.country_energy.select(
        F.when(F.col("key_c") % SEED_MOD == 0, F.col("key_c") + 100).otherwise(F.col("key_c")).alias("key_c"), "key_y")
    return orphan_rows(e, r.country_dim, ["key_c"]).select(_b("key_c"), _b("key_y"))


def check_domain(spark, sf_dir) -> DataFrame:
    r = Roles(spark, sf_dir)
    seed = F.col("key_c") % SEED_MOD
    cd = r.country_dim.select(
        "key_c", F.when(seed == 0, F.lit(None)).otherwise(F.col("country")).alias("country"),
        F.when(seed == 1, F.concat("iso_code", F.lit("X"))).otherwise(F.col("iso_code")).alias("iso_code"),
        "continent", "continent_code")
    c_rules = {"country_not_null": not_null("country"), "iso_code_not_null": not_null("iso_code"),
               "iso_code_length": max_length("iso_code", S.TEXT_LENGTHS["iso_code"]),
               "continent_code_length": max_length("continent_code", S.TEXT_LENGTHS["continent_code"])}
    em = r.ev_market.select("ev_sales", F.col("ev_sales_share").cast("double").alias("s"),
                            F.col("ev_stock").cast("double").alias("k"))
    m_rules = {"ev_sales_not_null": not_null("ev_sales"),
               "ev_sales_share_range": out_of_range("s", S.decimal_bound(S.EV_MARKET["ev_sales_share"].dataType)),
               "ev_stock_negative": F.col("k") < 0}
    return violation_counts(cd, "country_dim", c_rules).unionByName(violation_counts(em, "ev_market", m_rules))


def publish_checks(spark, sf_dir) -> DataFrame:
    """Every constraint of the eight tables with its violations, on a warehouse
    seeded with bad rows: NULL and long names, repeated keys and labels, keys
    without a dimension row, and a share beyond its declared range."""
    w = Warehouse.load(spark, sf_dir)
    t = dict(w.tables())
    seed = F.col("key_c") % SEED_MOD
    t["country_dim"] = w.country_dim.select(
        "key_c", F.when(seed == 0, F.lit(None)).when(seed == 2, F.repeat("country", F.lit(9))).otherwise(F.col("country")).alias("country"),
        F.when(seed == 1, F.lit("N999")).otherwise(F.col("iso_code")).alias("iso_code"), "continent", "continent_code")
    t["year_dim"] = w.year_dim.select("key_y", F.when(F.col("key_y") == 2, F.col("year") - 1).otherwise(F.col("year")).alias("year"), "half_decade",
                                      F.when(F.col("key_y") == 1, F.lit(None)).otherwise(F.col("pandemic_period")).alias("pandemic_period"))
    t["vehicle_type_dim"] = w.vehicle_type_dim.unionByName(w.vehicle_type_dim.where(F.col("key_v") == 1))
    t["powertrain_dim"] = w.powertrain_dim.where(F.col("key_p") != 3)
    t["ev_market"] = w.ev_market.withColumn("ev_sales_share", F.col("ev_sales_share").cast("double") * F.when(F.col("key_y") == 4, 1e6).otherwise(1))
    t["ev_infrastructure"] = w.ev_infrastructure.unionByName(w.ev_infrastructure.where(seed == 0))
    t["country_energy"] = w.country_energy.withColumn("key_c", F.when(seed == 3, F.col("key_c") + 100).otherwise(F.col("key_c")))
    t["country_macro"] = w.country_macro.withColumn("key_y", F.when(F.col("key_y") == 7, F.lit(None)).otherwise(F.col("key_y")))
    return constraint_violations(t)


def load_rejects(spark, sf_dir) -> DataFrame:
    """Rows that loads of three tables would refuse, with the rule each breaks and the value that came, on tables
    seeded with numbers beyond their types, NULL keys and long codes."""
    w = Warehouse.load(spark, sf_dir)
    seed = F.col("key_c") % SEED_MOD
    market = w.ev_market.withColumn("ev_sales", F.when((seed == 2) & (F.col("key_y") == 3), F.lit(1e25)).otherwise(F.col("ev_sales").cast("double")))
    market = market.withColumn("key_v", F.when((seed == 3) & (F.col("key_y") == 2), F.lit(None)).otherwise(F.col("key_v")))
    energy = w.country_energy.withColumn("net_imports", F.when(F.col("key_y") == 5, F.lit(float("nan"))).otherwise(F.col("net_imports").cast("double")))
    country = w.country_dim.withColumn("iso_code", F.when(seed == 1, F.lit("N999")).otherwise(F.col("iso_code")))
    parts = [rejected_rows("ev_market", market).select(F.lit("ev_market").alias("table_name"), "rule", "key_c", "key_y", F.col("ev_sales").cast("string").alias("came")),
             rejected_rows("country_energy", energy).select(F.lit("country_energy"), "rule", "key_c", "key_y", F.col("net_imports").cast("string")),
             rejected_rows("country_dim", country).select(F.lit("country_dim"), "rule", "key_c", F.lit(None).cast("int"), "iso_code")]
    found = reduce(DataFrame.union, parts)
    came = F.when(F.col("rule") == "key_v_not_null", F.lit(None)).otherwise(F.col("came")).alias("came")
    return found.select("table_name", "rule", _b("key_c"), _b("key_y"), came)


def drill_across_bucketed(spark, sf_dir) -> DataFrame:
    """Question 12 on facts that lie bucketed by the keys they meet on."""
    return drill_across_3(Warehouse.load(spark, sf_dir).colocated(spark))


def profile_table(spark, sf_dir) -> DataFrame:
    c = Cleaning.load(spark, sf_dir)
    parts = [profile(c.market_clean, "ev_market", "iso_code", "year"),
             profile(c.infra_clean, "ev_infrastructure", "iso_code", "year"),
             profile(c.co2_clean, "co2", "iso_code", "year"),
             profile(c.energy_clean, "energy", "iso_code", "year")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def measure_agg(spark, sf_dir) -> DataFrame:
    """Market by continent and year, each measure with its legal aggregate."""
    w = Warehouse.load(spark, sf_dir)
    j = (w.ev_market.join(F.broadcast(w.country_dim.select("key_c", "continent")), "key_c")
                    .join(F.broadcast(w.year_dim.select("key_y", "year")), "key_y"))
    add = S.additivity_of(S.EV_MARKET)
    g = measure_agg_op(j, ["continent", "year"], add)
    # Means of unit measures are exact already; sums are rounded like every double.
    return g.select("continent", _b("year"), *[(F.col(m) if a == S.UNIT else r6(m)).alias(m) for m, a in add.items()])


# -- S10, A17 ---------------------------------------------------------------------
def variant_ratio(spark, sf_dir) -> DataFrame:
    """Mean timing per query and variant, A/B ratio and slowest run."""
    return summarize_timings(Roles(spark, sf_dir).run_timing)


def results_table(spark, sf_dir) -> DataFrame:
    """The timing summary written as a CSV results file and read back."""
    out = summarize_timings(Roles(spark, sf_dir).run_timing)
    path = scratch_path(spark, "results")
    write_csv(out, path)
    return read_csv(spark, path, out.schema)


MODEL = {
    "dim_build": dim_build, "year_dim_build": year_dim_build, "key_resolve": key_resolve, "key_resolve_infra": key_resolve_infra,
    "key_resolve_energy": key_resolve_energy, "key_resolve_macro": key_resolve_macro, "pipeline_rank_stock": pipeline_rank_stock,
    "upsert_market": upsert_market, "publish_checks": publish_checks, "results_table": results_table, "key_skips": key_skips, "coverage_gap": coverage_gap,
    "load_rejects": load_rejects, "drill_across_bucketed": drill_across_bucketed, "load_increment": load_increment, "dim_reload": dim_reload, "upsert_years": upsert_years,
    "upsert_fact": upsert_fact, "insert_absent": insert_absent, "publish_snapshot": publish_snapshot,
    "sink_roundtrip": sink_roundtrip, "scan_csv": scan_csv, "check_unique": check_unique, "check_fk": check_fk,
    "check_domain": check_domain, "profile_table": profile_table, "measure_agg": measure_agg,
    "variant_ratio": variant_ratio,
}
