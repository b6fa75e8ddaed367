"""The star schema the questions run on: four facts and four dimensions."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltcube import schema as S
from voltcube.operators.checks import constraint_counts, key_counts, typed_rules
from voltcube.params import ROLE, RoleParams
from voltcube.plans.roles import Roles
from voltcube.plans.stored import at_once, store_for
from voltcube.session import scratch_path
from voltcube.sources.store import Load, Staged, VersionedStore, extend_keys


def surrogate_dim(labels: DataFrame, label: str, key: str, known: DataFrame | None = None) -> DataFrame:
    """Dimension with a surrogate key over a closed label set (vehicle types, powertrains); labels of ``known``
    keep their keys. Facts never see the numbering, they join to the finished dimension."""
    return extend_keys(known, labels.select(label).distinct(), label, key)


def constraint_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, rule, violations) of all constraints of the eight tables."""
    return constraint_counts(tables, (S.TABLES, S.TEXT_LENGTHS))


def key_checks(load: Load):
    """Checks of a load for what its writing cannot see: keys and references of the tables it wrote, as violated
    constraints. Rows of a fact that stay have met them before (its key holds the year it is stored by)."""
    def checks(staged: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        if not staged:
            return {}
        every = {n: staged[n] if n in staged else load.table(n) for n in S.TABLES if n in staged or not S.TABLES[n][3]}
        found = key_counts(every, S.TABLES, [n for n in S.TABLES if n in staged]).where(F.col("violations") > 0)
        return {"keys and references": found}
    return checks


#: Facts are stored by the year they belong to.
YEAR_KEY = "key_y"


def declared(name: str, df: DataFrame) -> Staged:
    """A table to write with the columns, order and types of its declared schema; values that break a column's rule,
    also by not fitting its type, are counted while it is written."""
    schema, _, _, fks = S.TABLES[name]
    raw = {c: f"_raw_{c}" for c in schema.names}
    by = YEAR_KEY if fks else None
    both = df.select(*[F.col(c).alias(r) for c, r in raw.items()], *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])
    # A year's rows go together; a large year is split at run time.
    both = both.hint("rebalance", by) if by else both
    return Staged(both, schema.names, typed_rules(schema, S.TEXT_LENGTHS, raw), by)


def rejected_rows(name: str, df: DataFrame) -> DataFrame:
    """The rows of ``df`` that a load into the table would not accept, one row for each column rule that they break:
    the rule, then the values as they came."""
    t = declared(name, df)
    broken = F.array_compact(F.array(*[F.when(bad, F.lit(rule)) for rule, bad in t.rules.items()]))
    return t.df.select(F.explode(broken).alias("rule"), *[F.col(f"_raw_{c}").alias(c) for c in S.TABLES[name][0].names])


def write_tables(load: Load, tables: Mapping[str, DataFrame]) -> None:
    at_once([partial(load.write, n, declared(n, tables[n])) for n in S.TABLES])


@dataclass
class Warehouse:
    country_dim: DataFrame
    year_dim: DataFrame
    vehicle_type_dim: DataFrame
    powertrain_dim: DataFrame
    ev_market: DataFrame            # key_c, key_y, key_v, key_p + measures
    ev_infrastructure: DataFrame
    country_energy: DataFrame
    country_macro: DataFrame
    params: RoleParams = ROLE

    TABLES = tuple(S.TABLES)

    @property
    def gdp_cutoffs(self) -> tuple[float, float]:
        return self.params.gdp_high, self.params.gdp_medium

    @classmethod
    def from_roles(cls, roles: Roles) -> "Warehouse":
        em = roles.ev_market        # materialised once by Roles: it feeds three tables
        vt = surrogate_dim(em, "vehicle_type", "key_v")
        pt = surrogate_dim(em, "powertrain", "key_p")
        # The planner broadcasts a label dimension below its size threshold.
        fact = em.join(vt, "vehicle_type").join(pt, "powertrain")
        return cls(country_dim=roles.country_dim, year_dim=roles.year_dim, vehicle_type_dim=vt, powertrain_dim=pt, ev_market=fact,
                   ev_infrastructure=roles.ev_infrastructure, country_energy=roles.country_energy, country_macro=roles.country_macro, params=roles.p)

    def tables(self) -> dict[str, DataFrame]:
        return {t: getattr(self, t) for t in self.TABLES}

    @classmethod
    def load(cls, spark: SparkSession, sf_dir: str, roles: Roles | None = None) -> "Warehouse":
        """The stored warehouse for ``sf_dir``: built, checked and published once per
        input version (ETL), then read by every query, as a star schema in a
        database is. Its tables are bounded by their grain (nations x years x
        labels) at any input size."""
        roles = roles or Roles(spark, sf_dir)
        store = store_for(roles, "warehouse")
        version = store.current_version()
        if version is None:
            version = cls.publish(store, roles)
        return cls(**store.read_all(cls.TABLES, version), params=roles.p)

    @classmethod
    def publish(cls, store: VersionedStore, roles: Roles) -> int:
        """Build, check and publish a new version."""
        roles.prepare()
        with Load(store) as load:
            write_tables(load, cls.from_roles(roles).tables())
            return load.commit(key_checks(load))

    #: Columns that facts meet on in a drill-across.
    DRILL_KEYS = ("key_c", "key_y")

    def colocated(self, spark: SparkSession, buckets: int | None = None) -> "Warehouse":
        """The same warehouse with its facts written again, bucketed and sorted by the keys they meet on, so that joins
        between facts and sums by these keys need no shuffle at any size. Worth it where facts are
        too large to broadcast and are joined more often than loaded; as many buckets as shuffle partitions by default."""
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        held = {}
        for name, (_, _, _, fks) in S.TABLES.items():
            if fks:
                path = scratch_path(spark, f"bucketed-{name}")
                table = path.rsplit("/", 1)[1].replace("-", "_")
                # One file per bucket: rows are dealt by the buckets' own hash before they are written.
                (getattr(self, name).repartition(buckets, *self.DRILL_KEYS).write.format("parquet").option("path", path)
                 .bucketBy(buckets, *self.DRILL_KEYS).sortBy(*self.DRILL_KEYS).saveAsTable(table))
                held[name] = spark.table(table)
            else:
                held[name] = getattr(self, name)
        return Warehouse(**held, params=self.params)

    @contextmanager
    def cached(self) -> Iterator["Warehouse"]:
        """The same warehouse held in executor memory while the block runs."""
        held = {t: df.persist() for t, df in self.tables().items()}
        try:
            yield Warehouse(**held, params=self.params)
        finally:
            for df in held.values():
                df.unpersist()
