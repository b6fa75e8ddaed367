"""Loading semantics of the warehouse on plain Parquet.

* ``merge_upsert``  - insert or replace on a key, last write wins
  (``INSERT ... ON CONFLICT (keys) DO UPDATE``);
* ``insert_absent`` - insert only new keys, first write wins
  (``INSERT ... ON CONFLICT DO NOTHING``);
* ``extend_keys``   - surrogate keys that stay: rows of a dimension keep theirs,
  unseen natural keys get the next numbers;
* ``VersionedStore`` - all-or-nothing loads of a set of tables: every table is
  written to a folder of its own, checks run on what was written, and only then
  one commit file is created, which no second publisher can create again.
  Readers follow the commit files, so a failed or half-written load is never
  visible and the previous version stays current. ``publish`` makes a version of
  new tables; a ``Load`` on top of a version writes what changed (tables, or the
  partitions of a table that it touches) and refers to the old folders for the rest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltcube.operators.joins import first_per_key
from voltcube.session import delete, file_system


def merge_upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
                 order: Column | str | None = None) -> DataFrame:
    """Updates replace target rows with the same key; new keys are added.

    With ``order``, several updates of one key collapse to the last one
    (statements applied in sequence). Both sides are keyed tables, so the
    anti join shuffles on a unique key and cannot skew."""
    keys = list(keys)
    if order is not None:
        cols = [c for c in updates.columns if c not in keys]
        updates = first_per_key(updates, keys, order, cols, last=True)
    kept = target.join(updates.select(*keys), on=keys, how="left_anti")
    return updates.select(*target.columns).unionByName(kept)


def insert_absent(target: DataFrame, new: DataFrame, keys: Sequence[str],
                  order: Column | str | None = None) -> DataFrame:
    """New rows whose key is absent from the target are added; existing keys
    keep their row. With ``order``, the first new row per key is taken."""
    keys = list(keys)
    if order is not None:
        cols = [c for c in new.columns if c not in keys]
        new = first_per_key(new, keys, order, cols)
    added = new.select(*target.columns).join(target.select(*keys), on=keys, how="left_anti")
    return target.unionByName(added)


def extend_keys(known: DataFrame | None, rows: DataFrame, natural: str, key: str) -> DataFrame:
    """``known`` with the rows of unseen natural keys, numbered on from its largest key in the order of
    the natural key. ``rows`` has one row per natural key; NULL is no natural key. A dimension's new labels are
    few, so they are numbered in one window; facts never pass through it."""
    rows = rows.where(F.col(natural).isNotNull())
    if known is None:
        return rows.select(F.row_number().over(Window.orderBy(natural)).cast("int").alias(key), *rows.columns)
    new = rows.join(known.select(natural), natural, "left_anti").select(*rows.columns)
    last = F.coalesce(known.agg(F.max(key).alias("last")).scalar(), F.lit(0))
    number = (F.row_number().over(Window.orderBy(natural)) + last).cast("int").alias(key)
    return known.unionByName(new.select(number, *rows.columns))


#: A line of a commit file: the rows of one table that one folder has. ``parts``: rows of each partition that counts,
#: of the ``written`` ones in the folder (no partitions: null).
COMMIT_SCHEMA = T.StructType([
    T.StructField("version", T.LongType(), False),
    T.StructField("base", T.LongType(), True),
    T.StructField("lines", T.LongType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("folder", T.StringType(), False),
    T.StructField("rows", T.LongType(), False),
    T.StructField("partition_by", T.StringType(), True),
    T.StructField("parts", T.MapType(T.StringType(), T.LongType()), True),
    T.StructField("written", T.LongType(), True),
    T.StructField("schema_json", T.StringType(), False),
])

#: Tables that are written at the same time.
WRITERS = 4


class PublishError(RuntimeError):
    pass


@dataclass
class Staged:
    """A table to write: ``columns`` of ``df`` (all by default), with ``rules`` (name -> violation) counted in the
    same pass, in folders by the values of ``partition_by``."""
    df: DataFrame
    columns: Sequence[Column | str] = ("*",)
    rules: Mapping[str, Column] = field(default_factory=dict)
    partition_by: str | None = None


class Load:
    """Tables written for one new version of a store. With ``base``, tables that are not written stay as in that version."""

    def __init__(self, store: VersionedStore, base: int | None = None):
        self.store, self.base = store, base
        self.folder = uuid.uuid4().hex
        self.path = f"{store.root}/data/{self.folder}"
        log = store._lines()
        self.kept = [x for x in log if x["version"] == base] if base is not None else []
        self.lines: dict[str, dict] = {}
        self.replaced: dict[str, set[str] | None] = {}
        self.staged: dict[str, DataFrame] = {}
        self.violations: dict[str, int] = {}
        self.committing = False

    def write(self, name: str, table: DataFrame | Staged, replaces: Sequence | None = None) -> DataFrame:
        """Write a table and return it read back. ``replaces``: the only partitions of the base's table that it
        replaces (all of it by default)."""
        t = table if isinstance(table, Staged) else Staged(table)
        seen, count = Observation(), F.count(F.lit(1)).alias("rows")
        out = t.df.observe(seen, count, *[F.count_if(F.coalesce(bad, F.lit(False))).alias(f"rule {rule}") for rule, bad in t.rules.items()]).select(*t.columns)
        writer = out.write.partitionBy(t.partition_by) if t.partition_by else out.write
        writer.parquet(f"{self.path}/{name}")
        metrics = seen.get
        self.violations |= {f"{name}.{k.removeprefix('rule ')}": v for k, v in metrics.items() if k != "rows" and v}
        # Read back with the known schema (no footer-reading job).
        back = self.store._scan(name, self.folder, out.schema)
        line = {"table_name": name, "folder": self.folder, "rows": metrics["rows"], "partition_by": t.partition_by, "parts": None, "written": None,
                "schema_json": out.schema.json()}
        if t.partition_by:
            parts = {str(r[0]): r[1] for r in back.groupBy(t.partition_by).count().collect()}
            if "None" in parts:
                self.violations[f"{name}.{t.partition_by}_not_null"] = parts["None"]
            line |= {"parts": parts, "written": len(parts)}
        self.lines[name], self.staged[name] = line, back
        self.replaced[name] = None if replaces is None else {str(x) for x in replaces}
        return back

    def table(self, name: str) -> DataFrame:
        """The table as the new version will have it."""
        return self.store._frame([x for x in self._all_lines() if x["table_name"] == name])

    def _all_lines(self) -> list[dict]:
        out = []
        for x in self.kept:
            name = x["table_name"]
            if name not in self.lines:
                out.append(x)
            elif self.replaced[name] is not None:
                parts = {k: v for k, v in x["parts"].items() if k not in self.replaced[name]}
                if parts:
                    out.append(x | {"parts": parts, "rows": sum(parts.values())})
        return out + [x for x in self.lines.values() if x["rows"] or self.replaced[x["table_name"]] is None]

    def commit(self, checks: Callable[[Mapping[str, DataFrame]], Mapping[str, DataFrame]] | None = None) -> int:
        """Run ``checks`` on the written tables (name -> violations, which must be empty) and make the version."""
        bad = [f"{k} ({v})" for k, v in self.violations.items()]
        asked = checks(self.staged) if checks else {}
        if asked:       # one job for all
            counts = [v.groupBy().agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n") for n, v in asked.items()]
            bad += [f"{r.name} ({r.n})" for r in reduce(DataFrame.unionByName, counts).collect() if r.n]
        if bad:
            raise PublishError(f"not published, failed checks: {sorted(bad)}")
        self.committing = True
        return self.store._commit(self._all_lines(), self.base)

    def __enter__(self) -> Load:
        return self

    def __exit__(self, kind, error, trace) -> None:
        # What a visible commit refers to must stay, even if the call that made it failed afterwards.
        if error is not None and not (self.committing and self.store._refers(self.folder)):
            delete(self.store.spark, self.path)


class VersionedStore:
    """Tables under ``root/data/<load>/<table>``, one commit file per version under ``root/commits``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @property
    def commits_path(self) -> str:
        return f"{self.root}/commits"

    # -- the log ----------------------------------------------------------
    def _lines(self) -> list[dict]:
        """Lines of all whole commit files, one small job; none only where there is no log yet. Any other
        failure to read it is raised: it must not look like an empty store."""
        fs, p = file_system(self.spark, self.commits_path)
        if not fs.exists(p):
            return []
        rows = [r.asDict() for r in self.spark.read.schema(COMMIT_SCHEMA).json(self.commits_path).collect()]
        held: dict[int, int] = {}
        for r in rows:
            held[r["version"]] = held.get(r["version"], 0) + 1
        # A commit file of which not all lines are there yet doesn't count.
        return [r for r in rows if r["version"] is not None and held[r["version"]] == r["lines"]]

    def _numbers(self) -> list[int]:
        """Numbers of all commit files, whole or not."""
        fs, p = file_system(self.spark, self.commits_path)
        names = [str(f.getPath().getName()) for f in fs.listStatus(p)] if fs.exists(p) else []
        return [int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json") and n[1:-5].isdigit()]

    def _refers(self, folder: str) -> bool:
        """Whether a whole commit refers to the folder; taken as true where the log cannot be read."""
        try:
            return any(x["folder"] == folder for x in self._lines())
        except Exception:       # unknown: what it holds must not be deleted
            return True

    def current_version(self) -> int | None:
        return max((x["version"] for x in self._lines()), default=None)

    def _commit(self, lines: Sequence[dict], base: int | None) -> int:
        """Create a commit file after the highest one there is, whole or left behind by a publisher that died.
        Creation is exclusive, so of two publishers that aim at one number the second takes the next; a load on
        top of a version fails if another one was committed meanwhile."""
        version = max(self._numbers(), default=0) + 1
        while True:
            fs, p = file_system(self.spark, f"{self.commits_path}/v{version:08d}.json")
            try:
                out = fs.create(p, False)
                break
            except Exception:
                if not fs.exists(p):
                    raise
                version += 1          # taken meanwhile
        if base is not None and self.current_version() != base:
            out.close()
            raise PublishError(f"version {base} is no longer the current one; load again")
        text = "".join(json.dumps(x | {"version": version, "base": base, "lines": len(lines)}) + "\n" for x in lines)
        try:
            out.write(bytearray(text.encode()))
            out.close()
        except Exception:
            if not any(x["version"] == version for x in self._lines()):
                raise                 # not a whole commit: nothing was published
        later = [x for x in self._lines() if x["version"] > version and x["base"] is not None and x["base"] < version]
        if later:
            raise PublishError(f"version {version} was overtaken by a load on top of an older one; load again")
        return version

    # -- reading ------------------------------------------------------------
    def _scan(self, name: str, folder: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/data/{folder}/{name}").select(*schema.names)

    def _frame(self, lines: Sequence[dict]) -> DataFrame:
        """A table of one or more folders; partitions that no longer count are pruned."""
        found = []
        for x in sorted(lines, key=lambda x: x["folder"]):
            schema = T.StructType.fromJson(json.loads(x["schema_json"]))
            df = self._scan(x["table_name"], x["folder"], schema)
            if x["parts"] is not None and len(x["parts"]) < x["written"]:
                by = x["partition_by"]
                df = df.where(F.col(by).isin(*[F.lit(v).cast(schema[by].dataType) for v in sorted(x["parts"])]))
            found.append(df)
        return reduce(DataFrame.unionByName, found)

    def read(self, name: str, version: int | None = None) -> DataFrame:
        v = self.current_version() if version is None else version
        if v is None:
            raise PublishError(f"no committed version under {self.root}")
        return self.read_all([name], v)[name]

    def read_all(self, names: Sequence[str], version: int) -> dict[str, DataFrame]:
        """Tables of a version with the schemas recorded at publish (one small
        job over the commit log instead of one footer-reading job per table)."""
        lines = [x for x in self._lines() if x["version"] == version]
        return {n: self._frame([x for x in lines if x["table_name"] == n]) for n in names}

    def folders(self, name: str, version: int | None = None) -> dict[str, list[str] | None]:
        """Folders that hold a table of a version, each with its partitions that count."""
        v = self.current_version() if version is None else version
        return {x["folder"]: None if x["parts"] is None else sorted(x["parts"]) for x in self._lines() if x["version"] == v and x["table_name"] == name}

    def manifest(self, version: int | None = None) -> DataFrame:
        v = self.current_version() if version is None else version
        rows: dict[str, int] = {}
        for x in self._lines():
            if x["version"] == v:
                rows[x["table_name"]] = rows.get(x["table_name"], 0) + x["rows"]
        return self.spark.createDataFrame(sorted(rows.items()), "table_name string, rows long")

    # -- loading ------------------------------------------------------------
    def publish(self, tables: Mapping[str, DataFrame | Staged],
                checks: Callable[[Mapping[str, DataFrame]], Mapping[str, DataFrame]] | None = None) -> int:
        """Write all tables to a new folder, some at a time, run ``checks`` on what was written, then commit. Raises
        ``PublishError`` and commits nothing on a violation."""
        with Load(self) as load:
            with ThreadPoolExecutor(WRITERS) as pool:
                for done in [pool.submit(load.write, name, t) for name, t in tables.items()]:
                    done.result()
            return load.commit(checks)
