"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

import voltcube

from voltcube.session import scratch_path
from voltcube.sources.tables import TableSource


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    root = Path(next(iter(voltcube.__path__)))
    if not root.is_dir():          # imported from an archive that was shipped already
        return
    to = Path(tempfile.mkdtemp(prefix="voltcube-ship-")) / "voltcube-package.zip"
    with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(to))


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return TableSource(spark, sf_dir).read(name, *cols)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Working column names that do not clash (case-insensitively) with the frame's own."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def cut(spark: SparkSession, df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` under the shared folder; returns the frame read back and its path."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a written table through Hadoop's file system (any store Spark can reach)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def with_fields(df: DataFrame, **fields: T.DataType) -> T.StructType:
    return T.StructType(df.schema.fields + [T.StructField(k, t) for k, t in fields.items()])


def add_columns(batch: pa.RecordBatch, **arrays: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*batch.columns, *arrays.values()], names=[*batch.schema.names, *arrays])


def give_back() -> None:
    """At the end of a task: memory that Arrow and the C library keep for later goes back, as the worker may lie
    idle next to others."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def small_batches(batches: Iterable[pa.RecordBatch], text: str, most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches that hold at most ``most`` bytes of ``text`` (or one row)."""
    for b in batches:
        col = b.column(b.schema.get_field_index(text))
        start, held = 0, 0
        for i, n in enumerate(pa.compute.binary_length(col).to_pylist()):
            if held and held + (n or 0) > most:
                yield b.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        if start < b.num_rows:
            yield b.slice(start)
    give_back()
