"""Readers for the input Parquet tables."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from voltcube.session import file_system

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Tables the warehouse is derived from.
WAREHOUSE_INPUTS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


class TableSource:
    """Reads ``{root}/{name}.parquet`` and prunes to the requested columns.

    Selecting columns right at the scan keeps the Parquet ReadSchema narrow;
    filters written later on these frames are pushed into the scan by Catalyst.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def read(self, name: str, *cols: str) -> DataFrame:
        df = self.spark.read.parquet(self.path(name))
        return df.select(*cols) if cols else df


def input_fingerprint(spark: SparkSession, root: str, tables=WAREHOUSE_INPUTS) -> str:
    """Hash of the input's full path and of the path, length and modification
    time of every file of ``tables``: it changes when the data does."""
    h = hashlib.sha256()
    src = TableSource(spark, root)
    for t in tables:
        fs, p = file_system(spark, src.path(t))
        h.update(f"{fs.makeQualified(p)}\n".encode())
        found = []
        if fs.exists(p):
            files = fs.listFiles(p, True)
            while files.hasNext():
                f = files.next()
                found.append((str(f.getPath()), f.getLen(), f.getModificationTime()))
        h.update(repr(sorted(found)).encode())
    return h.hexdigest()
