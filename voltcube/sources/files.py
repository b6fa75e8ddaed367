"""CSV and Parquet scans and sinks with explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltcube.session import materialize

#: Quotes within a quoted field are doubled, as spreadsheets and data portals write them; blanks are data.
CSV_FORMAT = {"header": True, "nullValue": "", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

#: Columns of a staged scan: the text of a record that could not be read, and its file.
CORRUPT, FILE = "_corrupt_record", "_file"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, keep_empty: bool = False) -> DataFrame:
    """CSV with a header row and an explicit schema (no inference pass).

    A literal ``NA`` (Namibia's code, North America's continent code) always
    stays a value: only an empty field is missing. With ``keep_empty`` a
    missing text field reads as an empty string instead of NULL (no text is
    treated as missing at all)."""
    df = spark.read.schema(schema).options(**CSV_FORMAT).option("mode", "FAILFAST").csv(path)
    if keep_empty:
        df = df.select(*[F.coalesce(F.col(f.name), F.lit("")).alias(f.name)
                         if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in schema.fields])
    return df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; NULL is written as an empty field, an empty string as ``""``."""
    df.write.mode(mode).options(**CSV_FORMAT).csv(path)


class HeaderError(ValueError):
    pass


@dataclass
class CsvScan:
    """``rows`` in the declared schema, and the records that do not fit it (file, record)."""
    rows: DataFrame
    rejects: DataFrame


def scan_csv(spark: SparkSession, path: str, schema: T.StructType, name: str, multi_line: bool = False) -> CsvScan:
    """Raw CSV files with a header, guarded.

    Columns are found by their header, in any order; others than the declared ones are left
    out, a missing one raises ``HeaderError``, and so does a file whose header differs from the
    first one's. A record with a value that its column's type cannot hold, or with too few or too many fields,
    goes to ``rejects`` as it stands instead of ending the load or becoming NULL. Files are
    parsed once, into a staged table that both parts read. ``multi_line`` lets quoted fields hold line
    breaks; such a file is read by one task, so large ones should come in several files."""
    options = CSV_FORMAT | {"multiLine": multi_line}
    header = spark.read.options(**options).csv(path).columns          # reads one record
    missing = [c for c in schema.names if c not in header]
    if missing:
        raise HeaderError(f"{path}: no column {missing}, found {header}")
    read = T.StructType([schema[c] if c in schema.names else T.StructField(c, T.StringType()) for c in header] + [T.StructField(CORRUPT, T.StringType())])
    raw = spark.read.schema(read).options(**options).options(enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT).csv(path)
    try:
        staged = materialize(spark, raw.select(*schema.names, CORRUPT, F.input_file_name().alias(FILE)), f"scan-{name}")
    except Exception as e:
        if "CSV header does not conform" in str(e):
            raise HeaderError(f"{path}: files with different headers, the first one has {header}") from e
        raise
    bad = F.col(CORRUPT).isNotNull()
    return CsvScan(staged.where(~bad).select(*schema.names), staged.where(bad).select(F.col(FILE).alias("file"), F.col(CORRUPT).alias("record")))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
                  max_records_per_file: int | None = None) -> None:
    """Parquet sink; ``max_records_per_file`` bounds file size the way a
    batched insert bounds statement size."""
    w = df.write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)
