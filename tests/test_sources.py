"""Guarded CSV scans, pivots over found labels, and key presence."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.test_plans import plan_of
from voltcube.operators.joins import absent, presence
from voltcube.operators.reshape import LabelError, discover_labels, label_columns, pivot_found
from voltcube.plans.cleaning import Cleaning
from voltcube.plans.model_queries import coverage_gap
from voltcube.sources.files import HeaderError, read_csv, scan_csv, write_csv

SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("year", T.IntegerType()), T.StructField("value", T.DoubleType()),
                       T.StructField("share", T.DecimalType(5, 2))])


def put(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.csv").write_bytes(text.encode())
    return str(folder)


def got(scan):
    return sorted(map(tuple, scan.rows.collect()), key=str), sorted(r.record for r in scan.rejects.collect())


def test_bad_records_are_counted_and_kept_as_they_stand(spark, tmp_path):
    path = put(tmp_path / "a", one="name,year,value,share\na,2001,1.5,0.25\nb,y2,1,1\nc,2003,,\n,2004,2e3,1.2\nd,2005\ne,2006,1,2,3\nf,2007,x,0\ng,2008,1,99999\nNA,2009,0,0\n")
    scan = scan_csv(spark, path, SCHEMA, "bad")
    rows, rejects = got(scan)
    assert [r[0] for r in rows] == ["NA", "a", "c", None] and rows[1][1:3] == (2001, 1.5) and rows[2][2] is None and rows[3][2] == 2000.0
    assert rejects == ["b,y2,1,1", "d,2005", "e,2006,1,2,3", "f,2007,x,0", "g,2008,1,99999"]
    assert scan.rejects.select("file").distinct().count() == 1 and scan.rows.columns == SCHEMA.names


def test_columns_are_found_by_their_header(spark, tmp_path):
    path = put(tmp_path / "b", one="extra,value,share,year,name\nq,1,2,2000,n\n", two="extra,value,share,year,name\n,,,2001,m\n")
    assert got(scan_csv(spark, path, SCHEMA, "order"))[0] == [("m", 2001, None, None), ("n", 2000, 1.0, pytest.approx(2))]
    with pytest.raises(HeaderError, match="share"):
        scan_csv(spark, put(tmp_path / "c", one="name,year,value\nn,2000,1\n"), SCHEMA, "missing")
    with pytest.raises(HeaderError, match="different headers"):
        scan_csv(spark, put(tmp_path / "d", one="name,year,value,share\nn,2000,1,1\n", two="name,value,year,share\nn,1,2000,1\n"), SCHEMA, "differs")


def test_quoted_fields_of_several_lines(spark, tmp_path):
    path = put(tmp_path / "e", one='name,year,value,share\n"two\nlines, ""quoted""",2000,1,1\n" blanks ",2001,1,1\n"open,2002,1,1\n')
    rows, rejects = got(scan_csv(spark, path, SCHEMA, "lines", multi_line=True))
    assert [r[0] for r in rows] == [" blanks ", 'two\nlines, "quoted"'] and len(rejects) == 1
    df = spark.createDataFrame([('a "b", c\nd\te ', 1, None, None), (" x", 2, 0.5, None), ("\\", 3, 1.0, None), (None, 4, None, None)], SCHEMA)
    write_csv(df, f"{tmp_path}/f")
    back = scan_csv(spark, f"{tmp_path}/f", SCHEMA, "back", multi_line=True)
    assert sorted(map(tuple, back.rows.collect()), key=str) == sorted(map(tuple, df.collect()), key=str) and back.rejects.count() == 0
    plain = df.where(~F.coalesce(F.col("name").contains("\n"), F.lit(False)))
    write_csv(plain, f"{tmp_path}/g")
    assert sorted(map(tuple, read_csv(spark, f"{tmp_path}/g", SCHEMA).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_a_file_with_a_header_alone(spark, tmp_path):
    assert got(scan_csv(spark, put(tmp_path / "h", one="name,year,value,share\n"), SCHEMA, "empty")) == ([], [])


# -- labels --------------------------------------------------------------------------------
def long(spark, labels):
    return spark.createDataFrame([("k", label, float(i), i) for i, label in enumerate(labels)] + [("m", labels[0], None, 9), (None, labels[0], 1.0, 9), ("k", None, 5.0, 9)],
                                 "k string, p string, v double, seq int")


def test_pivot_takes_the_labels_there_are(spark):
    out = pivot_found(long(spark, [" New Label ", "b", "b"]), ["k"], "p", "v", "seq")
    assert out.columns == ["k", "new_label", "b"] and [tuple(r) for r in out.collect()] == [("k", 0.0, 1.0)]
    assert pivot_found(long(spark, ["a"]).limit(0), ["k"], "p", "v", "seq").columns == ["k"]


def test_labels_that_cannot_be_columns_raise(spark):
    for labels in (["A b", "a B"], ["K"], ["  "]):
        with pytest.raises(LabelError):
            pivot_found(long(spark, labels), ["k"], "p", "v", "seq")
    assert label_columns(["EV sales", "x"], ["k"]) == ["ev_sales", "x"]


def test_the_number_of_labels_is_bounded(spark):
    df = long(spark, [f"l{i}" for i in range(12)])
    assert len(discover_labels(df, "p", most=12)) == 12
    with pytest.raises(LabelError, match="more than 11"):
        discover_labels(df, "p", most=11)


# -- presence -----------------------------------------------------------------------------
def test_presence_and_set_differences(spark):
    t = lambda *keys: spark.createDataFrame([(a, b, 0) for a, b in keys], "a string, b int, other int")
    tables = {"x": t(("p", 1), ("p", 1), ("q", 2), (None, 3)), "y": t(("p", 1), ("z", 9)), "w": t((None, 3), ("q", 2))}
    assert {tuple(r) for r in presence(list(tables.values()), ["a", "b"]).collect()} == {("p", 1, 3), ("q", 2, 5), (None, 3, 5), ("z", 9, 2)}
    assert {tuple(r) for r in absent(tables, ["a", "b"], "x", "missing").collect()} == {("y", "q", 2), ("y", None, 3), ("w", "p", 1)}
    assert absent({"x": tables["x"].limit(0), "y": tables["y"]}, ["a", "b"], "x", "missing").count() == 0


def test_coverage_shuffles_once(spark):
    Cleaning.load(spark, "/root/testdata/sf0.001")
    assert plan_of(coverage_gap(spark, "/root/testdata/sf0.001")).count("Exchange hashpartitioning") == 1
