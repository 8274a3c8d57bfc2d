"""History compaction: name-aligned CSV union, distinct rows, distinct values."""

import os

import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from stationflow.operators.history import combine_history, dedupe, distinct_values
from stationflow.session import local_fs_path
from stationflow.sources.history import read_csv_parts

SCHEMA = StructType([StructField("a", StringType()), StructField("b", IntegerType()),
                     StructField("c", StringType())])


def _write(base, name, text):
    folder = local_fs_path(base)
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write(text)


def test_parts_with_other_header_order_align_by_name(spark, tmp_shared):
    _write(tmp_shared, "p1.csv", "a,b,c\nx,1,u\ny,2,v\n")
    _write(tmp_shared, "p2.csv", "c,a,b\nw,z,3\nu,x,1\n")
    rows = sorted(tuple(r) for r in read_csv_parts(spark, tmp_shared, SCHEMA).collect())
    assert rows == [("x", 1, "u"), ("x", 1, "u"), ("y", 2, "v"), ("z", 3, "w")]
    assert sorted(tuple(r) for r in combine_history(spark, tmp_shared, SCHEMA).collect()) == [
        ("x", 1, "u"), ("y", 2, "v"), ("z", 3, "w")]


def test_duplicate_rows_with_nulls_are_kept_once(spark, tmp_shared):
    _write(tmp_shared, "p1.csv", "a,b,c\nx,,\nx,,\n,5,\n")
    got = [tuple(r) for r in combine_history(spark, tmp_shared, SCHEMA).collect()]
    assert len(got) == 2 and set(got) == {(None, 5, None), ("x", None, None)}


def test_dedupe_is_idempotent(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "x int, y string")
    once = dedupe(df)
    assert sorted(map(tuple, dedupe(once).collect()), key=str) == \
        sorted(map(tuple, once.collect()), key=str)


def test_no_parts_is_an_error(spark, tmp_shared):
    os.makedirs(local_fs_path(tmp_shared), exist_ok=True)
    with pytest.raises(Exception):
        read_csv_parts(spark, tmp_shared, SCHEMA)


def test_part_with_foreign_header_is_quarantined(spark, tmp_shared):
    _write(tmp_shared, "p1.csv", "a,b,c\nx,1,u\n")
    _write(tmp_shared, "p2.csv", "q,r\n1,2\n")
    good, bad = read_csv_parts(spark, tmp_shared, SCHEMA, with_quarantine=True)
    assert [tuple(r) for r in good.collect()] == [("x", 1, "u")]
    assert bad.count() == 2


def test_distinct_values_keeps_null(spark):
    df = spark.createDataFrame([(1.0,), (None,), (1.0,), (0.5,)], "r double")
    got = [tuple(r) for r in distinct_values(df, "r").collect()]
    assert len(got) == 3 and set(got) == {(0.5,), (1.0,), (None,)}


def test_many_parts_beyond_broadcast_limit_use_salted_join(spark, tmp_shared):
    _write(tmp_shared, "p1.csv", "a,b,c\nx,1,u\n")
    _write(tmp_shared, "p2.csv", "c,b,a\nv,2,y\n")
    _write(tmp_shared, "p3.csv", "q,r\n1,2\n")
    spark.conf.set("stationflow.broadcast.maxRows", "0")
    try:
        good, bad = read_csv_parts(spark, tmp_shared, SCHEMA, with_quarantine=True)
        rows = sorted(tuple(r) for r in good.collect())
        n_bad = bad.count()
    finally:
        spark.conf.unset("stationflow.broadcast.maxRows")
    assert rows == [("x", 1, "u"), ("y", 2, "v")] and n_bad == 2


def test_missing_extra_and_quoted_columns_keep_their_rows(spark, tmp_shared):
    _write(tmp_shared, "p1.csv", "a,b,c\nx,1,u\n")
    _write(tmp_shared, "p2.csv", "a,c\ny,v\n")
    _write(tmp_shared, "p3.csv", "a,more,b,c\nz,q,3,w\n")
    _write(tmp_shared, "p4.csv", '"c","b","a"\n"k,l",4,"t"\n')
    _write(tmp_shared, "p5.csv", "\n\n")
    good, bad = read_csv_parts(spark, tmp_shared, SCHEMA, with_quarantine=True)
    rows = sorted(tuple(r) for r in good.collect())
    assert rows == [("t", 4, "k,l"), ("x", 1, "u"), ("y", None, "v"), ("z", 3, "w")]
    unread = bad.collect()
    assert [r._line for r in unread] == [None] and unread[0]._file.endswith("p5.csv")


def test_corrupt_part_is_listed(spark, tmp_shared):
    _write(tmp_shared, "p1.csv", "a,b,c\nx,1,u\n")
    _write(tmp_shared, "p2.csv.gz", "this is no gzip file")
    combine_history(spark, tmp_shared, SCHEMA, quarantine_path=f"{tmp_shared}_bad")
    listed = spark.read.json(f"{tmp_shared}_bad").collect()
    assert len(listed) == 1 and listed[0]._file.endswith("p2.csv.gz")


def _add_up(spark, base, n_lines):
    good, bad = read_csv_parts(spark, base, SCHEMA, with_quarantine=True)
    rows, listed = [tuple(r) for r in good.collect()], bad.collect()
    assert len(rows) + sum(r._line is not None for r in listed) == n_lines
    return rows, listed


def test_rows_that_do_not_fit_are_listed(spark, tmp_shared):
    _write(tmp_shared, "p1.csv", 'a,b,c\nx,1,u\ny,zz,v\n"q\nr",3,w\nk,5\nm,6,n,o\na,b,c\n')
    rows, listed = _add_up(spark, tmp_shared, 6)
    assert sorted(rows) == [("q\nr", 3, "w"), ("x", 1, "u")]
    assert sorted(r._line for r in listed) == ["a,b,c", "k,5", "m,6,n,o", "y,zz,v"]
    only_a = read_csv_parts(spark, tmp_shared, SCHEMA).select("a").collect()
    assert sorted(r.a for r in only_a) == ["q\nr", "x"]


def test_part_that_breaks_off_is_listed(spark, tmp_shared):
    import gzip
    import random
    draw = random.Random(1)
    whole = gzip.compress("".join(["a,b,c\n"] + [f"x{draw.random()},{i},u\n" for i in range(50_000)]).encode())
    folder = local_fs_path(tmp_shared)
    os.makedirs(folder)
    for name, data in (("cut.csv.gz", whole[:len(whole) // 2]), ("whole.csv.gz", whole), ("two.csv.gz", whole + gzip.compress(b"y,1,v\n"))):
        with open(os.path.join(folder, name), "wb") as fh:
            fh.write(data)
    good, bad = read_csv_parts(spark, tmp_shared, SCHEMA, with_quarantine=True)
    listed = bad.collect()
    assert good.count() == 100_001
    with pytest.raises(OSError):
        read_csv_parts(spark, tmp_shared, SCHEMA, skip_unreadable=False)
    assert [(os.path.basename(r._file), r._reason) for r in listed if r._line is None] == [("cut.csv.gz", "breaks off")]
