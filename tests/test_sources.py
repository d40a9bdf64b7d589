"""File loads and selection on small files written by the tests."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from spark_elt.sources.files import Compression, list_files, read_delimited
from spark_elt.sources.selection import ReadMode, select_files

NAMES = ["Elinor Meklit", "Agustín Alvilda", "Ruslan Vančo"]


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_non_ascii_header_and_unique(spark, tmp_dir):
    p = os.path.join(tmp_dir, "names.csv")
    write(p, "id,name\n" + "".join(f"{i},{n}\n" for i, n in enumerate(NAMES, 1)) + "2,Agustín Alvilda\n")
    df = read_delimited(spark, [p], "id int, name string", header=True, make_unique=True)
    assert sorted(tuple(r) for r in df.collect()) == [(1, NAMES[0]), (2, NAMES[1]), (3, NAMES[2])]


def test_tab_round_trip_keeps_blanks(spark, tmp_dir):
    rows = [(1, "Hello", "World!"), (2, "He lo", " orld! "), (3, "Hello\t", ", World! ")]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    out = os.path.join(tmp_dir, "out")
    df.coalesce(1).write.options(sep="\t", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(out)
    back = spark.read.schema("id int, a string, b string").options(
        sep="\t", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(out)
    assert sorted(tuple(r) for r in back.collect()) == rows


def test_mapper_and_null_token(spark, tmp_dir):
    p = os.path.join(tmp_dir, "m.csv")
    write(p, "1|a\n2|NULL\n")
    df = read_delimited(spark, [p], "id int, v string", sep="|", null_value="NULL", mapper=lambda s: s.str.upper())
    assert sorted(tuple(r) for r in df.collect()) == [(1, "A"), (2, None)]


def test_empty_source(spark):
    assert read_delimited(spark, [], "id int").count() == 0


def _listing(spark, root, names):
    for n in names:
        write(os.path.join(root, n), "1\n")
    return list_files(spark, root, "*.csv")


def test_date_regex_and_modes(spark, tmp_dir):
    names = ["2024/01/01/a.csv", "2024/01/02/a.csv", "2024/01/02/b.csv", "1999/12/31/a.csv"]
    listing = _listing(spark, tmp_dir, names)
    rx = r"(\d{4})/(\d{2})/(\d{2})/"
    all_ = select_files(listing, ReadMode.ALL, date_regex=rx)
    assert sorted(r["file_name"] for r in all_.collect()) == sorted(names[:3])  # first date 2000-01-01
    latest = select_files(listing, ReadMode.ONLY_LATEST, date_regex=rx)
    assert [r["file_name"] for r in latest.collect()] == ["2024/01/02/b.csv"]  # tie by name desc
    except_latest = select_files(listing, ReadMode.ONLY_NEW_EXCEPT_LATEST, None, date_regex=rx)
    assert sorted(r["file_name"] for r in except_latest.collect()) == ["2024/01/01/a.csv", "2024/01/02/a.csv"]
    state = all_.where(F.col("file_name") == "2024/01/01/a.csv").select(
        "file_name", F.col("modification_time").alias("last_modified_timestamp"))
    new = select_files(listing, ReadMode.ONLY_NEW, state, date_regex=rx)
    assert sorted(r["file_name"] for r in new.collect()) == ["2024/01/02/a.csv", "2024/01/02/b.csv"]
    older = state.withColumn("last_modified_timestamp", F.col("last_modified_timestamp") - F.expr("INTERVAL 1 DAY"))
    changed = select_files(listing, ReadMode.ONLY_CHANGED, older, date_regex=rx)
    assert sorted(r["file_name"] for r in changed.collect()) == sorted(names[:3])
    reload = select_files(listing, ReadMode.ONLY_NEW, state, date_regex=rx, reload_all=True)
    assert reload.count() == 3


def test_latest_without_regex_uses_file_name(spark, tmp_dir):
    listing = _listing(spark, tmp_dir, ["x_1.csv", "x_3.csv", "x_2.csv"])
    assert [r["file_name"] for r in select_files(listing, ReadMode.ONLY_LATEST).collect()] == ["x_3.csv"]


def test_unmatched_file_name_fails(spark, tmp_dir):
    listing = _listing(spark, tmp_dir, ["2024/01/01/a.csv", "junk/a.csv"])
    with pytest.raises(Exception, match="does not match date regex"):
        select_files(listing, ReadMode.ALL, date_regex=r"(\d{4})/(\d{2})/(\d{2})/").collect()


def test_zip_and_tar(spark, tmp_dir):
    import io
    import tarfile
    import zipfile

    zp = os.path.join(tmp_dir, "a.zip")
    with zipfile.ZipFile(zp, "w") as z:
        z.writestr("p1.csv", "1,a\n2,b\n")
        z.writestr("p2.csv", "3,c\n")
    tp = os.path.join(tmp_dir, "a.tar.gz")
    with tarfile.open(tp, "w:gz") as t:
        data = b"4,d\n"
        info = tarfile.TarInfo("p.csv")
        info.size = len(data)
        t.addfile(info, io.BytesIO(data))
    z = read_delimited(spark, [zp], "id int, v string", compression=Compression.ZIP)
    t = read_delimited(spark, [tp], "id int, v string", compression=Compression.TAR_GZIP)
    assert sorted(r["id"] for r in z.collect()) == [1, 2, 3] and [r["id"] for r in t.collect()] == [4]


def test_timezone_conversion(spark, tmp_dir):
    p = os.path.join(tmp_dir, "tz.csv")
    write(p, "2024-07-01 12:00:00\n")
    df = read_delimited(spark, [p], "t timestamp_ntz", timezone="Europe/Berlin")
    assert df.collect()[0]["t"] == dt.datetime(2024, 7, 1, 10, 0)


def test_sqlite_source(spark, tmp_dir):
    import sqlite3

    from spark_elt.sources.sqlite import read_sqlite

    paths = []
    for i in range(3):
        p = os.path.join(tmp_dir, f"db{i}.sqlite")
        con = sqlite3.connect(p)
        con.execute("CREATE TABLE t (a INTEGER, b TEXT)")
        con.executemany("INSERT INTO t VALUES (?, ?)", [(i, "x"), (i + 10, "y")])
        con.commit()
        con.close()
        paths.append(p)
    df = read_sqlite(spark, paths, "SELECT a, b FROM t WHERE a < 10", "a long, b string")
    assert df.rdd.getNumPartitions() == 3
    assert sorted(r["a"] for r in df.collect()) == [0, 1, 2]


def test_parse_lines_from_csv(spark):
    from spark_elt.sources.files import csv_options, parse_lines

    lines = spark.createDataFrame([("1;'a;b'",), ("2;\\N",)], "value string")
    df = parse_lines(lines, "id int, v string", csv_options(sep=";", quote="'", null_value="\\N"))
    assert sorted(tuple(r) for r in df.collect()) == [(1, "a;b"), (2, None)]


def test_members_of_archives_are_streamed(spark, tmp_dir):
    """A zip of 50 members is read by 50 tasks; neither kind of archive is taken whole (the
    limit of whole contents is far below their sizes). The header is the first line of an
    archive, also where its first member is empty or two members have one name."""
    import io
    import tarfile
    import warnings
    import zipfile

    folder = os.path.join(tmp_dir, "in dir")
    os.makedirs(folder)
    parts = ["", "id,v\n"] + [f"{i},a{i}\r\n{i + 100},b" for i in range(49)]
    with zipfile.ZipFile(f"{folder}/x y.zip", "w", zipfile.ZIP_DEFLATED) as z, warnings.catch_warnings():
        warnings.simplefilter("ignore")
        z.writestr("sub/", "")
        for i, text in enumerate(parts):
            z.writestr("same.csv" if i in (7, 8) else f"p{i}.csv", text)
    with tarfile.open(f"{folder}/x y.tar.gz", "w:gz") as t:
        for i, text in enumerate(parts):
            info = tarfile.TarInfo(f"p{i}.csv")
            info.size = len(text.encode())
            t.addfile(info, io.BytesIO(text.encode()))
    expected = sorted([(i, f"a{i}") for i in range(49)] + [(i + 100, "b") for i in range(49)])
    limit = "spark.sql.sources.binaryFile.maxLength"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "100")
    try:
        for name, kind, tasks in (("x y.zip", Compression.ZIP, 50), ("x y.tar.gz", Compression.TAR_GZIP, 1)):
            df = read_delimited(spark, [f"{folder}/{name}"], "id int, v string", header=True, compression=kind)
            assert sorted(tuple(r) for r in df.collect()) == expected
            used = df.select(F.spark_partition_id().alias("p")).distinct().count()
            assert used == (tasks - 1 if kind == Compression.ZIP else 1)  # the header's member has no row
    finally:
        spark.conf.set(limit, before)


def test_empty_archives(spark, tmp_dir):
    import zipfile

    with zipfile.ZipFile(f"{tmp_dir}/none.zip", "w"):
        pass
    assert read_delimited(spark, [f"{tmp_dir}/none.zip"], "id int", compression=Compression.ZIP).count() == 0
