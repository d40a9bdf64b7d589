"""File loads as one step, and input that loads must not swallow."""

import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F

from spark_elt.operators import incremental as inc
from spark_elt.session import scratch_dir
from spark_elt.sources.files import Compression, list_files, read_delimited
from spark_elt.sources.generator import read_generator
from spark_elt.sources.loads import FileLoad, parallel_read_file, read_selected, select
from spark_elt.sources.selection import ReadMode, select_files, with_file_date

RX = r"(\d{4})/(\d{2})/(\d{2})/"


def write(root, name, text):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def states(spark):
    return (
        inc.StateTable(spark, scratch_dir(spark, "pf"), inc.PROCESSED_FILE, ["node_path", "file_name"]),
        inc.StateTable(spark, scratch_dir(spark, "fd"), inc.FILE_DEPENDENCY, ["node_path", "dependency_type"]),
    )


def ids(spark, target):
    return sorted(r[0] for r in spark.read.parquet(target).select("id").collect())


def test_load_tracks_files_and_code(spark, tmp_dir):
    code = write(tmp_dir, "code/load.sql", "SELECT 1")
    write(tmp_dir, "in/2024/01/01/a.csv", "1\n")
    processed, deps = states(spark)
    load = FileLoad(f"{tmp_dir}/in", "*.csv", "id int", f"{tmp_dir}/out", ["n"], state=processed, dependencies=deps, file_dependencies=[code],
                    mode=ReadMode.ONLY_NEW, date_regex=RX)
    assert parallel_read_file(spark, load) == 1
    assert parallel_read_file(spark, load) == 0
    write(tmp_dir, "in/2024/01/02/a.csv", "2\n")
    assert parallel_read_file(spark, load) == 1 and ids(spark, load.target) == [1, 2]
    write(tmp_dir, "code/load.sql", "SELECT 2")  # changed code: everything again
    assert parallel_read_file(spark, load) == 2 and ids(spark, load.target) == [1, 1, 2, 2]
    # a load that fails leaves neither its files nor the hash
    write(tmp_dir, "code/load.sql", "SELECT 3")
    write(tmp_dir, "in/2024/01/03/a.csv", "x\n")
    with pytest.raises(Exception):  # noqa: B017
        parallel_read_file(spark, load)
    assert inc.processed_files(processed, ["n"]).count() == 2 and deps.read().count() == 0


def test_load_by_day_of_the_file_with_statistics(spark, tmp_dir):
    import uuid

    write(tmp_dir, "in/2024/01/01/a.csv", "1\n2\n")
    write(tmp_dir, "in/2024/01/02/a.csv", "3\n")
    name = f"t_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE TABLE {name} (id INT, day_id INT) USING parquet PARTITIONED BY (day_id) LOCATION '{tmp_dir}/out'")
    try:
        load = FileLoad(f"{tmp_dir}/in", "*.csv", "id int", f"{tmp_dir}/out", ["n"], date_regex=RX, by_day=True, truncate=True, table_name=name)
        parallel_read_file(spark, load)
        write(tmp_dir, "in/2024/01/02/a.csv", "4\n")
        parallel_read_file(spark, load)
        assert sorted(map(tuple, spark.table(name).collect())) == [(1, 20240101), (2, 20240101), (4, 20240102)]
        stats = spark.sql(f"DESCRIBE EXTENDED {name} PARTITION (day_id = 20240101)").where("col_name = 'Partition Statistics'").first()
        assert "2 rows" in stats["data_type"]
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_folder_patterns(spark, tmp_dir):
    for name in ("a/x.csv", "a/b/x.csv", "c/x.csv", "c/y.txt", "x.csv"):
        write(tmp_dir, name, "1\n")

    def found(glob):
        return sorted(r["file_name"] for r in list_files(spark, tmp_dir, glob).collect())

    assert found("a/*.csv") == ["a/x.csv"]
    assert found("*/x.csv") == ["a/x.csv", "c/x.csv"]
    assert found("**/*.csv") == found("*.csv") == ["a/b/x.csv", "a/x.csv", "c/x.csv", "x.csv"]
    assert found("c/*") == ["c/x.csv", "c/y.txt"]
    assert found("nowhere/*.csv") == found("a/*.gz") == []
    assert list_files(spark, f"{tmp_dir}/nothing").count() == 0


def test_other_formats_and_empty_selections(spark, tmp_dir):
    spark.range(3).withColumnRenamed("id", "n").write.json(f"{tmp_dir}/in/2024/01/01")
    load = FileLoad(f"{tmp_dir}/in", "*.json", "n long", f"{tmp_dir}/out", ["n"], date_regex=RX, fmt="json")
    assert parallel_read_file(spark, load) > 0 and spark.read.parquet(load.target).count() == 3
    load.first_date = dt.date(2030, 1, 1)
    assert read_selected(spark, load, select(spark, load)).columns == ["n", "file"]
    assert parallel_read_file(spark, load) == 0
    assert read_delimited(spark, [], "a int", with_file=True).columns == ["a", "file"]


@pytest.mark.parametrize("options", [{}, {"mapper": lambda s: s}, {"make_unique": True}])
def test_malformed_lines_fail(spark, tmp_dir, options):
    good = write(tmp_dir, "good.csv", "1,2024-01-01\n\n2,2024-01-02\n")
    assert read_delimited(spark, good, "a int, d date", **options).count() == 2
    bad = write(tmp_dir, "bad.csv", "1,2024-01-01\nx,2024-01-02\n")
    with pytest.raises(Exception):  # noqa: B017
        read_delimited(spark, bad, "a int, d date", **options).collect()


def test_malformed_lines_of_archives_and_generators_fail(spark, tmp_dir):
    import zipfile

    path = os.path.join(tmp_dir, "a.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("one.csv", "h\n1\n2")
        z.writestr("two.csv", "3\r\n")
    got = read_delimited(spark, path, "a int", compression=Compression.ZIP, header=True)
    assert sorted(r.a for r in got.collect()) == [1, 2, 3]
    with pytest.raises(Exception):  # noqa: B017
        read_delimited(spark, path, "a int", compression=Compression.ZIP).collect()
    with pytest.raises(Exception):  # noqa: B017
        read_generator(spark.range(1), lambda r: ["1", "x"], "a int").collect()


def test_times_of_a_zone_do_not_depend_on_the_session(spark, tmp_dir):
    path = write(tmp_dir, "t.csv", "2024-07-01 12:00:00,2024-07-01 12:00:00\n")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            for options in ({}, {"mapper": lambda s: s}):
                df = read_delimited(spark, path, "t timestamp, n timestamp_ntz", timezone="Europe/Berlin", **options)
                got = df.select(F.unix_seconds("t").alias("t"), "n").first()
                assert got.t == dt.datetime(2024, 7, 1, 10, tzinfo=dt.timezone.utc).timestamp() and got.n == dt.datetime(2024, 7, 1, 10)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_line_breaks_in_quotes(spark, tmp_dir):
    path = write(tmp_dir, "q.csv", '1,"a\nb"\n2,c\n')
    assert sorted(map(tuple, read_delimited(spark, path, "a int, b string", multi_line=True).collect())) == [(1, "a\nb"), (2, "c")]
    with pytest.raises(ValueError):
        read_delimited(spark, path, "a int, b string", multi_line=True, make_unique=True)


def test_header_of_many_files(spark, tmp_dir):
    names = []
    for k in range(5):
        names.append(write(tmp_dir, f"h{k}.csv", "a\n" + "".join(f"{k * 100 + i}\n" for i in range(40))))
    packed = os.path.join(tmp_dir, "p.csv.gz")
    with gzip.open(packed, "wt") as f:
        f.write("a\n7777\n")
    df = read_delimited(spark, [*names, packed], "a int", header=True, mapper=lambda s: s)
    assert df.count() == 201 and df.agg(F.max("a")).first()[0] == 7777


def test_unmatched_name_fails_whatever_is_read(spark, tmp_dir):
    write(tmp_dir, "2024/01/01/a.csv", "1\n")
    write(tmp_dir, "bad.csv", "1\n")
    listing = list_files(spark, tmp_dir, "*.csv")
    for frame in (select_files(listing, date_regex=RX, first_date=None).select("path"), with_file_date(listing, RX).select("path")):
        with pytest.raises(Exception, match="does not match date regex"):
            frame.collect()


def test_run_if_files_changed(spark, tmp_dir):
    code = write(tmp_dir, "f.py", "x = 1")
    _, deps = states(spark)
    calls = []
    for text, want in (("x = 1", True), ("x = 1", False), ("x = 2", True)):
        write(tmp_dir, "f.py", text)
        ran, _ = inc.run_if_files_changed(deps, ["n"], "RunFunction", [code], lambda: calls.append(1), dt.datetime(2024, 1, 1))
        assert ran is want
    assert len(calls) == 2


def test_load_by_day_from_a_folder_with_blanks(spark, tmp_dir):
    root = os.path.join(tmp_dir, "in dir+é")
    write(root, "2024/01/01/a b.csv", "1\n")
    write(root, "2024/01/02/c+d.csv", "2\n")
    processed, _ = states(spark)
    load = FileLoad(root, "*.csv", "id int", f"{tmp_dir}/out dir", ["n"], state=processed, mode=ReadMode.ONLY_NEW, date_regex=RX, by_day=True)
    assert parallel_read_file(spark, load) == 2
    assert sorted((r.id, r.day_id) for r in spark.read.parquet(load.target).collect()) == [(1, 20240101), (2, 20240102)]
    assert parallel_read_file(spark, load) == 0


def test_file_without_a_date_is_named(spark):
    from spark_elt.sources.selection import file_date_of_path

    path = spark.createDataFrame([("file:/data/in%20dir/odd.csv",)], "file string")
    with pytest.raises(Exception, match="odd.csv"):
        path.select(file_date_of_path(F.col("file"), "/data/in dir", RX)).collect()


def test_files_rewritten_while_loading_are_new_again(spark, tmp_dir, monkeypatch):
    """The state records the times that the selection saw, whatever happens after it."""
    from spark_elt.sources import loads

    path = write(tmp_dir, "in/2024/01/01/a.csv", "1\n")
    os.utime(path, (1_700_000_000, 1_700_000_000))
    processed, _ = states(spark)
    load = FileLoad(f"{tmp_dir}/in", "*.csv", "id int", f"{tmp_dir}/out", ["n"], state=processed, mode=ReadMode.ONLY_CHANGED, date_regex=RX)
    read = loads.read_selected

    def meanwhile(*args):
        os.utime(path, (1_700_000_500, 1_700_000_500))
        return read(*args)

    monkeypatch.setattr(loads, "read_selected", meanwhile)
    assert parallel_read_file(spark, load) == 1
    monkeypatch.setattr(loads, "read_selected", read)
    assert parallel_read_file(spark, load) == 1
