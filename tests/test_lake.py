from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lendspark import session
from lendspark.functions.columns import keep_first_names, select_existing
from lendspark.sources import lake, relational, text

DAYS = ["2025-09-28", "2025-10-08", "2025-10-28", "2024-12-31"]


@pytest.fixture
def table(spark, tmp_path):
    rows = [(i, d) for i, d in enumerate(DAYS)] + [(9, "2025-10-28")]
    df = spark.createDataFrame(rows, "id INT, d STRING").withColumn("d", F.to_date("d"))
    path = str(tmp_path / "applications")
    lake.write_partitioned(lake.with_date_parts(df, "d"), path)
    return path


def test_partitions_compare_as_numbers(spark, table):
    df = lake.scan_all(spark, table)
    listed = [tuple(r) for r in lake.list_partitions(df).collect()]
    assert listed == [(2025, 10, 28), (2025, 10, 8), (2025, 9, 28), (2024, 12, 31)]
    assert lake.latest_date(df) == date(2025, 10, 28)
    assert sorted(r.id for r in lake.scan_latest(df).collect()) == [2, 9]


def test_padded_date_finds_its_partition(spark, table):
    df = lake.scan_date(lake.scan_all(spark, table), "2025-10-08")
    assert [r.id for r in df.collect()] == [1]
    assert "isnotnull(year" in df._jdf.queryExecution().toString()
    assert len(df.inputFiles()) >= 1


def test_append_keeps_earlier_rows(spark, table):
    more = spark.createDataFrame([(7,)], "id INT").withColumn("d", F.lit("2025-10-08").cast("date"))
    lake.write_partitioned(lake.with_date_parts(more, "d"), table)
    assert lake.scan_all(spark, table).count() == 6


def test_files_differ_in_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "x")], "id INT, a STRING").write.parquet(path)
    spark.createDataFrame([(2, 5)], "id INT, b INT").write.mode("append").parquet(path)
    merged = lake.scan_all(spark, path)
    assert set(merged.columns) == {"id", "a", "b"}
    assert sorted((r.id, r.a, r.b) for r in merged.collect()) == [(1, "x", None), (2, None, 5)]
    fixed = lake.scan_all(spark, path, schema="id INT, b INT, c DOUBLE")
    assert sorted(map(tuple, fixed.collect())) == [(1, None, None), (2, 5, None)]


def test_corrupt_and_other_files(spark, table, tmp_path):
    folder = tmp_path / "applications" / "year=2025" / "month=10" / "day=8"
    (folder / "note.txt").write_text("not data")
    assert lake.scan_all(spark, table).count() == 5
    (folder / "bad.parquet").write_bytes(b"PAR1 broken")
    schema = "id INT, d DATE, year INT, month INT, day INT"
    assert lake.scan_all(spark, table, schema, skip_corrupt=True).count() == 5
    with pytest.raises(Exception):
        lake.scan_all(spark, table, schema).count()


def test_nothing_readable_is_an_error(spark, tmp_path):
    (tmp_path / "bad.parquet").write_bytes(b"junk")
    with pytest.raises(ValueError):
        lake.scan_all(spark, str(tmp_path), "id INT", skip_corrupt=True)
    empty = spark.createDataFrame([], "year INT, month INT, day INT")
    with pytest.raises(ValueError):
        lake.latest_date(empty)


def test_file_inventory(spark, table):
    rows = lake.file_inventory(lake.scan_all(spark, table)).collect()
    assert sum(r.rows for r in rows) == 5
    assert {r.partition_path for r in rows} >= {"year=2025/month=10/day=8", "year=2024/month=12/day=31"}
    assert all(r.file_size > 0 and r.file_path.endswith(".parquet") for r in rows)


@pytest.mark.parametrize("compression", ["snappy", "gzip", "none"])
def test_snapshot(spark, tmp_path, compression):
    target = lake.write_snapshot(spark.range(10), str(tmp_path / "new"), datetime(2025, 1, 2, 3, 4, 5), compression)
    assert target.endswith("/new/data_20250102_030405.parquet")
    assert spark.read.parquet(target).count() == 10


def test_rebalance_splits_and_gathers(spark, tmp_path):
    df = spark.range(100).repartition(8).withColumn("year", F.lit(2025)).withColumn("month", F.lit(1)).withColumn("day", F.lit(1))
    lake.write_partitioned(df, str(tmp_path / "t"))
    assert len(spark.read.parquet(str(tmp_path / "t")).inputFiles()) == 1


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b", None), (2, None, 2.5)], "id INT, name STRING, x DOUBLE")
    text.write_csv(df, str(tmp_path / "c"))
    assert sorted(text.read_csv(spark, str(tmp_path / "c"), df.schema).collect()) == sorted(df.collect())
    assert text.read_csv(spark, str(tmp_path / "c")).schema["x"].dataType.simpleString() == "double"


def test_union_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, 2)], "a INT, b INT")
    b = spark.createDataFrame([(2, 1)], "b INT, a INT")
    c = spark.createDataFrame([(3,)], "c INT")
    assert [tuple(r) for r in lake.union_frames(a, b, c).collect()] == [(1, 2, None), (1, 2, None), (None, None, 3)]


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a INT, b INT, c INT")
    assert select_existing(df, ["c", "zz", "a", "c"]).columns == ["c", "a"]
    doubled = df.select("a", "b", F.col("c").alias("a"))
    assert [tuple(r) for r in keep_first_names(doubled).collect()] == [(1, 2)]


def test_optional_source(spark, tmp_path):
    assert relational.optional_source(lambda: spark.range(3), "numbers").count() == 3
    assert relational.optional_source(lambda: spark.read.parquet(str(tmp_path / "no")), "files") is None
    missing = relational.JdbcSource("jdbc:postgresql://db.invalid/x", {"user": "u"})
    assert relational.optional_source(lambda: missing.query(spark, "select 1"), "database") is None
    # A fault of the plan is no absence.
    with pytest.raises(AnalysisException):
        relational.optional_source(lambda: spark.range(3).select("no_such_column"), "plan")


def test_run_sql_binds_values(spark):
    got = relational.run_sql(spark, "SELECT id FROM {t} WHERE id > :low", {"low": 7}, t=spark.range(10))
    assert sorted(r.id for r in got.collect()) == [8, 9]


def test_shared_dir_follows_the_session(spark):
    def session_of(master, conf):
        return SimpleNamespace(
            conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="app-1")
        )

    named = session_of("yarn", {"spark.checkpoint.dir": "/shared/work/"})
    assert session.scratch_path(named, "x").startswith("/shared/work/app-1/x-")
    unset = session_of("yarn", {"spark.sql.warehouse.dir": "/shared/warehouse"})
    assert session.shared_dir(unset) == "/shared/warehouse/_scratch"
    assert session.shared_dir(spark) == session.shared_dir(spark)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(session_of("yarn", {"spark.sql.warehouse.dir": "file:/home/app/spark-warehouse"}))


def test_csv_keeps_quotes_breaks_blanks_and_nulls(spark, tmp_path):
    from lendspark.sources.text import read_csv, write_csv

    rows = [(1, "  padded "), (2, 'a "q", b'), (3, "x\ny\r\nz"), (4, ""), (5, None), (6, '"'), (7, "a\\"), (8, 'back\\"slash')]
    frame = spark.createDataFrame(rows, "id long, value string")
    write_csv(frame, str(tmp_path / "t.csv"))
    assert sorted(map(tuple, read_csv(spark, str(tmp_path / "t.csv"), frame.schema).collect())) == [(i, v or None) for i, v in rows]
