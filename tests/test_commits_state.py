"""Committed batches, compaction, kept state, keyed tables and listings."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lendspark.operators import cdc
from lendspark.sources import keyed, lake, listing
from lendspark.sources.schemas import BROKER_RECORD_SCHEMA  # noqa: F401
from lendspark.streaming import commits, ingest, state
from tests.oracle import plan_text
from tests.test_lake import table  # noqa: F401
from tests.test_stream import at, drain, world, write_records  # noqa: F401


def offsets(df):
    return sorted(r.kafka_offset for r in df.collect())


def test_only_finished_batches_are_seen(spark, world):  # noqa: F811
    folder, bki, balance, tables = world
    assert commits.committed(spark, tables).count() == 0
    assert commits.scan_committed(spark, tables, "applications", "kafka_offset BIGINT").count() == 0
    drain(spark, world)
    events = cdc.parse_events(spark.read.parquet(folder))
    rows = cdc.keep_row_events(events)
    # One batch landed both tables but not its commit, another only its credits.
    ingest.land_batch(rows, "query_id=x/batch_id=7", bki, balance, tables, at())
    ingest._write(spark.read.parquet(f"{tables.bureau_credits}/query_id=x/batch_id=7"), f"{tables.bureau_credits}/query_id=x/batch_id=8")
    assert lake.scan_all(spark, tables.applications).count() == 8
    assert offsets(commits.scan_committed(spark, tables, "applications")) == [0, 1, 20, 21]
    assert commits.scan_committed(spark, tables, "bureau_credits").count() == 4
    assert offsets(commits.scan_committed(spark, tables, "deletes")) == [10]

    before = {n: Counter(commits.scan_committed(spark, tables, n).drop("year").collect()) for n in ("applications", "deletes")}
    assert commits.compact(spark, tables) == 1
    assert commits.compact(spark, tables) is None
    assert commits.open_batches(spark, tables).count() == 0
    for name, want in before.items():
        assert Counter(commits.scan_committed(spark, tables, name).drop("year").collect()) == want
    # A run is laid out by day, and a day's rows are found there.
    assert listing.date_folders(spark, f"{tables.compacted}/applications/run=1")[0][0] == (2025, 10, 8)

    write_records(spark, folder, [("c", 1), ("d", 2)], 30)
    drain(spark, world)
    assert offsets(commits.scan_committed(spark, tables, "applications")) == [0, 1, 20, 21, 30]
    assert commits.compact(spark, tables) == 2
    assert offsets(commits.scan_committed(spark, tables, "applications")) == [0, 1, 20, 21, 30]
    assert offsets(commits.scan_committed(spark, tables, "deletes")) == [10, 31]


def test_a_days_rows_are_compacted_by_several_tasks(spark, world):  # noqa: F811
    folder, _, _, tables = world
    write_records(spark, folder, [("r", 1 + i % 3) for i in range(60)], 100)
    drain(spark, world)
    before = {n: Counter(commits.scan_committed(spark, tables, n).drop("year").collect()) for n in commits.TABLES}
    assert commits.compact(spark, tables, task_rows=10) == 1
    for name, want in before.items():
        assert Counter(commits.scan_committed(spark, tables, name).drop("year").collect()) == want
    assert listing.files(spark, f"{tables.compacted}/applications/run=1").count() >= 5
    assert listing.files(spark, f"{tables.compacted}/deletes/run=1").count() == 1


def test_unfinished_compaction_is_replaced(spark, world):  # noqa: F811
    _, _, _, tables = world
    drain(spark, world)
    # Rows of a run without its line of the manifest: a failure between the two.
    spark.range(3).withColumn("year", F.lit(1)).write.partitionBy("year").parquet(f"{tables.compacted}/applications/run=1")
    assert offsets(commits.scan_committed(spark, tables, "applications")) == [0, 1, 20, 21]
    assert commits.compact(spark, tables) == 1
    assert offsets(commits.scan_committed(spark, tables, "applications")) == [0, 1, 20, 21]


def test_state_follows_the_events(spark, world):  # noqa: F811
    folder, _, _, tables = world
    drain(spark, world)
    fields = ["reco_id_curr", "kafka_offset", "income"]

    def same():
        events = cdc.parse_events(spark.read.parquet(folder))
        want = Counter(cdc.current_state(events).select(fields).collect())
        assert Counter(state.current(spark, tables.state).select(fields).collect()) == want

    with pytest.raises(ValueError):
        state.current(spark, tables.state)
    assert state.refresh(spark, tables, 4) == 1
    same()
    assert state.refresh(spark, tables, 4) == 1
    # Application 1 was deleted and is created anew, 2 is deleted; ts_ms restarts with the file.
    write_records(spark, folder, [("r", 5), ("r", 6), ("r", 7), ("r", 8), ("c", 1), ("d", 2), ("c", None)], 40)
    drain(spark, world)
    assert state.refresh(spark, tables) == 2
    same()
    write_records(spark, folder, [("d", i) for i in range(10, 18)] + [("d", 1)], 60)
    drain(spark, world)
    assert state.refresh(spark, tables) == 3
    same()


def _events(spark, rows):
    fields = "reco_id_curr INT, income STRING, cdc_operation STRING, cdc_timestamp_ms BIGINT, kafka_key STRING, kafka_topic STRING, kafka_partition INT, kafka_offset BIGINT"
    return spark.createDataFrame([(*r, "t", 0, i) for r, i in rows], fields)


def test_state_of_random_merges(spark, tmp_path):
    """Batches in any order give what all events at once give, and a merge rewrites only its buckets."""
    rng = random.Random(4)
    rows = []
    for i in range(300):
        key = rng.choice([None, *range(12)])
        op = rng.choice("ccud")
        text = None if key is None else f'{{"reco_id_curr":{key}}}'
        rows.append(((None if op == "d" or key is None else key, str(i), op, rng.randrange(60), text), i))
    want = Counter(cdc.current_state(_events(spark, rows)).collect())
    assert want
    path = str(tmp_path / "state")
    rng.shuffle(rows)
    for v, start in enumerate(range(0, 300, 75), 1):
        batch = [type("B", (), {"query_id": "q", "batch_id": v})]
        assert state.merge(spark, path, _events(spark, rows[start : start + 75]), batch, 5) == v
    assert Counter(state.current(spark, path).collect()) == want
    last = ((3, "last", "u", 10**6, '{"reco_id_curr":3}'), 10**6)
    state.merge(spark, path, _events(spark, [last]), [type("B", (), {"query_id": "q", "batch_id": 9})], 5)
    assert listing.names_in(spark, f"{path}/data/version=5") != listing.names_in(spark, f"{path}/data/version=4")
    assert len(listing.names_in(spark, f"{path}/data/version=5")) == 1
    assert {r.income for r in state.current(spark, path).where("reco_id_curr = 3").collect()} == {"last"}


@pytest.mark.parametrize("pushed", [0, 1000])
def test_keyed_table(spark, tmp_path, pushed):
    rows = [(i % 50, i) for i in range(400)] + [(None, -1)] + [(7, i) for i in range(300)]
    df = spark.createDataFrame(rows, "k INT, v INT")
    written = keyed.write_keyed(df, str(tmp_path / "t"), "k", 8)
    assert keyed.KeyedTable.at(spark, str(tmp_path / "t")) == written
    assert Counter(written.read(spark).collect()) == Counter(df.collect())
    asked = spark.createDataFrame([(7,), (7,), (8,), (None,), (999,)], "id BIGINT")
    got = written.of_keys(asked, "id", pushed)
    assert Counter(map(tuple, got.collect())) == Counter(r for r in rows if r[0] in (7, 8))
    plan = plan_text(got)
    assert "PartitionFilters: [" in plan and "key_bucket" in plan
    assert len(spark.read.parquet(*got.inputFiles()).inputFiles()) <= 8
    if pushed:
        assert "In(k, [" in plan
    assert written.of_keys(asked.limit(0), "id").count() == 0


def test_small_batch_reads_few_buckets(spark, world, tmp_path):  # noqa: F811
    folder, bki, balance, tables = world
    more = spark.range(100, 400).selectExpr("cast(id as int) reco_id_curr", "cast(id * 10 as int) reco_bureau_id", "1.0D credit_sum")
    known = keyed.write_keyed(bki.unionByName(more), str(tmp_path / "bki"), "reco_id_curr", 16)
    months = keyed.write_keyed(balance, str(tmp_path / "months"), "reco_bureau_id", 16)
    batch = cdc.keep_row_events(cdc.parse_events(spark.read.parquet(folder)))
    some, of_them = ingest.of_batch(batch, known, months)
    for frame, key in ((some, "reco_id_curr"), (of_them, "reco_bureau_id")):
        plan = plan_text(frame)
        assert "key_bucket" in plan.split("PartitionFilters:")[1].splitlines()[0] and f"In({key}, [" in plan
    assert ingest.land_batch(batch, "query_id=q/batch_id=0", known, months, tables, at()) == (4, 4)
    assert ingest.land_batch(batch, "query_id=q/batch_id=1", bki, balance, tables, at()) == (4, 4)
    landed = lake.scan_all(spark, tables.applications).drop("batch_id", "query_id")
    assert all(n == 2 for n in Counter(landed.collect()).values())


def test_listing_opens_no_file(spark, table):  # noqa: F811
    listed = listing.partitions(spark, table)
    assert [tuple(r) for r in listed.collect()] == [(2025, 10, 28), (2025, 10, 8), (2025, 9, 28), (2024, 12, 31)]
    assert "Scan parquet" not in plan_text(listed) and "FileScan" not in plan_text(listed)
    assert sorted(r.id for r in listing.newest(spark, table).collect()) == [2, 9]
    with pytest.raises(ValueError):
        listing.newest(spark, f"{table}/year=2024/month=12/day=31")


def test_inventory_and_rejected_files(spark, table, tmp_path):  # noqa: F811
    schema = "id INT, d DATE"
    day = tmp_path / "applications" / "year=2025" / "month=10" / "day=8"
    empty = spark.createDataFrame([], schema)
    empty.coalesce(1).write.parquet(str(tmp_path / "empty"))
    (source,) = (tmp_path / "empty").glob("part-*.parquet")
    (day / "no rows +1.parquet").write_bytes(source.read_bytes())
    rows = listing.inventory(spark, table, schema).collect()
    assert sum(r.rows for r in rows) == 5
    assert [r.rows for r in rows if "no rows +1" in r.file_path] == [0]
    assert all(r.file_size > 0 for r in rows)
    assert listing.rejected(spark, table, schema).collect() == []

    (day / "junk.parquet").write_bytes(b"x" * 500)
    (day / "short.parquet").write_bytes(b"PAR1")
    good = next(day.glob("part-*.parquet")).read_bytes()
    (day / "cut.parquet").write_bytes(good[: len(good) - 6])
    # The footer is whole, a data page is not.
    spoiled = bytearray(good)
    spoiled[4:40] = b"\xff" * 36
    (day / "pages.parquet").write_bytes(bytes(spoiled))
    found = {r.file_path.rpartition("/")[2]: r for r in listing.rejected(spark, table, schema).collect()}
    assert set(found) == {"junk.parquet", "short.parquet", "cut.parquet", "pages.parquet"}
    assert found["junk.parquet"].reason == "not a Parquet file"
    assert found["pages.parquet"].reason.startswith("unreadable after row") and found["pages.parquet"].rows_read == 0
    assert all(r.partition_path == "year=2025/month=10/day=8" for r in listing.inventory(spark, table, schema).collect() if "junk" in r.file_path)
