import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lendspark.catalog import stream as stream_queries
from lendspark.operators import cdc, enrich
from lendspark.sources import listing
from lendspark.sources.lake import scan_all
from lendspark.sources.schemas import BROKER_RECORD_SCHEMA
from lendspark.sources.streams import BrokerSource, read_files
from lendspark.streaming import ingest, progress



def at(text="2025-10-08 10:00:00"):
    return F.lit(text).cast("timestamp")


def write_records(spark, folder, events, first_offset):
    when = datetime(2025, 10, 8)
    rows = []
    for i, (op, app) in enumerate(events):
        value = json.dumps({"after": {"reco_id_curr": app, "income": "5"}, "op": op, "ts_ms": i})
        rows.append((None, value.encode(), "t", 0, first_offset + i, when))
    spark.createDataFrame(rows, BROKER_RECORD_SCHEMA).coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def world(spark, tmp_path):
    bki = spark.createDataFrame([(1, 10, 5.0), (2, 20, 6.0)], "reco_id_curr INT, reco_bureau_id INT, credit_sum DOUBLE")
    balance = spark.createDataFrame([(10, 0, "C"), (10, -1, "C")], "reco_bureau_id INT, months_balance INT, stat_for_bureau STRING")
    folder = str(tmp_path / "topic")
    write_records(spark, folder, [("c", 1), ("u", 1)], 0)
    write_records(spark, folder, [("d", 1)], 10)
    write_records(spark, folder, [("r", 2), ("c", None)], 20)
    return folder, bki, balance, ingest.LakeTables.under(str(tmp_path / "lake"))


def drain(spark, world, reports=None):
    folder, bki, balance, tables = world
    query = ingest.start_ingest(
        read_files(spark, folder, max_files_per_trigger=1), bki, balance, tables,
        trigger={"availableNow": True}, at=at(), on_batch=reports.append if reports is not None else None,
    )
    query.awaitTermination()
    return query


def test_ingest_restart_and_progress(spark, world):
    folder, _, _, tables = world
    reports = []
    drain(spark, world, reports)
    # The batch that held only a delete landed nothing.
    assert sorted((r.applications, r.credits, r.ratio) for r in reports) == [(2, 0, 0.0), (2, 4, 2.0)]
    apps = scan_all(spark, tables.applications)
    assert len(apps.columns) == 144 + 2  # the two batch keys come from the folders
    got = {r.kafka_offset: (r.bureau_api_status, r.data_quality_score, r.day) for r in apps.collect()}
    assert got == {0: ("success", 100, 8), 1: ("success", 100, 8), 20: ("not_found", 80, 8), 21: ("null_id", 0, 8)}
    assert scan_all(spark, tables.bureau_credits).count() == 4
    assert sum(r.input_rows for r in progress.progress_rows(spark, tables.progress).collect()) == 5

    write_records(spark, folder, [("c", 1)], 30)
    drain(spark, world, reports)
    assert scan_all(spark, tables.applications).count() == 5
    rows = progress.progress_rows(spark, tables.progress).orderBy("batch_id").collect()
    assert [(r.batch_id, r.input_rows, r.applications, r.credits) for r in rows] == [
        (0, 2, 2, 4), (1, 1, 0, 0), (2, 2, 2, 0), (3, 1, 1, 2),
    ]
    assert len({r.query_id for r in rows}) == 1
    summary = ingest.batch_summary(scan_all(spark, tables.applications), scan_all(spark, tables.bureau_credits))
    assert sorted((r.applications, r.credits, r.credits_per_application) for r in summary.collect()) == [
        (1, 2, 2.0), (2, 0, 0.0), (2, 4, 2.0),
    ]
    assert summary.select("query_id").distinct().count() == 1
    shown = ingest.preview(scan_all(spark, tables.applications), ingest.APPLICATION_PREVIEW)
    assert shown.count() == 5 and "bureau_count" in shown.columns


def test_replay_of_a_batch_replaces_it(spark, world):
    folder, bki, balance, tables = world
    batch = cdc.keep_row_events(cdc.parse_events(spark.read.parquet(folder)))
    for when in ("2025-10-08 23:59:00", "2025-10-09 00:10:00"):
        landed = ingest.land_batch(batch, "query_id=q/batch_id=3", bki, balance, tables, at(when))
        assert landed == (4, 4)
    apps = scan_all(spark, tables.applications)
    assert apps.count() == 4
    assert {(r.batch_id, r.day) for r in apps.collect()} == {(3, 9)}
    assert scan_all(spark, tables.bureau_credits).count() == 4


def test_enrich_works_on_a_stream(spark, world):
    folder, bki, balance, _ = world
    stream = cdc.keep_row_events(cdc.parse_events(read_files(spark, folder)))
    enriched = enrich.enrich(stream, bki, balance, F.lit(1)).select("kafka_offset", "bureau_count")
    query = enriched.writeStream.format("memory").queryName("enriched").trigger(availableNow=True).start()
    query.awaitTermination()
    assert {tuple(r) for r in spark.table("enriched").collect()} == {(0, 2), (1, 2), (20, 0), (21, 0)}


def test_watch_reports_until_the_query_ends(spark, world):
    folder, bki, balance, tables = world
    query = ingest.start_ingest(read_files(spark, folder), bki, balance, tables, trigger={"availableNow": True})
    seen = []
    progress.watch(query, seen.append, every_seconds=0.2)
    assert not query.isActive and len(seen) <= 1
    # Without a given processing time both tables carry the start of the batch.
    times = [scan_all(spark, t).select("processing_timestamp").distinct().collect() for t in (tables.applications, tables.bureau_credits)]
    assert len(times[0]) == 1 and times[0] == times[1]


def test_stop(spark, world):
    folder, bki, balance, tables = world
    query = ingest.start_ingest(read_files(spark, folder), bki, balance, tables, trigger={"processingTime": "1 hour"}, at=at())
    assert query.isActive
    query.stop()
    assert not query.isActive


def test_broker_options():
    options = BrokerSource("a:1,b:2", "topic").options()
    assert options["subscribe"] == "topic" and options["maxOffsetsPerTrigger"] == "50"
    assert options["startingOffsets"] == "latest" and options["failOnDataLoss"] == "true"


@pytest.fixture
def uncoalesced(spark):
    """So few rows would be put together again."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_batch_from_one_row_group_is_spread(spark, tmp_path, world, monkeypatch, uncoalesced):
    _, bki, balance, tables = world
    folder = str(tmp_path / "one")
    write_records(spark, folder, [("c", 1 + i % 2) for i in range(400)], 0)
    seen = []

    def land(batch, *rest):
        seen.extend(batch.groupBy(F.spark_partition_id()).count().collect())
        return landed(batch, *rest)

    landed = ingest.land_batch
    monkeypatch.setattr(ingest, "land_batch", land)
    drain(spark, (folder, bki, balance, tables))
    assert sum(r["count"] for r in seen) == 400 and max(r["count"] for r in seen) < 200
    assert scan_all(spark, tables.applications).count() == 400
    assert scan_all(spark, tables.bureau_credits).count() == 400
    assert spark.conf.get("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning") == "false"


def test_dealt_batches_are_whole_and_of_several_files(spark, tmp_path, monkeypatch, uncoalesced):
    root = str(tmp_path)
    spark.range(200).selectExpr(
        "IF(id = 7, NULL, id) AS event_id", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts", "id % 5 AS user_id",
        "'view' AS event_type", "CAST(id AS DOUBLE) AS value", "'' AS props",
    ).coalesce(1).write.parquet(f"{root}/events.parquet")
    spark.range(1).selectExpr(
        "id AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus", "1D AS o_totalprice",
        "TIMESTAMP_NTZ'2001-01-01 00:00:00' AS o_orderdate", "'1-URGENT' AS o_orderpriority",
    ).write.parquet(f"{root}/orders.parquet")
    spark.range(1).selectExpr("id AS l_orderkey", "1 AS l_linenumber", "'O' AS l_linestatus").write.parquet(
        f"{root}/lineitem.parquet"
    )
    paths = []
    run = stream_queries.run_ingest
    monkeypatch.setattr(stream_queries, "run_ingest", lambda s, sf, path, tables: paths.append(path) or run(s, sf, path, tables))
    tables = stream_queries.run_batches(spark, root)
    rows = progress.progress_rows(spark, tables.progress).collect()
    # The event without an id is a batch of its own.
    assert sorted(r.input_rows for r in rows) == [1, 49, 50, 50, 50] and len({r.query_id for r in rows}) == 1
    files = listing.files(spark, paths[0]).groupBy(F.regexp_extract("file_path", "file=([^/]*)/", 1)).count().collect()
    assert len(files) == 5 and sorted(r["count"] for r in files)[1] > 1


def test_credits_of_a_batch_are_landed_by_their_number(spark, tmp_path, world, monkeypatch):
    _, _, _, tables = world
    monkeypatch.setattr(ingest, "CREDIT_TASK_ROWS", 100, raising=False)
    bki = spark.range(0, 20, 1, 1).selectExpr("1 AS reco_id_curr", "id AS reco_bureau_id", "5D AS credit_sum")
    balance = spark.range(0, 20, 1, 1).selectExpr("id AS reco_bureau_id", "0 AS months_balance", "'C' AS stat_for_bureau")
    folder = str(tmp_path / "many")
    write_records(spark, folder, [("c", 1 + i % 2) for i in range(200)] + [("c", None)], 0)
    drain(spark, (folder, bki, balance, tables))
    credits = scan_all(spark, tables.bureau_credits)
    # A hundred rows of an application of twenty credits, few bytes before they are repeated.
    assert {(r.reco_bureau_id, r["count"]) for r in credits.groupBy("reco_bureau_id").count().collect()} == {
        (i, 100) for i in range(20)
    }
    assert max(r["count"] for r in credits.groupBy(F.input_file_name()).count().collect()) < 1000
    assert scan_all(spark, tables.applications).where("bureau_count = 20").count() == 100
    assert scan_all(spark, tables.applications).count() == 201


def test_the_whole_table_as_one_batch_needs_no_layout(spark, tmp_path, monkeypatch):
    bureau = []
    monkeypatch.setattr(stream_queries, "read_files", lambda *args, **more: None)
    monkeypatch.setattr(stream_queries.roles, "broker_records", lambda source: None)
    monkeypatch.setattr(stream_queries.roles, "table", lambda s, sf, name: s.range(0))
    monkeypatch.setattr(stream_queries.roles, "bki", lambda s, sf: "bki")
    monkeypatch.setattr(stream_queries.roles, "balance", lambda s, sf: "balance")
    monkeypatch.setattr(stream_queries, "keyed_bureau", lambda s, sf: ("laid out", "laid out"))

    class Done:
        def awaitTermination(self):
            pass

    monkeypatch.setattr(ingest, "start_ingest", lambda records, *tables, **more: bureau.append(tables[:2]) or Done())
    monkeypatch.setattr(stream_queries, "_runs", {})
    stream_queries.run_ingest(spark, str(tmp_path))
    stream_queries.run_ingest(spark, str(tmp_path), str(tmp_path / "growing"))
    assert bureau == [("bki", "balance"), ("laid out", "laid out")]


def test_row_images_are_parsed_of_landed_events_only(spark, world, monkeypatch):
    _, _, _, tables = world
    seen = []
    parse = ingest.parse_events
    monkeypatch.setattr(ingest, "parse_events", lambda records: seen.extend(records.select("offset").collect()) or parse(records))
    drain(spark, world)
    assert sorted(r.offset for r in seen) == [0, 1, 20, 21]
    assert scan_all(spark, tables.deletes).select("kafka_offset").collect() == [(10,)]
    assert scan_all(spark, tables.applications).count() == 4


def test_a_landed_folder_is_that_of_its_day_alone(spark, tmp_path):
    path = str(tmp_path / "batch")
    rows = spark.range(3).select(F.lit(1).alias("day"), F.lit(2).alias("month"), F.lit(3).alias("year"), "id")
    ingest._write_at(rows, path, at("2025-10-08 23:59:00"))
    ingest._write_at(rows, path, at("2025-10-09 00:10:00"))
    landed = scan_all(spark, path)
    assert sorted(tuple(r) for r in landed.collect()) == [(i, 2025, 10, 9) for i in range(3)]
    assert listing.names_in(spark, path) == ["year=2025"]
