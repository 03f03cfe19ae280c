"""Lake tables: written by Spark from the given tables, then scanned."""

from datetime import datetime

from pyspark.sql import functions as F

from lendspark.catalog import roles
from lendspark.catalog.cdc import LANDED_FIELDS, LANDED_SQL, landed
from lendspark.catalog.registry import plain_numbers, query
from lendspark.session import scratch_path
from lendspark.sources import lake, listing, text

_written: dict[tuple[str, str], str] = {}


def lake_table(spark, sf) -> str:
    """Root of the landed applications, written once per session and scale factor."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _written:
        path = scratch_path(spark, "applications")
        lake.write_partitioned(landed(spark, sf), path)
        _written[key] = path
    return _written[key]


def scan(spark, sf):
    return lake.scan_all(spark, lake_table(spark, sf))


@query("scan_all_partitions", roles.sql(LANDED_SQL.format(at="c.ts", more=""), "cdc", "found"))
def scan_all_partitions(spark, sf):
    return scan(spark, sf).select(*LANDED_FIELDS)


@query(
    "scan_latest_partition",
    roles.sql(
        LANDED_SQL.format(at="c.ts", more="""AND CAST(c.ts AS DATE) = (
            SELECT max(CAST(ts AS DATE)) FROM cdc WHERE cdc_operation <> 'd')"""),
        "cdc", "found",
    ),
)
def scan_latest_partition(spark, sf):
    return listing.newest(spark, lake_table(spark, sf), landed(spark, sf).schema).select(*LANDED_FIELDS)


@query(
    "scan_date_partition",
    roles.sql(LANDED_SQL.format(at="c.ts", more="AND CAST(c.ts AS DATE) = DATE '2024-01-08'"), "cdc", "found"),
)
def scan_date_partition(spark, sf):
    return lake.scan_date(scan(spark, sf), "2024-01-08").select(*LANDED_FIELDS)


@query(
    "list_partitions",
    roles.sql(
        """SELECT DISTINCT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
                  CAST(day(ts) AS INTEGER) AS day
        FROM cdc WHERE cdc_operation <> 'd' ORDER BY 1 DESC, 2 DESC, 3 DESC""",
        "cdc",
    ),
)
def list_partitions(spark, sf):
    return listing.partitions(spark, lake_table(spark, sf))


@query(
    "scan_files_metadata",
    roles.sql(
        """SELECT 'year=' || year(ts) || '/month=' || month(ts) || '/day=' || day(ts)
                      AS partition_path,
                  count(*) AS rows, true AS has_bytes
        FROM cdc WHERE cdc_operation <> 'd' GROUP BY 1""",
        "cdc",
    ),
)
def scan_files_metadata(spark, sf):
    schema = landed(spark, sf).drop(*lake.DATE_PARTS).schema
    return listing.inventory(spark, lake_table(spark, sf), schema).groupBy("partition_path").agg(
        F.sum("rows").alias("rows"), (F.sum("file_size") > 0).alias("has_bytes")
    )


_DAYS = """SELECT 'year=' || year(ts) || '/month=' || month(ts) || '/day=' || day(ts) AS partition_path, {more}
        FROM cdc WHERE cdc_operation <> 'd' GROUP BY 1"""


@query("lake_write", roles.sql(_DAYS.format(more="count(*) AS rows, true AS within_limit"), "cdc", "found"))
def lake_write(spark, sf):
    """Write the landed applications by day; rows per partition, and whether their files are few."""
    path = scratch_path(spark, "applications")
    lake.write_partitioned(landed(spark, sf), path)
    schema = landed(spark, sf).drop(*lake.DATE_PARTS).schema
    return listing.inventory(spark, path, schema).groupBy("partition_path").agg(
        F.sum("rows").alias("rows"), (F.count(F.lit(1)) <= 8).alias("within_limit")
    )


@query(
    "rejected_files",
    roles.sql(_DAYS.format(more="'not a Parquet file' AS reason, CAST(0 AS BIGINT) AS rows_read"), "cdc"),
)
def rejected_files(spark, sf):
    """A lake with a damaged file in every day's folder: texts of the day's events under a data file's name."""
    path, texts = scratch_path(spark, "applications"), scratch_path(spark, "texts")
    lake.write_partitioned(landed(spark, sf), path)
    events = landed(spark, sf).select(F.col("kafka_offset").cast("string").alias("value"), *lake.DATE_PARTS)
    events.repartition(*lake.DATE_PARTS).write.partitionBy(*lake.DATE_PARTS).text(texts)
    listing.move_files(spark, texts, path, "*.txt", ".parquet")
    schema = landed(spark, sf).drop(*lake.DATE_PARTS).schema
    part = F.regexp_extract("file_path", r"/(year=\d+/month=\d+/day=\d+)/", 1)
    return listing.rejected(spark, path, schema).select(part.alias("partition_path"), "reason", "rows_read")


@query(
    "snapshot_roundtrip",
    roles.sql(
        """SELECT reco_id_curr, reco_bureau_id, credit_status, days_credit, credit_day_overdue,
                  CAST(credit_sum AS DOUBLE) AS credit_sum, credit_type FROM bki""",
        "bki",
    ),
)
def snapshot_roundtrip(spark, sf):
    target = lake.write_snapshot(
        roles.bki(spark, sf), scratch_path(spark, "training-data"),
        datetime(2025, 10, 28, 9, 30), compression="gzip",
    )
    return plain_numbers(spark.read.parquet(target)).select(
        "reco_id_curr", "reco_bureau_id", "credit_status", "days_credit", "credit_day_overdue",
        "credit_sum", "credit_type",
    )


@query(
    "snapshot_name",
    "SELECT event_id, 'data_' || strftime(ts, '%Y%m%d_%H%M%S') || '.parquet' AS name FROM events",
)
def snapshot_name(spark, sf):
    return roles.table(spark, sf, "events").select(
        "event_id", lake.snapshot_name(F.col("ts")).alias("name")
    )


@query("csv_roundtrip", roles.sql("SELECT * FROM applications", "applications"))
def csv_roundtrip(spark, sf):
    frame = roles.applications(spark, sf)
    path = scratch_path(spark, "csv")
    text.write_csv(frame, path)
    return text.read_csv(spark, path, frame.schema)


def _text_roundtrip(spark, sf, name, columns):
    frame = roles.table(spark, sf, name).select(*columns)
    path = scratch_path(spark, "csv")
    text.write_csv(frame, path)
    return text.read_csv(spark, path, frame.schema)


@query("csv_roundtrip_documents", "SELECT doc_id, text, lang FROM documents")
def csv_roundtrip_documents(spark, sf):
    """Texts with line breaks, quotes and outer blanks."""
    return _text_roundtrip(spark, sf, "documents", ("doc_id", "text", "lang"))


@query("csv_roundtrip_pages", "SELECT page_id, html FROM pages")
def csv_roundtrip_pages(spark, sf):
    """Markup full of quotes."""
    return _text_roundtrip(spark, sf, "pages", ("page_id", "html"))


@query(
    "union_by_name",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance
       FROM customer
       UNION ALL
       SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
)
def union_by_name(spark, sf):
    customers = roles.table(spark, sf, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_mktsegment AS segment"
    )
    suppliers = roles.table(spark, sf, "supplier").selectExpr(
        "s_acctbal AS balance", "s_name AS name", "s_suppkey AS id"
    )
    return lake.union_frames(customers, suppliers)
