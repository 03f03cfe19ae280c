"""The ingest stream over the events table."""

from pyspark.sql import functions as F

from lendspark.catalog import roles
from lendspark.catalog.cdc import LANDED_FIELDS, LANDED_SQL
from lendspark.catalog.registry import plain_numbers, query
from lendspark.catalog.training import CURRENT_SQL
from lendspark.operators import cdc
from lendspark.operators.enrich import bureau_credits
from lendspark.plans import training
from lendspark.session import scratch_path
from lendspark.sources import listing
from lendspark.sources.keyed import KeyedTable, write_keyed
from lendspark.sources.lake import scan_all
from lendspark.sources.streams import read_files
from lendspark.streaming import commits, ingest, progress, state

# Time of run, a parameter so that results repeat.
PROCESSED_AT = "2024-02-01 06:00:00"

# Buckets of the bureau tables and of the state.
BUCKETS = 16

_runs: dict[tuple[str, str], tuple] = {}
_bureau: dict[tuple[str, str], tuple[KeyedTable, KeyedTable]] = {}


def keyed_bureau(spark, sf) -> tuple[KeyedTable, KeyedTable]:
    """Both bureau tables laid out by their key, once per session and scale factor."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _bureau:
        _bureau[key] = (
            write_keyed(roles.bki(spark, sf), scratch_path(spark, "bki"), "reco_id_curr", BUCKETS),
            write_keyed(roles.balance(spark, sf), scratch_path(spark, "balance"), "reco_bureau_id", BUCKETS),
        )
    return _bureau[key]


def run_ingest(spark, sf, path=None, tables=None):
    """Drain the events table through the ingest; the tables and the finished query.

    ``path`` names a growing copy of the table, of which a batch takes what is new. Its
    batches read the bureau laid out by key; the whole table is a single batch, which would
    read no less of a layout than of the bureau's tables.
    """
    schema = roles.table(spark, sf, "events").schema
    # A pattern, as the file stream takes a single file only by pattern.
    source = read_files(spark, path or f"{sf}/events.parquet*", schema, max_files_per_trigger=MOST_FILES if path else 50)
    records = roles.broker_records(source)
    bureau = keyed_bureau(spark, sf) if path else (roles.bki(spark, sf), roles.balance(spark, sf))
    tables = tables or ingest.LakeTables.under(scratch_path(spark, "ingest"))
    stream = ingest.start_ingest(
        records, *bureau, tables,
        trigger={"availableNow": True}, at=F.lit(PROCESSED_AT).cast("timestamp"),
    )
    stream.awaitTermination()
    if path is None:
        _runs[(spark.sparkContext.applicationId, sf)] = (tables, stream)
    return tables, stream


def last_run(spark, sf):
    return _runs.get((spark.sparkContext.applicationId, sf)) or run_ingest(spark, sf)


@query("stream_cdc_ingest", roles.sql(LANDED_SQL.format(at=f"TIMESTAMP '{PROCESSED_AT}'", more=""), "cdc", "found"))
def stream_cdc_ingest(spark, sf):
    tables, _ = run_ingest(spark, sf)
    return scan_all(spark, tables.applications).select(*LANDED_FIELDS)


@query(
    "stream_bureau_credits",
    roles.sql(
        """SELECT 2024 AS year, 2 AS month, 1 AS day, c.reco_id_curr, c.reco_bureau_id,
                  count(*) AS rows, CAST(sum(c.credit_sum) AS DOUBLE) AS credit_sum
        FROM cdc e JOIN credits c ON e.user_id = c.reco_id_curr
        WHERE e.cdc_operation <> 'd' GROUP BY ALL""",
        "cdc", "credits",
    ),
)
def stream_bureau_credits(spark, sf):
    tables, _ = last_run(spark, sf)
    landed = scan_all(spark, tables.bureau_credits)
    return plain_numbers(
        landed.groupBy("year", "month", "day", "reco_id_curr", "reco_bureau_id").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("credit_sum").alias("credit_sum")
        )
    )


@query(
    "batch_preview",
    roles.sql(
        """SELECT user_id AS reco_id_curr, CAST(target AS SMALLINT) AS target, income,
                  CAST(COALESCE(f.n, 0) AS INTEGER) AS bureau_count,
                  CASE WHEN f.n > 0 THEN 'success' ELSE 'not_found' END AS bureau_api_status,
                  0 AS bureau_api_response_time_ms
        FROM cdc LEFT JOIN found f ON user_id = f.reco_id_curr WHERE cdc_operation <> 'd'
        ORDER BY kafka_offset LIMIT 5""",
        "cdc", "found",
    ),
)
def batch_preview(spark, sf):
    tables, _ = last_run(spark, sf)
    landed = scan_all(spark, tables.applications).orderBy("kafka_offset")
    return ingest.preview(landed, ingest.APPLICATION_PREVIEW)


@query("stream_progress", "SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS input_rows FROM events")
def stream_progress(spark, sf):
    tables, _ = last_run(spark, sf)
    return progress.progress_rows(spark, tables.progress).select("batch_id", "input_rows")


@query(
    "bureau_layout",
    roles.sql(
        """SELECT reco_id_curr, count(*) AS credits FROM bki
           WHERE reco_id_curr IN (SELECT user_id FROM cdc WHERE kafka_offset % 50 = 7 OR cdc_operation = 'c')
           GROUP BY 1""",
        "bki", "cdc",
    ),
)
def bureau_layout(spark, sf):
    """The bureau's credits laid out by applicant, and those of a batch's applicants read back."""
    laid_out = write_keyed(roles.bki(spark, sf), scratch_path(spark, "bki"), "reco_id_curr", BUCKETS)
    events = roles.table(spark, sf, "events")
    batch = events.where((F.col("event_id") % 50 == 7) | (F.col("event_type") == "signup"))
    found = laid_out.of_keys(batch, "user_id")
    return found.groupBy("reco_id_curr").agg(F.count(F.lit(1)).alias("credits"))


BATCHES = 4
# More files than a batch has.
MOST_FILES = 1_000_000


_several: dict[tuple[str, str], ingest.LakeTables] = {}


def run_batches(spark, sf) -> ingest.LakeTables:
    """All events, dealt into several folders that arrive one after the other, each a batch."""
    events = roles.table(spark, sf, "events")
    dealt, path = scratch_path(spark, "dealt"), scratch_path(spark, "events")
    parts = events.withColumn("file", F.col("event_id") % BATCHES).repartition("event_id")
    parts.write.partitionBy("file").parquet(dealt)
    tables = ingest.LakeTables.under(scratch_path(spark, "ingest"))
    for name in listing.names_in(spark, dealt):
        listing.move_folder(spark, f"{dealt}/{name}", f"{path}/{name}")
        run_ingest(spark, sf, path, tables)
    _several[(spark.sparkContext.applicationId, sf)] = tables
    return tables


def last_batches(spark, sf) -> ingest.LakeTables:
    return _several.get((spark.sparkContext.applicationId, sf)) or run_batches(spark, sf)


@query(
    "stream_batches",
    roles.sql(
        f"""SELECT count(*) AS input_rows,
                   CAST(sum(CASE WHEN cdc_operation <> 'd' THEN 1 ELSE 0 END) AS BIGINT) AS applications,
                   CAST(COALESCE(sum(CASE WHEN cdc_operation <> 'd' THEN f.n END), 0) AS BIGINT) AS credits
        FROM cdc LEFT JOIN found f ON user_id = f.reco_id_curr GROUP BY kafka_offset % {BATCHES}""",
        "cdc", "found",
    ),
)
def stream_batches(spark, sf):
    """A progress line for each batch."""
    tables = run_batches(spark, sf)
    return progress.progress_rows(spark, tables.progress).select("input_rows", "applications", "credits")


@query(
    "batch_summary",
    roles.sql(
        f"""SELECT count(*) AS applications, CAST(COALESCE(sum(f.n), 0) AS BIGINT) AS credits,
                   CAST(COALESCE(sum(f.n), 0) AS DOUBLE) / count(*) AS credits_per_application
        FROM cdc LEFT JOIN found f ON user_id = f.reco_id_curr
        WHERE cdc_operation <> 'd' GROUP BY kafka_offset % {BATCHES}""",
        "cdc", "found",
    ),
)
def batch_summary(spark, sf):
    """A row per batch, counted from the landed tables."""
    tables = last_batches(spark, sf)
    return ingest.batch_summary(
        scan_all(spark, tables.applications), scan_all(spark, tables.bureau_credits)
    ).select("applications", "credits", "credits_per_application")


@query(
    "scan_committed",
    roles.sql(LANDED_SQL.format(at=f"TIMESTAMP '{PROCESSED_AT}'", more=""), "cdc", "found"),
)
def scan_committed(spark, sf):
    """Committed batches after a compaction; a batch that landed without its commit is not seen."""
    tables = run_batches(spark, sf)
    commits.compact(spark, tables)
    records = ingest.spread(roles.broker_records(roles.table(spark, sf, "events")))
    events = cdc.keep_row_events(cdc.parse_events(records))
    at = F.lit(PROCESSED_AT).cast("timestamp")
    ingest.land_batch(events, "query_id=unfinished/batch_id=0", *keyed_bureau(spark, sf), tables, at)
    return commits.scan_committed(spark, tables, "applications").select(*LANDED_FIELDS)


@query(
    "training_set_from_lake",
    roles.sql(CURRENT_SQL, "cdc", "credits", "prior"),
)
def training_set_from_lake(spark, sf):
    """The training set over the state that is kept from landed rows and tombstones."""
    tables = last_batches(spark, sf)
    state.refresh(spark, tables, BUCKETS)
    current = cdc.typed_applications(
        state.current(spark, tables.state).select(
            "reco_id_curr", "target", "contract_type_name", "income", "hour_of_approval_process_start"
        )
    )
    credits = bureau_credits(current, roles.bki(spark, sf), roles.balance(spark, sf))
    return plain_numbers(training.training_set(current, credits, roles.prior_loans(spark, sf)))
