"""Change events, enrichment and landed rows."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendspark.catalog import roles
from lendspark.catalog.registry import plain_numbers, query
from lendspark.functions.lookup import quality_score
from lendspark.operators import cdc, enrich
from lendspark.session import scratch_path
from lendspark.sources import schemas
from lendspark.streaming.ingest import land_applications

_EVENT_FIELDS = [
    "reco_id_curr", "target", "contract_type_name", "gender", "income",
    "hour_of_approval_process_start", "cdc_operation", "cdc_timestamp_ms", "source_database",
    "source_schema", "source_table", "kafka_key", "kafka_topic", "kafka_partition",
    "kafka_offset",
]

_EVENT_SQL = """
    CASE WHEN cdc_operation <> 'd' THEN user_id END AS reco_id_curr,
    CASE WHEN cdc_operation <> 'd' THEN CAST(target AS SMALLINT) END AS target,
    CASE WHEN cdc_operation <> 'd' THEN contract_type_name END AS contract_type_name,
    CAST(NULL AS VARCHAR) AS gender,
    CASE WHEN cdc_operation <> 'd' THEN income END AS income,
    CASE WHEN cdc_operation <> 'd' THEN CAST(hour_of_approval_process_start AS SMALLINT) END
        AS hour_of_approval_process_start,
    cdc_operation, cdc_timestamp_ms, 'bank' AS source_database, 'public' AS source_schema,
    'applications' AS source_table, '{"reco_id_curr":' || user_id || '}' AS kafka_key,
    'lending.applications' AS kafka_topic, 0 AS kafka_partition, kafka_offset"""


def events(spark, sf):
    return cdc.parse_events(roles.broker_records(roles.table(spark, sf, "events")))


def row_events(spark, sf):
    return cdc.keep_row_events(events(spark, sf))


@query("cdc_parse", roles.sql(f"SELECT {_EVENT_SQL} FROM cdc", "cdc"))
def cdc_parse(spark, sf):
    return events(spark, sf).select(*_EVENT_FIELDS)


@query("cdc_parse_described", roles.sql(f"SELECT {_EVENT_SQL} FROM cdc", "cdc"))
def cdc_parse_described(spark, sf):
    """Events parsed with a schema that is read from its JSON description.

    The description spells types in capitals and leaves out what the reader fills in.
    """
    def described(kind):
        if not isinstance(kind, T.StructType):
            return kind.typeName().upper()
        return {"type": "struct", "fields": [{"name": f.name, "type": described(f.dataType)} for f in kind.fields]}

    path = scratch_path(spark, "schema")
    text = json.dumps(described(schemas.CDC_PAYLOAD_SCHEMA))
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    payload = schemas.load_schema(spark, path)
    records = roles.broker_records(roles.table(spark, sf, "events"))
    return cdc.parse_events(records, payload).select(*_EVENT_FIELDS)


@query("cdc_filter_ops", roles.sql(f"SELECT {_EVENT_SQL} FROM cdc WHERE cdc_operation <> 'd'", "cdc"))
def cdc_filter_ops(spark, sf):
    return row_events(spark, sf).select(*_EVENT_FIELDS)


@query(
    "cdc_malformed",
    roles.sql(
        """
        SELECT kafka_offset, CASE WHEN cdc_operation IN ('c', 'u') THEN cdc_operation END
                   AS cdc_operation,
               CASE WHEN cdc_operation IN ('c', 'u') THEN user_id END AS reco_id_curr,
               CASE WHEN cdc_operation = 'c' THEN CAST(target AS SMALLINT) END AS target,
               CASE WHEN cdc_operation IN ('c', 'u') THEN contract_type_name END
                   AS contract_type_name
        FROM cdc""",
        "cdc",
    ),
)
def cdc_malformed(spark, sf):
    records = roles.damaged_records(roles.broker_records(roles.table(spark, sf, "events")))
    return cdc.parse_events(records).select(
        "kafka_offset", "cdc_operation", "reco_id_curr", "target", "contract_type_name"
    )


@query(
    "cdc_current_state",
    roles.sql(
        f"""SELECT {_EVENT_SQL} FROM (
            SELECT *, row_number() OVER (
                PARTITION BY user_id ORDER BY cdc_timestamp_ms DESC, kafka_offset DESC) AS rn
            FROM cdc)
        WHERE rn = 1 AND cdc_operation <> 'd'""",
        "cdc",
    ),
)
def cdc_current_state(spark, sf):
    return cdc.current_state(events(spark, sf).select(*_EVENT_FIELDS))


@query(
    "cdc_current_state_any_key",
    roles.sql(
        f"""SELECT * EXCLUDE (kafka_key) FROM (SELECT {_EVENT_SQL} FROM (
            SELECT *, row_number() OVER (
                PARTITION BY user_id ORDER BY cdc_timestamp_ms DESC, kafka_offset DESC) AS rn
            FROM cdc WHERE NOT (cdc_operation = 'd' AND kafka_offset % 17 = 1))
        WHERE rn = 1 AND cdc_operation <> 'd')""",
        "cdc",
    ),
)
def cdc_current_state_any_key(spark, sf):
    """Every third record key in a wrapper, some missing: those rows tell their key
    themselves, and a delete without one ends no state."""
    offset, key = F.col("offset"), F.col("key").cast("string")
    wrapped = F.concat(F.lit('{"payload":'), key, F.lit("}"))
    mixed = F.when(offset % 17 == 1, None).when(offset % 3 == 0, wrapped).otherwise(key)
    records = roles.broker_records(roles.table(spark, sf, "events"))
    parsed = cdc.parse_events(records.withColumn("key", mixed.cast("binary")))
    return cdc.current_state(parsed.select(*_EVENT_FIELDS)).drop("kafka_key")


@query(
    "applications_typed",
    roles.sql(
        """SELECT kafka_offset, user_id AS reco_id_curr, contract_type_name,
                  CAST(income AS DOUBLE) AS income, CAST(NULL AS DOUBLE) AS loan_body
           FROM cdc WHERE cdc_operation <> 'd'""",
        "cdc",
    ),
)
def applications_typed(spark, sf):
    return cdc.typed_applications(row_events(spark, sf)).select(
        "kafka_offset", "reco_id_curr", "contract_type_name", "income", "loan_body"
    )


def all_applications(spark, sf):
    return roles.applications(spark, sf).unionByName(roles.drafts(spark, sf))


_ALL_APPLICATIONS_SQL = "(SELECT * FROM applications UNION ALL SELECT * FROM drafts)"

_OUTCOME_SQL = f"""
    CAST(COALESCE(f.n, 0) AS INTEGER) AS bureau_count,
    CASE WHEN a.reco_id_curr IS NULL THEN 'null_id' WHEN f.n > 0 THEN 'success'
         ELSE 'not_found' END AS bureau_api_status,
    CASE WHEN a.reco_id_curr IS NULL THEN 0 WHEN f.n > 0 THEN 200 ELSE 404 END
        AS bureau_api_http_code,
    0 AS bureau_api_response_time_ms, CAST(NULL AS VARCHAR) AS bureau_api_url,
    CASE WHEN a.reco_id_curr IS NULL THEN 0 ELSE CAST({roles.ASKED_AT_MS} AS BIGINT) END
        AS bureau_api_timestamp"""


@query(
    "bureau_enrich",
    roles.sql(
        f"""SELECT a.*, {_OUTCOME_SQL}
        FROM {_ALL_APPLICATIONS_SQL} a LEFT JOIN found f ON a.reco_id_curr = f.reco_id_curr""",
        "applications", "drafts", "found",
    ),
)
def bureau_enrich(spark, sf):
    return enrich.enrich(
        all_applications(spark, sf), roles.bki(spark, sf), roles.balance(spark, sf),
        F.lit(roles.ASKED_AT_MS),
    )


@query(
    "bureau_enrich_arrays",
    roles.sql(
        """SELECT a.reco_id_curr, a.contract_type_name, CAST(0 AS BIGINT) AS part,
                  CAST(COALESCE(f.n, 0) AS INTEGER) AS bureau_count,
                  COALESCE(f.credits, '') AS credits
        FROM (SELECT * FROM applications UNION ALL SELECT * FROM drafts) a LEFT JOIN (
            SELECT reco_id_curr, count(*) AS n,
                   string_agg(reco_bureau_id || ':' || months_balance || ':' || stat_for_bureau, ','
                       ORDER BY reco_bureau_id, months_balance DESC, stat_for_bureau) AS credits
            FROM credits GROUP BY 1) f
        ON a.reco_id_curr = f.reco_id_curr""",
        "applications", "drafts", "credits",
    ),
)
def bureau_enrich_arrays(spark, sf):
    nested = enrich.enrich_with_arrays(
        all_applications(spark, sf), roles.bki(spark, sf), roles.balance(spark, sf),
        F.lit(roles.ASKED_AT_MS),
    )
    item = lambda c: F.concat_ws(":", c["reco_bureau_id"], c["months_balance"], c["stat_for_bureau"])
    return nested.select(
        "reco_id_curr", "contract_type_name", "part", "bureau_count",
        F.array_join(F.transform("bureau_credits", item), ",").alias("credits"),
    )


_LANDED_CREDITS_SQL = """
    SELECT c.reco_id_curr, c.reco_bureau_id, c.credit_status, c.credit_currency, c.days_credit,
           c.credit_day_overdue, CAST(c.credit_sum AS DOUBLE) AS credit_sum,
           CAST(c.credit_sum_debt AS DOUBLE) AS credit_sum_debt,
           CAST(c.credit_sum_overdue AS DOUBLE) AS credit_sum_overdue, c.credit_type,
           c.months_balance, c.stat_for_bureau
    FROM {applications} a JOIN credits c ON a.reco_id_curr = c.reco_id_curr"""


@query(
    "bureau_explode",
    roles.sql(
        _LANDED_CREDITS_SQL.format(applications=_ALL_APPLICATIONS_SQL),
        "applications", "drafts", "credits",
    ),
)
def bureau_explode(spark, sf):
    nested = enrich.enrich_with_arrays(
        all_applications(spark, sf), roles.bki(spark, sf), roles.balance(spark, sf),
        F.lit(roles.ASKED_AT_MS),
    )
    return plain_numbers(enrich.explode_credits(nested))


@query(
    "bureau_credits_rows",
    roles.sql(
        _LANDED_CREDITS_SQL.format(applications=_ALL_APPLICATIONS_SQL),
        "applications", "drafts", "credits",
    ),
)
def bureau_credits_rows(spark, sf):
    """The same rows without going through arrays."""
    return plain_numbers(
        enrich.bureau_credits(
            all_applications(spark, sf), roles.bki(spark, sf), roles.balance(spark, sf)
        )
    )


@query(
    "data_quality_score",
    roles.sql(
        """SELECT CASE WHEN a.reco_id_curr IS NULL THEN 'null_id' WHEN f.n > 0 THEN 'success'
                  ELSE 'not_found' END AS bureau_api_status,
               CASE WHEN a.reco_id_curr IS NULL THEN 0 WHEN f.n > 0 THEN 100 ELSE 80 END
                   AS data_quality_score,
               count(*) AS applications
        FROM (SELECT * FROM applications UNION ALL SELECT * FROM drafts) a
        LEFT JOIN found f ON a.reco_id_curr = f.reco_id_curr GROUP BY ALL""",
        "applications", "drafts", "found",
    ),
)
def data_quality_score(spark, sf):
    status = F.col("bureau_api_status")
    return (
        bureau_enrich(spark, sf)
        .groupBy(status, quality_score(status).alias("data_quality_score"))
        .agg(F.count(F.lit(1)).alias("applications"))
    )


def landed(spark, sf):
    """Every row event enriched and stamped with its own time as the processing time."""
    enriched = enrich.enrich(
        row_events(spark, sf), roles.bki(spark, sf), roles.balance(spark, sf),
        F.lit(roles.ASKED_AT_MS),
    )
    return land_applications(enriched, F.col("kafka_timestamp"))


LANDED_FIELDS = [
    "kafka_offset", "reco_id_curr", "target", "income", "cdc_operation", "bureau_count",
    "bureau_api_status", "data_quality_score", "year", "month", "day",
]

LANDED_SQL = """
    SELECT c.kafka_offset, c.user_id AS reco_id_curr, CAST(c.target AS SMALLINT) AS target,
           c.income, c.cdc_operation, CAST(COALESCE(f.n, 0) AS INTEGER) AS bureau_count,
           CASE WHEN f.n > 0 THEN 'success' ELSE 'not_found' END AS bureau_api_status,
           CASE WHEN f.n > 0 THEN 100 ELSE 80 END AS data_quality_score,
           CAST(year({at}) AS INTEGER) AS year, CAST(month({at}) AS INTEGER) AS month,
           CAST(day({at}) AS INTEGER) AS day
    FROM cdc c LEFT JOIN found f ON c.user_id = f.reco_id_curr
    WHERE c.cdc_operation <> 'd' {more}"""


@query("applications_landed", roles.sql(LANDED_SQL.format(at="c.ts", more=""), "cdc", "found"))
def applications_landed(spark, sf):
    return landed(spark, sf).select(*LANDED_FIELDS)
