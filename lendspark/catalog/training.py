"""Training set, joins and their reports."""

from pyspark.sql import functions as F

from lendspark.catalog import roles
from lendspark.catalog.registry import plain_numbers, query
from lendspark.functions.columns import keep_first_names, non_null_counts
from lendspark.operators import cdc, enrich, joins, model
from lendspark.plans import training, training_facts
from lendspark.session import scratch_path

_EXPORTED_AT = "2025-10-28 09:30:00"

_LAKE_CREDITS = """
    credit_status, credit_currency, days_credit, credit_day_overdue,
    CAST(credit_sum AS DOUBLE) AS credit_sum, CAST(credit_sum_debt AS DOUBLE) AS credit_sum_debt,
    CAST(credit_sum_overdue AS DOUBLE) AS credit_sum_overdue, credit_type, months_balance,
    stat_for_bureau"""

_APPS_BUREAU = f"""
    SELECT a.*, c.reco_bureau_id, {_LAKE_CREDITS}
    FROM applications a LEFT JOIN credits c ON a.reco_id_curr = c.reco_id_curr"""

_TRAINING = f"""
    SELECT a.*, c.reco_bureau_id, {_LAKE_CREDITS}, p.* EXCLUDE (reco_id_curr)
    FROM applications a LEFT JOIN credits c ON a.reco_id_curr = c.reco_id_curr
    LEFT JOIN prior p ON a.reco_id_curr = p.reco_id_curr"""


CURRENT_SQL = f"""
, a AS (SELECT user_id AS reco_id_curr, CAST(target AS SMALLINT) AS target,
               contract_type_name, CAST(income AS DOUBLE) AS income,
               CAST(hour_of_approval_process_start AS SMALLINT)
                   AS hour_of_approval_process_start
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                  ORDER BY cdc_timestamp_ms DESC, kafka_offset DESC) AS rn FROM cdc)
        WHERE rn = 1 AND cdc_operation <> 'd')
SELECT a.*, c.reco_bureau_id, {_LAKE_CREDITS}, p.* EXCLUDE (reco_id_curr)
FROM a LEFT JOIN credits c ON a.reco_id_curr = c.reco_id_curr
LEFT JOIN prior p ON a.reco_id_curr = p.reco_id_curr"""


def lake_credits(spark, sf):
    """Credits as the lake holds them: those of all applications, by row."""
    return enrich.bureau_credits(
        roles.applications(spark, sf), roles.bki(spark, sf), roles.balance(spark, sf)
    )


@query(
    "recent_prev_loans",
    roles.sql("SELECT * FROM previous_loan WHERE days_decision >= -365", "previous_loan"),
)
def recent_prev_loans(spark, sf):
    return training.recent_loans(roles.prior_loans(spark, sf).previous_loan)


@query(
    "recent_balances",
    roles.sql(
        "SELECT * FROM cash_pos_balance WHERE months_balance BETWEEN -3 AND 0", "cash_pos_balance"
    ),
)
def recent_balances(spark, sf):
    return training.recent_balances(roles.prior_loans(spark, sf).cash_pos_balance)


@query("prev_loan_wide", roles.sql("SELECT * FROM prior", "prior"))
def prev_loan_wide(spark, sf):
    return training.prior_loans_wide(roles.prior_loans(spark, sf))


@query("apps_bureau_left_join", roles.sql(_APPS_BUREAU, "applications", "credits"))
def apps_bureau_left_join(spark, sf):
    return plain_numbers(
        training.applications_with_credits(roles.applications(spark, sf), lake_credits(spark, sf))
    )


def training_tables(spark, sf):
    return roles.applications(spark, sf), lake_credits(spark, sf), roles.prior_loans(spark, sf)


def training_frame(spark, sf, with_prior=True):
    applications, credits, prior = training_tables(spark, sf)
    return training.training_set(applications, credits, prior if with_prior else None)


@query("training_set", roles.sql(_TRAINING, "applications", "credits", "prior"))
def training_set(spark, sf):
    return plain_numbers(training_frame(spark, sf))


@query("training_set_without_prior", roles.sql(_APPS_BUREAU, "applications", "credits"))
def training_set_without_prior(spark, sf):
    return plain_numbers(training_frame(spark, sf, with_prior=False))


@query(
    "training_set_current",
    roles.sql(
        CURRENT_SQL,
        "cdc", "credits", "prior",
    ),
)
def training_set_current(spark, sf):
    """From change events: latest version of each application, typed, then joined."""
    events = cdc.parse_events(roles.broker_records(roles.table(spark, sf, "events")))
    path = scratch_path(spark, "current-applications")
    cdc.typed_applications(
        cdc.current_state(events).select(
            "reco_id_curr", "target", "contract_type_name", "income",
            "hour_of_approval_process_start",
        )
    ).write.parquet(path)
    current = spark.read.parquet(path)
    credits = enrich.bureau_credits(current, roles.bki(spark, sf), roles.balance(spark, sf))
    return plain_numbers(training.training_set(current, credits, roles.prior_loans(spark, sf)))


@query(
    "source_coverage",
    roles.sql(
        f"""SELECT count(reco_id_last) AS reco_id_last,
                   count(cashpos_months_balance) AS cashpos_months_balance,
                   count(cc_months_balance) AS cc_months_balance,
                   count(number_of_instalment_ver) AS number_of_instalment_ver
        FROM ({_TRAINING})""",
        "applications", "credits", "prior",
    ),
)
def source_coverage(spark, sf):
    return training_facts.source_coverage(*training_tables(spark, sf))


@query(
    "training_summary",
    roles.sql(
        f"""
        , t AS ({_TRAINING})
        SELECT 'Total Rows' AS metric, format('{{:,}}', count(*)) AS value FROM t
        UNION ALL
        SELECT 'Total Columns', CAST(31 AS VARCHAR)
        UNION ALL
        SELECT 'Total Applications', format('{{:,}}', count(DISTINCT reco_id_curr)) FROM t
        UNION ALL
        SELECT 'Applications with Bureau Data', format('{{:,}}', count(DISTINCT reco_id_curr))
        FROM t WHERE reco_bureau_id IS NOT NULL
        UNION ALL
        SELECT 'Applications without Bureau Data', format('{{:,}}', count(DISTINCT reco_id_curr))
        FROM t WHERE reco_bureau_id IS NULL
        UNION ALL
        SELECT 'Total Bureau Credits', format('{{:,}}', count(reco_bureau_id)) FROM t
        UNION ALL
        SELECT 'Date Range (Processing Date)', 'N/A'
        UNION ALL
        SELECT 'Export Timestamp', '{_EXPORTED_AT}'""",
        "applications", "credits", "prior",
    ),
)
def training_summary(spark, sf):
    at = F.to_timestamp_ntz(F.lit(_EXPORTED_AT))
    return training_facts.training_summary(*training_tables(spark, sf), at)


@query(
    "duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicate_keys(spark, sf):
    return joins.duplicate_keys(roles.table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


@query(
    "dedupe_columns",
    """SELECT c_custkey AS id, c_name AS name, c_nationkey, n_name AS nation
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def dedupe_columns(spark, sf):
    customer = roles.table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_nationkey")
    nation = roles.table(spark, sf, "nation").selectExpr(
        "n_nationkey AS id", "n_name AS name", "n_name AS nation"
    )
    joined = customer.join(nation, F.col("c_nationkey") == nation["id"])
    return keep_first_names(joined)


def _join_sides(spark, sf):
    """Applications, and loans of which some belong to nobody in the lake."""
    first = roles.applications(spark, sf).select(
        "reco_id_curr", F.col("contract_type_name").alias("name"), F.col("income").alias("amount"),
        "target",
    )
    known = roles.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("reco_id_curr"), F.col("o_orderpriority").alias("name"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderkey").alias("loan"),
    )
    unknown = roles.table(spark, sf, "nation").select(
        (-1_000_000_000 - F.col("n_nationkey").cast("bigint")).alias("reco_id_curr"),
        F.col("n_name").alias("name"), F.lit(0.0).alias("amount"),
        F.col("n_nationkey").cast("bigint").alias("loan"),
    )
    return first, known.unionByName(unknown)


_SIDES = """
    , f AS (SELECT reco_id_curr, contract_type_name AS name, income AS amount, target
            FROM applications),
    s AS (SELECT o_custkey AS reco_id_curr, o_orderpriority AS name, o_totalprice AS amount,
                 o_orderkey AS loan FROM orders
          UNION ALL
          SELECT -1000000000 - n_nationkey, n_name, 0.0, n_nationkey FROM nation) """


def _join_query(how: str, sql_join: str) -> None:
    @query(
        f"join_{how}",
        roles.sql(
            f"""{_SIDES}
            SELECT COALESCE(f.reco_id_curr, s.reco_id_curr) AS reco_id_curr, f.name AS name_1,
                   f.amount AS amount_1, target, s.name AS name_2, s.amount AS amount_2, loan
            FROM f {sql_join} s ON f.reco_id_curr = s.reco_id_curr""",
            "applications",
        ),
    )
    def run(spark, sf):
        return joins.join_tables(*_join_sides(spark, sf), "reco_id_curr", how)


for _how, _sql_join in (
    ("left", "LEFT JOIN"), ("inner", "JOIN"), ("right", "RIGHT JOIN"), ("outer", "FULL JOIN"),
):
    _join_query(_how, _sql_join)


@query(
    "join_stats",
    roles.sql(
        f"""{_SIDES}, j AS (
            SELECT f.reco_id_curr FROM f LEFT JOIN s ON f.reco_id_curr = s.reco_id_curr)
        SELECT (SELECT count(DISTINCT reco_id_curr) FROM f) AS unique_keys_1,
               (SELECT count(DISTINCT reco_id_curr) FROM s) AS unique_keys_2,
               (SELECT count(DISTINCT reco_id_curr) FROM j) AS unique_keys_joined,
               (SELECT count(*) FROM f) AS rows_1, (SELECT count(*) FROM j) AS rows_joined,
               (SELECT count(*) FROM j)::DOUBLE / (SELECT count(*) FROM f) AS row_multiplication""",
        "applications",
    ),
)
def join_stats(spark, sf):
    return joins.join_stats(*_join_sides(spark, sf), "reco_id_curr", "left")


@query(
    "non_null_counts",
    roles.sql(
        """SELECT count(reco_id_curr) AS reco_id_curr, count(credit_day_overdue) AS credit_day_overdue,
                  count(credit_sum) AS credit_sum, count(credit_sum_debt) AS credit_sum_debt,
                  count(credit_sum_overdue) AS credit_sum_overdue FROM bki""",
        "bki",
    ),
)
def count_non_null(spark, sf):
    return non_null_counts(
        roles.bki(spark, sf),
        ["reco_id_curr", "credit_day_overdue", "credit_sum", "credit_sum_debt", "credit_sum_overdue"],
    )


@query(
    "drop_incomplete_rows",
    roles.sql(
        """SELECT reco_id_curr, reco_bureau_id, credit_status, credit_currency, days_credit,
                  credit_day_overdue, CAST(credit_sum AS DOUBLE) AS credit_sum,
                  CAST(credit_sum_debt AS DOUBLE) AS credit_sum_debt,
                  CAST(credit_sum_overdue AS DOUBLE) AS credit_sum_overdue, credit_type
        FROM bki WHERE credit_day_overdue IS NOT NULL AND credit_sum_debt IS NOT NULL
          AND credit_sum_overdue IS NOT NULL""",
        "bki",
    ),
)
def drop_incomplete_rows(spark, sf):
    return plain_numbers(model.drop_incomplete(roles.bki(spark, sf)))
