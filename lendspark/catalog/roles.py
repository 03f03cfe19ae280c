"""The driver's tables in the parts of the lending tables, for Spark and in SQL.

Every role is a projection or union of whole tables. The SQL twin of a role is a common
table expression that the SQL checks put in front of their query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.plans.training import PriorLoans

# Time of run, a parameter so that results repeat.
ASKED_AT_MS = 1_704_067_200_000
TOPIC = "lending.applications"

_OPERATIONS = {"signup": "c", "view": "r", "click": "u"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    # Driver timestamps carry no zone; results are compared in UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _money(name: str) -> Column:
    return F.col(name).cast("decimal(18,2)")


def applications(spark: SparkSession, sf: str) -> DataFrame:
    """Customers, and suppliers as applicants the bureau does not know."""
    def rows(df, key, name, prefix):
        balance = f"{prefix}_acctbal"
        return df.select(
            key.alias("reco_id_curr"),
            F.when(F.col(balance) < 0, 1).otherwise(0).alias("target"),
            name.alias("contract_type_name"),
            F.col(balance).alias("income"),
            F.col(f"{prefix}_nationkey").alias("rating_client_region"),
        )

    customers = rows(table(spark, sf, "customer"), F.col("c_custkey"), F.col("c_mktsegment"), "c")
    suppliers = rows(table(spark, sf, "supplier"), -1 - F.col("s_suppkey"), F.lit("SUPPLIER"), "s")
    return customers.unionByName(suppliers)


def drafts(spark: SparkSession, sf: str) -> DataFrame:
    """Applications without an id yet."""
    return table(spark, sf, "nation").select(
        F.lit(None).cast("bigint").alias("reco_id_curr"),
        F.lit(0).alias("target"),
        F.col("n_name").alias("contract_type_name"),
        F.lit(None).cast("double").alias("income"),
        F.col("n_nationkey").alias("rating_client_region"),
    )


def bki(spark: SparkSession, sf: str) -> DataFrame:
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    days = F.when(status == "P", None).when(key % 4 == 0, key % 90).otherwise(0).cast("int")
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("reco_id_curr"),
        key.alias("reco_bureau_id"),
        F.when(status == "O", "Active").when(status == "F", "Closed").otherwise("Sold").alias("credit_status"),
        F.lit("currency 1").alias("credit_currency"),
        F.date_diff(F.col("o_orderdate"), F.lit("2001-08-01").cast("date")).alias("days_credit"),
        days.alias("credit_day_overdue"),
        _money("o_totalprice").alias("credit_sum"),
        F.when(status == "F", None).otherwise(_money("o_totalprice")).alias("credit_sum_debt"),
        F.when(days > 0, _money("o_totalprice")).alias("credit_sum_overdue"),
        F.col("o_orderpriority").alias("credit_type"),
    )


def balance(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("reco_bureau_id"),
        (1 - F.col("l_linenumber")).alias("months_balance"),
        F.col("l_linestatus").alias("stat_for_bureau"),
    )


def prior_loans(spark: SparkSession, sf: str) -> PriorLoans:
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")

    def children(flag: str, **columns: Column) -> DataFrame:
        return lines.where(F.col("l_returnflag") == flag).select(
            F.col("l_orderkey").alias("reco_id_last"),
            F.lit(None).cast("bigint").alias("reco_id_curr"),
            *(c.alias(n) for n, c in columns.items()),
        )

    months, count = 1 - F.col("l_linenumber"), F.col("l_quantity").cast("int")
    price = F.col("l_extendedprice")
    return PriorLoans(
        previous_loan=orders.select(
            F.col("o_orderkey").alias("reco_id_last"),
            F.col("o_custkey").alias("reco_id_curr"),
            F.col("o_orderpriority").alias("contract_type_name"),
            F.col("o_totalprice").alias("loan_body"),
            F.col("o_orderstatus").alias("contract_status_name"),
            F.date_diff(F.col("o_orderdate"), F.lit("2001-08-01").cast("date")).alias("days_decision"),
        ),
        cash_pos_balance=children(
            "A", months_balance=months, installment_count=count,
            contract_status_name=F.col("l_linestatus"),
        ),
        credit_card_balance=children(
            "R", months_balance=months, balance=price, drawings_count=count,
            contract_status_name=F.col("l_linestatus"),
        ),
        installments_payments=children(
            "N", number_of_instalment_ver=F.lit(1), number_of_instalment_num=F.col("l_linenumber"),
            payment=price,
        ),
    )


def broker_records(events: DataFrame) -> DataFrame:
    """Events as change records: creates and updates wrapped, reads and deletes flat."""
    kind = F.col("event_type")
    op = F.lit("d")
    for name, code in _OPERATIONS.items():
        op = F.when(kind == name, code).otherwise(op)
    image = F.struct(
        F.col("user_id").alias("reco_id_curr"),
        (F.col("event_id") % 2).alias("target"),
        kind.alias("contract_type_name"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("income"),
        F.hour("ts").alias("hour_of_approval_process_start"),
    )
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    event = F.struct(
        F.when(op != "d", image).alias("after"),
        F.struct(
            F.lit("bank").alias("db"), F.lit("public").alias("schema"),
            F.lit("applications").alias("table"),
        ).alias("source"),
        op.alias("op"),
        ms.alias("ts_ms"),
    )
    text = F.when(op.isin("c", "u"), F.to_json(F.struct(event.alias("payload")))).otherwise(F.to_json(event))
    return events.select(
        F.to_json(F.struct(F.col("user_id").alias("reco_id_curr"))).cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def damaged_records(records: DataFrame) -> DataFrame:
    """Records with whole classes of damage: cut text, a wrong type, no text at all."""
    text = F.col("value").cast("string")
    damaged = (
        F.when(text.contains('"op":"d"'), F.expr("left(cast(value as string), length(value) - 1)"))
        .when(text.contains('"op":"u"'), F.regexp_replace(text, '"target":[01]', '"target":"many"'))
        .when(text.contains('"op":"r"'), F.lit(None).cast("string"))
        .otherwise(text)
    )
    return records.withColumn("value", damaged.cast("binary"))


def scored_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labels as outcomes: quality is the truth, toxicity the guess, length the score."""
    labels = table(spark, sf, "labels")
    documents = table(spark, sf, "documents").select("doc_id", "n_chars")
    return labels.join(documents, "doc_id").select(
        F.col("quality").alias("label"), F.col("toxic").alias("prediction"),
        F.col("n_chars").alias("score"),
    )


SQL = {
    "applications": """
        SELECT c_custkey AS reco_id_curr, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS target,
               c_mktsegment AS contract_type_name, c_acctbal AS income,
               c_nationkey AS rating_client_region
        FROM customer
        UNION ALL
        SELECT -1 - s_suppkey, CASE WHEN s_acctbal < 0 THEN 1 ELSE 0 END, 'SUPPLIER',
               s_acctbal, s_nationkey
        FROM supplier""",
    "drafts": """
        SELECT CAST(NULL AS BIGINT) AS reco_id_curr, 0 AS target, n_name AS contract_type_name,
               CAST(NULL AS DOUBLE) AS income, n_nationkey AS rating_client_region
        FROM nation""",
    "bki": """
        SELECT *, CASE WHEN credit_day_overdue > 0 THEN credit_sum END AS credit_sum_overdue
        FROM (
            SELECT o_custkey AS reco_id_curr, o_orderkey AS reco_bureau_id,
                   CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Closed'
                        ELSE 'Sold' END AS credit_status,
                   'currency 1' AS credit_currency,
                   CAST(datediff('day', DATE '2001-08-01', CAST(o_orderdate AS DATE)) AS INTEGER)
                       AS days_credit,
                   CAST(CASE WHEN o_orderstatus = 'P' THEN NULL
                        WHEN o_orderkey % 4 = 0 THEN o_orderkey % 90 ELSE 0 END AS INTEGER)
                       AS credit_day_overdue,
                   CAST(o_totalprice AS DECIMAL(18,2)) AS credit_sum,
                   CASE WHEN o_orderstatus <> 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END
                       AS credit_sum_debt,
                   o_orderpriority AS credit_type
            FROM orders)""",
    "balance": """
        SELECT l_orderkey AS reco_bureau_id, 1 - l_linenumber AS months_balance,
               l_linestatus AS stat_for_bureau
        FROM lineitem""",
    "previous_loan": """
        SELECT o_orderkey AS reco_id_last, o_custkey AS reco_id_curr,
               o_orderpriority AS contract_type_name, o_totalprice AS loan_body,
               o_orderstatus AS contract_status_name,
               CAST(datediff('day', DATE '2001-08-01', CAST(o_orderdate AS DATE)) AS INTEGER)
                   AS days_decision
        FROM orders""",
    "cash_pos_balance": """
        SELECT l_orderkey AS reco_id_last, CAST(NULL AS BIGINT) AS reco_id_curr,
               1 - l_linenumber AS months_balance,
               CAST(l_quantity AS INTEGER) AS installment_count,
               l_linestatus AS contract_status_name
        FROM lineitem WHERE l_returnflag = 'A'""",
    "credit_card_balance": """
        SELECT l_orderkey AS reco_id_last, CAST(NULL AS BIGINT) AS reco_id_curr,
               1 - l_linenumber AS months_balance, l_extendedprice AS balance,
               CAST(l_quantity AS INTEGER) AS drawings_count,
               l_linestatus AS contract_status_name
        FROM lineitem WHERE l_returnflag = 'R'""",
    "installments_payments": """
        SELECT l_orderkey AS reco_id_last, CAST(NULL AS BIGINT) AS reco_id_curr,
               1 AS number_of_instalment_ver, l_linenumber AS number_of_instalment_num,
               l_extendedprice AS payment
        FROM lineitem WHERE l_returnflag = 'N'""",
    "cdc": """
        SELECT event_id AS kafka_offset, user_id,
               CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'click' THEN 'u'
                    ELSE 'd' END AS cdc_operation,
               event_id % 2 AS target, event_type AS contract_type_name,
               CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS income,
               hour(ts) AS hour_of_approval_process_start,
               epoch_us(ts) // 1000 AS cdc_timestamp_ms, ts
        FROM events""",
    "found": """
        SELECT reco_id_curr, count(*) AS n
        FROM bki JOIN balance USING (reco_bureau_id) GROUP BY 1""",
    "prior": """
        WITH loans AS (
            SELECT reco_id_last, reco_id_curr AS borrower, contract_type_name AS prev_contract_type_name,
                   loan_body AS prev_loan_body, contract_status_name AS prev_contract_status, days_decision
            FROM previous_loan WHERE days_decision + 365 >= 0),
        cash AS (
            SELECT reco_id_last, reco_id_curr AS cash_owner, months_balance AS cashpos_months_balance,
                   installment_count, contract_status_name AS cashpos_contract_status_name
            FROM cash_pos_balance WHERE months_balance IN (0, -1, -2, -3)),
        cards AS (
            SELECT reco_id_last, reco_id_curr AS card_owner, months_balance AS cc_months_balance,
                   balance, drawings_count, contract_status_name AS cc_contract_status_name
            FROM credit_card_balance WHERE months_balance IN (0, -1, -2, -3)),
        paid AS (
            SELECT reco_id_last, reco_id_curr AS payer, number_of_instalment_ver,
                   number_of_instalment_num, payment AS actual_payment
            FROM installments_payments)
        SELECT * EXCLUDE (borrower, cash_owner, card_owner, payer),
               COALESCE(borrower, cash_owner, card_owner, payer) AS reco_id_curr
        FROM loans LEFT JOIN cash USING (reco_id_last) LEFT JOIN cards USING (reco_id_last)
             LEFT JOIN paid USING (reco_id_last)""",
    "credits": """
        SELECT b.*, bb.months_balance, bb.stat_for_bureau
        FROM bki b JOIN balance bb ON b.reco_bureau_id = bb.reco_bureau_id""",
}

# Roles that a role's SQL reads.
_NEEDS = {
    "found": ("bki", "balance"),
    "credits": ("bki", "balance"),
    "prior": (
        "previous_loan", "cash_pos_balance", "credit_card_balance", "installments_payments",
    ),
}


def sql(body: str, *roles: str) -> str:
    """A query over the named roles."""
    ordered: dict[str, None] = {}
    for role in roles:
        for needed in (*_NEEDS.get(role, ()), role):
            ordered[needed] = None
    ctes = ", ".join(f"{name} AS ({SQL[name]})" for name in ordered)
    return f"WITH {ctes} {body}" if ctes else body
