"""Bureau queries."""

from lendspark.catalog import roles
from lendspark.catalog.registry import plain_numbers, query
from lendspark.operators import bureau

# A customer every scale factor has.
ONE_ID = 42

_SUMMARY = """
    SELECT reco_id_curr, count(DISTINCT reco_bureau_id) AS total_credits,
           count(DISTINCT CASE WHEN credit_status = 'Active' THEN reco_bureau_id END)
               AS active_credits,
           CAST(sum(credit_sum) AS DOUBLE) AS total_credit_sum,
           CAST(sum(credit_sum_debt) AS DOUBLE) AS total_debt,
           CAST(sum(credit_sum_overdue) AS DOUBLE) AS total_overdue,
           avg(credit_day_overdue) AS avg_days_overdue,
           max(credit_day_overdue) AS max_days_overdue,
           count(DISTINCT CASE WHEN credit_day_overdue > 0 THEN reco_bureau_id END)
               AS credits_with_overdue
    FROM bki {where} GROUP BY reco_id_curr"""

_CREDITS = """
    reco_id_curr, reco_bureau_id, credit_status, credit_currency, days_credit,
    credit_day_overdue, CAST(credit_sum AS DOUBLE) AS credit_sum,
    CAST(credit_sum_debt AS DOUBLE) AS credit_sum_debt,
    CAST(credit_sum_overdue AS DOUBLE) AS credit_sum_overdue, credit_type, months_balance,
    stat_for_bureau"""


@query("bureau_summary", roles.sql(_SUMMARY.format(where=""), "bki"))
def bureau_summary(spark, sf):
    return plain_numbers(bureau.summary(roles.bki(spark, sf)))


@query(
    "bureau_summary_one",
    roles.sql(_SUMMARY.format(where=f"WHERE reco_id_curr = {ONE_ID}"), "bki"),
)
def bureau_summary_one(spark, sf):
    return plain_numbers(bureau.summary_of(roles.bki(spark, sf), ONE_ID))


@query(
    "bureau_lookup",
    roles.sql(
        f"""
        SELECT CAST(reco_id_curr AS INTEGER) AS reco_id_curr,
               CAST(reco_bureau_id AS INTEGER) AS reco_bureau_id, credit_status,
               credit_currency, days_credit, credit_day_overdue,
               CAST(credit_sum AS DOUBLE) AS credit_sum,
               CAST(credit_sum_debt AS DOUBLE) AS credit_sum_debt,
               CAST(credit_sum_overdue AS DOUBLE) AS credit_sum_overdue, credit_type,
               months_balance, stat_for_bureau
        FROM credits WHERE reco_id_curr = {ONE_ID}
        ORDER BY reco_bureau_id ASC NULLS LAST, months_balance DESC NULLS FIRST""",
        "credits",
    ),
)
def bureau_lookup(spark, sf):
    found = bureau.lookup(roles.bki(spark, sf), roles.balance(spark, sf), ONE_ID)
    return bureau.answer_schema(found).select(*found.columns)


@query("bureau_credit_balance_join", roles.sql(f"SELECT {_CREDITS} FROM credits", "credits"))
def bureau_credit_balance_join(spark, sf):
    return plain_numbers(bureau.credit_balances(roles.bki(spark, sf), roles.balance(spark, sf)))


@query(
    "bureau_search",
    roles.sql(
        f"""SELECT {_CREDITS} FROM credits
        WHERE credit_status = 'Active' AND credit_type = '1-URGENT' AND credit_sum >= 50000
          AND credit_sum <= 300000 AND credit_day_overdue > 0""",
        "credits",
    ),
)
def bureau_search(spark, sf):
    wanted = bureau.Search(
        credit_status="Active", credit_type="1-URGENT", min_credit_sum=50000,
        max_credit_sum=300000, has_overdue=True,
    )
    return plain_numbers(bureau.search(roles.bki(spark, sf), roles.balance(spark, sf), wanted))


@query(
    "bureau_search_no_overdue",
    roles.sql(
        f"""SELECT {_CREDITS} FROM credits
        WHERE credit_day_overdue = 0 OR credit_day_overdue IS NULL""",
        "credits",
    ),
)
def bureau_search_no_overdue(spark, sf):
    wanted = bureau.Search(credit_status="", has_overdue=False)
    return plain_numbers(bureau.search(roles.bki(spark, sf), roles.balance(spark, sf), wanted))


@query(
    "bureau_search_page",
    roles.sql(
        f"""SELECT {_CREDITS} FROM credits WHERE credit_status = 'Active'
        ORDER BY reco_id_curr ASC NULLS LAST, reco_bureau_id ASC NULLS LAST,
                 months_balance DESC NULLS FIRST, credit_status NULLS LAST,
                 credit_currency NULLS LAST, days_credit NULLS LAST,
                 credit_day_overdue NULLS LAST, credit_sum NULLS LAST,
                 credit_sum_debt NULLS LAST, credit_sum_overdue NULLS LAST,
                 credit_type NULLS LAST, stat_for_bureau NULLS LAST
        LIMIT 1000 OFFSET 500""",
        "credits",
    ),
)
def bureau_search_page(spark, sf):
    wanted = bureau.Search(credit_status="Active")
    found = bureau.search_page(
        roles.bki(spark, sf), roles.balance(spark, sf), wanted, limit=1000, offset=500
    )
    return plain_numbers(found)
