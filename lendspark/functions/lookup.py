"""Columns that describe the outcome of a bureau lookup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lookup outcomes, their response codes and quality scores.
SUCCESS, NOT_FOUND, NULL_ID, UNKNOWN = "success", "not_found", "null_id", "unknown"
RESPONSE_CODES = {SUCCESS: 200, NOT_FOUND: 404, NULL_ID: 0}
QUALITY_SCORES = {SUCCESS: 100, NOT_FOUND: 80}
OTHER_QUALITY_SCORE = 0


def quality_score(status: Column) -> Column:
    """Score of a lookup status; every other status, and none, scores 0."""
    scores = F.create_map(*(F.lit(x) for pair in QUALITY_SCORES.items() for x in pair))
    return F.coalesce(F.try_element_at(scores, status), F.lit(OTHER_QUALITY_SCORE))


def lookup_columns(key: Column, found: Column, asked_at_ms: Column) -> dict[str, Column]:
    """The six outcome columns, given the key and the number of credit rows it found.

    A join has no transport, so the address is null and the elapsed time is 0.
    """
    found = F.coalesce(found, F.lit(0)).cast("int")
    status = (
        F.when(key.isNull(), NULL_ID).when(found > 0, SUCCESS).otherwise(NOT_FOUND)
    )
    code = (
        F.when(key.isNull(), RESPONSE_CODES[NULL_ID])
        .when(found > 0, RESPONSE_CODES[SUCCESS])
        .otherwise(RESPONSE_CODES[NOT_FOUND])
    )
    return {
        "bureau_count": found,
        "bureau_api_status": status,
        "bureau_api_http_code": code,
        "bureau_api_response_time_ms": F.lit(0),
        "bureau_api_url": F.lit(None).cast("string"),
        "bureau_api_timestamp": F.when(key.isNull(), F.lit(0).cast("long")).otherwise(
            asked_at_ms.cast("long")
        ),
    }
