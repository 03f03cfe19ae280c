"""Fixed schemas of the lending data and a lenient reader for JSON schema descriptions."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Names, order and types of the application row image.
APPLICATION_DDL = """
    reco_id_curr BIGINT, target SMALLINT, contract_type_name STRING, gender STRING,
    own_car_flag STRING, own_realty_flag STRING, children_count STRING, income STRING,
    loan_body STRING, annuity_payment STRING, goods_price STRING, type_suite_name STRING,
    income_type_name STRING, education_type_name STRING, family_status_name STRING,
    housing_type_name STRING, population_relative_region STRING, days_birth INT,
    days_employed INT, registration_timestamp DOUBLE, publication_timestamp INT,
    age_own_car STRING, mobile_flag SMALLINT, employee_phone_flag SMALLINT,
    work_phone_flag SMALLINT, mobile_contact_flag SMALLINT, phone_flag SMALLINT,
    email_flag SMALLINT, type_of_occupation STRING, family_members__count STRING,
    rating_client_region SMALLINT, rating_client_w_city_region SMALLINT,
    start_weekday_appr_process STRING, hour_of_approval_process_start SMALLINT,
    not_live_region_reg_region SMALLINT, not_work_region_reg_region SMALLINT,
    living_region_not_work_region_flag SMALLINT, not_live_city_reg_city SMALLINT,
    not_work_city_reg_city SMALLINT, living_city_not_work_city_flag SMALLINT,
    type_of_organization STRING, external_source_1 STRING, external_source_2 STRING,
    external_source_3 STRING,
    average_apartments STRING, average_basementarea STRING,
    average_years_beginexpluatation STRING, average_years_building STRING,
    average_commonarea STRING, average_elevator_count STRING,
    average_entrance_count STRING, average_max_floors STRING, average_min_floors STRING,
    average_land_area STRING, average_living_apartments STRING, average_living_area STRING,
    non_living_apartments_avg STRING, non_living_area_avg STRING,
    mode_apartments STRING, mode_basementarea STRING, mode_years_beginexpluatation STRING,
    mode_years_building STRING, mode_commonarea STRING, mode_elevator_count STRING,
    mode_entrance_count STRING, mode_max_floors STRING, mode_min_floors STRING,
    mode_land_area STRING, mode_living_apartments STRING, mode_living_area STRING,
    non_living_apartments_mode STRING, non_living_area_mode STRING,
    median_apartments STRING, median_basementarea STRING,
    median_years_beginexpluatation STRING, median_years_building STRING,
    median_commonarea STRING, median_elevator_count STRING, median_entrance_count STRING,
    median_max_floors STRING, median_min_floors STRING, median_land_area STRING,
    median_living_apartments STRING, median_living_area STRING,
    non_living_apartments_medi STRING, non_living_area_medi STRING,
    fondkapremon_mode STRING, mode_house_type STRING, mode_total_area STRING,
    mode_walls_material STRING, emergency_state_mode STRING,
    observes_30_count_social_circle STRING, social_circle_defaults_30_days STRING,
    observes_60_count_social_circle STRING, social_circle_defaults_60_days STRING,
    last_phone_number_change STRING,
    document_2_flag SMALLINT, document_3_flag SMALLINT, document_4_flag SMALLINT,
    document_5_flag SMALLINT, document_6_flag SMALLINT, document_7_flag SMALLINT,
    document_8_flag SMALLINT, document_9_flag SMALLINT, document_10_flag SMALLINT,
    document_11_flag SMALLINT, document_12_flag SMALLINT, document_13_flag SMALLINT,
    document_14_flag SMALLINT, document_15_flag SMALLINT, document_16_flag SMALLINT,
    document_17_flag SMALLINT, document_18_flag SMALLINT, document_19_flag SMALLINT,
    document_20_flag SMALLINT, document_21_flag SMALLINT,
    requests_bki_hour STRING, requests_bki_day STRING, requests_bki_week STRING,
    requests_bki_month STRING, requests_bki_qrt STRING, requests_bki_year STRING
"""

# Text columns of the row image that hold categories, not decimals.
APPLICATION_CATEGORIES = """
    contract_type_name gender own_car_flag own_realty_flag type_suite_name income_type_name
    education_type_name family_status_name housing_type_name type_of_occupation
    start_weekday_appr_process type_of_organization fondkapremon_mode mode_house_type
    mode_walls_material emergency_state_mode
""".split()

# Change-event origin block.
CDC_SOURCE_DDL = """
    version STRING, connector STRING, name STRING, ts_ms BIGINT, snapshot STRING, db STRING,
    sequence STRING, ts_us BIGINT, ts_ns BIGINT, schema STRING, table STRING, txId BIGINT,
    lsn BIGINT, xmin BIGINT
"""

# A message as the broker hands it over.
BROKER_RECORD_DDL = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
)

# Bureau tables.
BKI_DDL = """
    reco_id_curr INT, reco_bureau_id INT, credit_status STRING, credit_currency STRING,
    days_credit INT, credit_day_overdue INT, days_credit_enddate INT, days_enddate_fact INT,
    credit_limit_max_overdue DOUBLE, credit_prolong_count INT, credit_sum DOUBLE,
    credit_sum_debt DOUBLE, credit_sum_limit DOUBLE, credit_sum_overdue DOUBLE,
    credit_type STRING, days_credit_update INT, annuity_payment DOUBLE
"""
BALANCE_DDL = "reco_bureau_id INT, months_balance INT, stat_for_bureau STRING"

_SQL_TYPES = {
    "STRING": T.StringType(), "BINARY": T.BinaryType(), "TIMESTAMP": T.TimestampType(),
    "SMALLINT": T.ShortType(), "INT": T.IntegerType(), "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
}


def _struct(columns: str) -> T.StructType:
    """Flat "name TYPE" lists as a schema; unlike ``fromDDL`` it needs no session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _SQL_TYPES[kind]) for name, kind in pairs])


APPLICATION_SCHEMA = _struct(APPLICATION_DDL)
CDC_SOURCE_SCHEMA = _struct(CDC_SOURCE_DDL)
BROKER_RECORD_SCHEMA = _struct(BROKER_RECORD_DDL)
BKI_SCHEMA = _struct(BKI_DDL)
BALANCE_SCHEMA = _struct(BALANCE_DDL)

# One element of a lookup answer: a credit with one of its monthly balances.
CREDIT_SCHEMA = T.StructType(
    BKI_SCHEMA.fields + [f for f in BALANCE_SCHEMA.fields if f.name != "reco_bureau_id"]
)
CREDIT_COLUMNS = CREDIT_SCHEMA.fieldNames()

APPLICATION_COLUMNS = APPLICATION_SCHEMA.fieldNames()
APPLICATION_NUMERIC_TEXT = [
    f.name
    for f in APPLICATION_SCHEMA
    if isinstance(f.dataType, T.StringType) and f.name not in APPLICATION_CATEGORIES
]

CDC_PAYLOAD_SCHEMA = (
    T.StructType()
    .add("before", T.StringType())
    .add("after", APPLICATION_SCHEMA)
    .add("source", CDC_SOURCE_SCHEMA)
    .add("op", T.StringType())
    .add("ts_ms", T.LongType())
    .add("ts_us", T.LongType())
    .add("ts_ns", T.LongType())
    .add("transaction", T.StringType())
)

_PRIMITIVES = frozenset(
    "string integer long short byte double float boolean timestamp date binary".split()
)


def _strict(node) -> dict | str:
    """Spell a lenient description the way Spark's own JSON schema reader wants it."""
    kind = node.get("type") if isinstance(node, dict) else node
    if isinstance(node, dict) and kind == "struct":
        return {
            "type": "struct",
            "fields": [
                {
                    "name": f["name"],
                    "type": _strict(f["type"]),
                    "nullable": f.get("nullable", True),
                    "metadata": {},
                }
                for f in node.get("fields", ())
            ],
        }
    if isinstance(node, dict) and kind == "array":
        return {"type": "array", "elementType": _strict(node["elementType"]), "containsNull": True}
    if isinstance(node, dict) and kind == "map":
        key = node["keyType"]
        return {
            "type": "map",
            "keyType": _strict(key) if isinstance(key, str) else "string",
            "valueType": _strict(node["valueType"]),
            "valueContainsNull": True,
        }
    token = str(kind).lower()
    return token if token in _PRIMITIVES else "string"


def schema_from_description(description: dict | str) -> T.DataType:
    """Spark type of a JSON description.

    Type names match without regard to case, fields are nullable unless they say
    otherwise, and names Spark does not know (decimals among them) become strings.
    """
    strict = _strict(description)
    if isinstance(strict, dict) and strict["type"] == "struct":
        return T.StructType.fromJson(strict)
    wrapped = {"type": "struct", "fields": [
        {"name": "root", "type": strict, "nullable": True, "metadata": {}}]}
    return T.StructType.fromJson(wrapped)["root"].dataType


def load_schema(spark: SparkSession, path: str) -> T.DataType:
    """``schema_from_description`` of a small JSON file on any file system Spark reads."""
    text = spark.read.text(path, wholetext=True).first()
    if text is None:
        raise ValueError(f"empty schema file: {path}")
    return schema_from_description(json.loads(text.value))
