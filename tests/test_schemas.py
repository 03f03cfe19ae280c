from collections import Counter

import pytest
from pyspark.sql import types as T

from lendspark.sources import schemas


def test_application_schema_counts():
    kinds = Counter(f.dataType.simpleString() for f in schemas.APPLICATION_SCHEMA)
    assert kinds == {"string": 81, "smallint": 36, "int": 3, "bigint": 1, "double": 1}
    assert len(set(schemas.APPLICATION_COLUMNS)) == 122
    assert set(schemas.APPLICATION_CATEGORIES) < set(schemas.APPLICATION_COLUMNS)


def test_credit_schema_is_nineteen_fields():
    assert len(schemas.CREDIT_SCHEMA) == 19
    assert schemas.CREDIT_COLUMNS[-2:] == ["months_balance", "stat_for_bureau"]


@pytest.mark.parametrize(
    ("token", "expected"),
    [
        ("LONG", T.LongType()), ("Short", T.ShortType()), ("binary", T.BinaryType()),
        ("decimal(10,2)", T.StringType()), ("interval", T.StringType()), (None, T.StringType()),
    ],
)
def test_primitive_tokens(token, expected):
    assert schemas.schema_from_description(token) == expected
    assert schemas.schema_from_description({"type": token}) == expected


def test_nested_description():
    got = schemas.schema_from_description({
        "type": "struct",
        "fields": [
            {"name": "id", "type": "long", "nullable": False},
            {"name": "tags", "type": {"type": "array", "elementType": "string"}},
            {"name": "sizes", "type": {"type": "map", "keyType": "string", "valueType": {"type": "array", "elementType": {"type": "Integer"}}}},
            {"name": "inner", "type": {"type": "struct", "fields": [{"name": "x", "type": "date"}]}},
            {"name": "empty", "type": {"type": "struct"}},
            {"name": "money", "type": "decimal"},
        ],
    })
    assert got == (
        T.StructType()
        .add("id", T.LongType(), False)
        .add("tags", T.ArrayType(T.StringType()))
        .add("sizes", T.MapType(T.StringType(), T.ArrayType(T.IntegerType())))
        .add("inner", T.StructType().add("x", T.DateType()))
        .add("empty", T.StructType())
        .add("money", T.StringType())
    )


def test_load_schema(spark, tmp_path):
    path = tmp_path / "schema.json"
    path.write_text('{"type": "struct",\n "fields": [{"name": "a", "type": "double"}]}')
    assert schemas.load_schema(spark, str(path)) == T.StructType().add("a", T.DoubleType())
