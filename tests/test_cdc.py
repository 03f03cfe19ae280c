import json
from datetime import datetime

from pyspark.sql import functions as F

from lendspark.operators import cdc
from lendspark.sources.schemas import BROKER_RECORD_SCHEMA
from tests.oracle import plan_text


def event(op, image, ts_ms=1, wrapped=True, **more):
    body = {
        "before": None, "after": image, "op": op, "ts_ms": ts_ms,
        "source": {"db": "bank", "schema": "public", "table": "applications"}, **more,
    }
    return json.dumps({"payload": body} if wrapped else body)


def records(spark, values, keys=None):
    at = datetime(2025, 10, 8, 12)
    keys = keys or ['{"reco_id_curr":1}'] * len(values)
    rows = [
        (k.encode() if k else None, v.encode() if v is not None else None, "t", 0, i, at)
        for i, (k, v) in enumerate(zip(keys, values))
    ]
    return spark.createDataFrame(rows, BROKER_RECORD_SCHEMA)


def test_parse_edge_rows(spark):
    image = {"reco_id_curr": 7, "target": 1, "income": "12.50"}
    values = [
        event("c", image),
        event("r", image, wrapped=False),
        event("u", {**image, "target": "many"}),
        event("d", None, before={"reco_id_curr": 7}),
        "{not json",
        None,
        event("x", image),
        event("c", {**image, "gender": {"nested": [1, 2]}}),
        json.dumps({"schema": {"any": 1}, "payload": json.loads(event("c", image))["payload"]}),
    ]
    parsed = cdc.parse_events(records(spark, values))
    assert len(parsed.columns) == 132
    got = {r.kafka_offset: r for r in parsed.collect()}
    assert len(got) == len(values)
    assert (got[0].reco_id_curr, got[0].target, got[0].income) == (7, 1, "12.50")
    assert (got[1].reco_id_curr, got[1].cdc_operation, got[1].source_table) == (7, "r", "applications")
    assert (got[2].reco_id_curr, got[2].target) == (7, None)
    assert (got[3].reco_id_curr, got[3].cdc_operation) == (None, "d")
    assert got[4].cdc_operation is None and got[5].cdc_operation is None
    assert got[7].gender == '{"nested":[1,2]}'
    assert got[8].reco_id_curr == 7
    kept = {r.kafka_offset for r in cdc.keep_row_events(parsed).collect()}
    assert kept == {0, 1, 2, 7, 8}


def test_filter_does_not_parse_twice(spark):
    kept = cdc.keep_row_events(cdc.parse_events(records(spark, [event("c", {"reco_id_curr": 1})])))
    plan = plan_text(kept)
    assert plan.count("from_json(") == 1
    assert "EvalPython" not in plan


def test_current_state(spark):
    def key(i):
        return f'{{"reco_id_curr":{i}}}'

    rows = [
        (key(1), event("c", {"reco_id_curr": 1, "income": "1"}, 10)),
        (key(1), event("u", {"reco_id_curr": 1, "income": "2"}, 20)),
        (key(1), event("u", {"reco_id_curr": 1, "income": "3"}, 20)),  # same time, later offset
        (key(2), event("c", {"reco_id_curr": 2, "income": "9"}, 10)),
        (key(2), event("d", None, 30)),
        (key(3), event("d", None, 5)),
        (key(3), event("c", {"reco_id_curr": 3, "income": "4"}, 6)),
        (key(3), "broken"),
    ]
    parsed = cdc.parse_events(records(spark, [v for _, v in rows], [k for k, _ in rows]))
    state = {r.reco_id_curr: r.income for r in cdc.current_state(parsed).collect()}
    assert state == {1: "3", 3: "4"}
    landed = cdc.current_state(cdc.keep_row_events(parsed), F.col("reco_id_curr"))
    assert {r.reco_id_curr for r in landed.collect()} == {1, 2, 3}


def test_current_state_with_any_key(spark):
    wrapped = '{"schema":{},"payload":{"reco_id_curr":2}}'
    rows = [
        (None, event("c", {"reco_id_curr": 1, "income": "1"}, 10)),
        ('{"reco_id_curr":1}', event("u", {"reco_id_curr": 1, "income": "2"}, 20)),
        (wrapped, event("c", {"reco_id_curr": 2, "income": "3"}, 10)),
        (wrapped, event("u", {"reco_id_curr": 2, "income": "4"}, 20)),
        ('{"payload":{"reco_id_curr":3}}', event("c", {"reco_id_curr": 3, "income": "5"}, 10)),
        ('{"payload":{"reco_id_curr":3}}', event("d", None, 20)),
        (None, event("c", {"income": "6"}, 10)),
        (None, event("c", {"income": "6"}, 10)),
        (None, event("d", None, 99)),
        ("not json", event("c", {"reco_id_curr": 4, "income": "7"}, 10)),
    ]
    parsed = cdc.parse_events(records(spark, [v for _, v in rows], [k for k, _ in rows]))
    state = sorted((r.reco_id_curr or 0, r.income) for r in cdc.current_state(parsed).collect())
    assert state == [(0, "6"), (0, "6"), (1, "2"), (2, "4"), (4, "7")]


def test_typed_cast_keeps_categories(spark):
    image = {"reco_id_curr": 1, "income": "10.5", "loan_body": "n/a", "gender": "F"}
    row = cdc.typed_applications(cdc.parse_events(records(spark, [event("c", image)]))).first()
    assert (row.income, row.loan_body, row.gender) == (10.5, None, "F")


def test_heads_are_those_of_the_whole_parse(spark):
    flat = json.dumps({"op": "u", "ts_ms": 3, "after": {"reco_id_curr": 4, "target": "many"}, "source": {"db": "b", "table": 5}})
    wrapped = json.dumps({"payload": {"op": "c", "ts_ms": "x", "after": {"reco_id_curr": 5, "income": {"a": 1}}}, "op": "d"})
    texts = [flat, wrapped, flat[:-1], '{"payload": null, "op": "r"}', '{"payload": 1, "op": "r"}', '{"op": "d", "after": [1]}',
             '{"op": "u", "after": {"target": "\\q", "reco_id_curr": 6}}', '{"op": "c", "after": {"reco_id_curr": "7"}}', "", "[]", None]
    broker = records(spark, texts)
    carried = cdc.with_heads(broker)
    whole = cdc.parse_events(broker).select("reco_id_curr", *cdc.EVENT_COLUMNS)
    found = cdc.heads(carried).orderBy("kafka_offset").collect()
    assert found == whole.orderBy("kafka_offset").collect()
    assert [r.cdc_operation for r in found[:5]] == ["u", "c", None, "r", "r"] and found[1].reco_id_curr == 5
    assert carried.select(*broker.columns).orderBy("offset").collect() == broker.orderBy("offset").collect()
