"""Every stage of the pipeline on hard rows: nulls, blanks, repeats, long texts, clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import LONG, PASSAGE, ROWS, SCHEMA

INNER = (
    "node", "kept_node", "kept_id", "times", "pii_count", "pii_digest", "pii_digest_map", "size", "words", "component",
    "path", "run", "score", "predicted", "part", "local", "ids", "item_id", "text_", "toxic", "bucket", "marks",
)
LEAK = "Seven grey herons stood beside the frozen canal while two boys counted the barges that never came back."


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sf"))
    rows = [*ROWS, (20, f"It began so. {LEAK} Then it ended.", "en", "a", 1), (21, "Frau Eva Maier, eva@maier.example.org", "de", "a", 5)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("own") for c in INNER})
    docs.repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, LEAK), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    labels = [(4, 1, 0), (5, 1, 0), (6, None, 0), (7, 0, None), (None, 1, 1), (99, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


def test_every_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns, name
        left[name] = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=str)
        assert all(r["node"] == "own" for r in docs.select("node").collect())
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    # No text is labelled toxic here, so none goes.
    assert len(left["toxicity"]) == len(ROWS) + 2
    # Text 4 is there twice, and 5 is a near copy of it; blanks are no copies of each other.
    assert [d for d, _ in left["near_duplicates"]].count(4) == 1
    assert {d for d, _ in left["near_duplicates"]} == {1, 2, 3, 4, 6, 7, 8, 20, 21, None}
    assert {d for d, _ in left["decontamination"]} == {1, 2, 3, 4, 6, 7, 8, 21, None}
    texts = dict(left["personal_data"])
    assert set(texts) == {1, 2, 3, 4, 6, 7, 8, 21, None}
    assert texts[1] is None and texts[2] == "" and texts[6] == LONG and texts[4].startswith(PASSAGE)
    assert "Weber" not in texts[7].split("and")[0] and "eva@maier" not in texts[21]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {p["doc_id"] for p in pieces} == set(texts)
    assert sum(p["length"] for p in pieces if p["doc_id"] == 1) == 1


def test_run_is_its_stages(spark, folder):
    pieces = corpus_pipeline.run(spark, folder)
    assert {p["doc_id"] for p in pieces.collect()} == {1, 2, 3, 4, 6, 7, 8, 21, None}


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
