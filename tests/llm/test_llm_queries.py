"""The registered queries on the smallest tables: against SQL, or for their contract."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from tallyhouse.llm.queries import QUERIES, STATEMENTS

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_token_files": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op4_quality": {"doc_id", "expected_grade", "tail", "kept"},
    "op7_html_text": {"page_id", "url", "text", "n_chars"},
    "op9_packing": {"doc_id", "start", "size", "bin_id", "bin_length", "place"},
    "op10_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op11_whitening": {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"},
    "op12_spelling": {"word", "n", "n_near", "form", "form_n", "root"},
    "op13_language": {"doc_id", "held_out", "lang_pred", "score"},
}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in ("documents", "pages", "embeddings"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


def content(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(repr(r[i]) for i in order) for r in rows)


def test_all_operators_and_the_pipeline_are_registered():
    registered = entry_points.queries()
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) <= set(registered) and registered["pipeline"] is corpus_pipeline.run
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact dedup", "n-gram Jaccard join", "mixing sources to target weights", "best-fit packing",
    ]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    result = QUERIES[name](spark, FOLDER)
    rows = [tuple(r) for r in result.collect()]
    assert rows
    if name in STATEMENTS:
        wanted = db.sql(STATEMENTS[name])
        assert content(result.columns, rows) == content(wanted.columns, wanted.fetchall())
    else:
        assert COLUMNS[name] <= set(result.columns)


def test_one_row_per_document(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    for name in ("op1_token_files", "op4_quality", "op10_toxicity", "op13_language"):
        assert QUERIES[name](spark, FOLDER).count() == documents


def test_mix_runs_its_curriculum(spark):
    """What the query returns needs the inverted schedules and the order by position."""
    plan = QUERIES["op8_mixing"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "SQRT" in plan.upper() and "transform(" in plan and "RepartitionByExpression [first_position" in plan


def test_one_of_repeated_rows_stays(spark, tmp_path):
    rows = [(1, "a b"), (1, "a b"), (2, "ab"), (None, "c"), (None, "c"), (None, None), (3, " ")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op6_exact_dedup"](spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"] or 0, r["kept"]) for r in got) == [(0, False), (0, False), (0, True), (1, False), (1, True), (2, False), (3, True)]
