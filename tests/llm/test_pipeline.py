"""The pipeline's stages, and every query on empty and odd tables."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from wickframe.llm import language, simhash, toxicity

SF = "/root/testdata/sf0.01"
TABLES = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
    "pages": "page_id long, url string, html string",
    "embeddings": "vec_id long, embedding array<float>, label int",
}
QUERIES = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit() or n == "pipeline"]


def write(spark, folder, rows):
    for name, schema in TABLES.items():
        spark.createDataFrame(rows.get(name, []), schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables(spark, tmp_path, name):
    assert entry.queries()[name](spark, write(spark, tmp_path / "t", {})).count() == 0


@pytest.mark.parametrize("name", QUERIES)
def test_null_rows(spark, tmp_path, name):
    rows = {
        "documents": [(None, None, None, None, None)] * 2 + [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "One text here", None, "s", 1)],
        "labels": [(None, None, None), (1, 1, 1), (2, None, 0), (3, 0, 0), (99, 1, 1)],
        "pages": [(None, None, None), (1, None, "x"), (1, "http://a/b", None)],
        "embeddings": [(None, None, None), (1, [1.0, None], 1), (2, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)],
    }
    found = entry.queries()[name](spark, write(spark, tmp_path / "t", rows)).count()
    table = "embeddings" if name.startswith("op1_") else "pages" if name.startswith(("op6", "op8")) else "documents"
    if name.startswith("op11_"):  # one row per phrase, and none occurs ten times
        assert found == 0
    else:
        assert found == len(rows[table]) or name == "pipeline"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = corpus_pipeline.toxicity(spark, docs, SF)
    assert kept.columns == docs.columns
    score = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, toxicity.learn(docs, labels)).collect()}
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, s in score.items() if s < 0.3}
    speaks = corpus_pipeline.language(spark, kept, SF)
    assert speaks.columns == docs.columns and speaks.count() == kept.filter("text rlike '\\\\p{L}'").count()
    unique = corpus_pipeline.near_duplicates(spark, speaks, SF)
    groups = {r.component_id for r in simhash.simhash_components(speaks).collect()}
    assert unique.columns == docs.columns and {r.doc_id for r in unique.collect()} == groups
    packed = corpus_pipeline.packing(spark, unique, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == groups
    assert language.learn(speaks) is not None
    assert corpus_pipeline.run(spark, SF).count() == packed.count()
