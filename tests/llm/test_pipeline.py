"""run() against plain versions of its stages, and each stage's contract."""

import corpus_pipeline
from conftest import SF_DIR

from skyloom.llm import secrets

from .conftest import EDGES, LONG
from .test_decontaminate import plain as contaminated
from .test_near_copies import plain_kept
from .test_packing import check

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def staged_docs(spark, path, rows):
    docs = spark.createDataFrame([(i, t, g, "s", len(t or "")) for i, t, g in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{path}/documents.parquet")


def test_run_equals_plain(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    docs = {i: t for i, t in docs.items() if any(c.isalpha() for c in t or "")}
    docs = {i: docs[i] for i in plain_kept(list(docs.items()))}
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    docs = {r[0]: docs[r[0]] for r in contaminated(docs.items(), items) if not r[5]}
    found = secrets.scan(spark.createDataFrame(list(docs.items()), "doc_id long, text string"))
    texts = {r.doc_id: secrets.redact(docs[r.doc_id], [tuple(f) for f in r.findings]) for r in found.collect()}
    assert check(corpus_pipeline.run(spark, SF_DIR).collect(), texts) == 0


def test_stages_keep_columns_and_clean_rows(spark, tmp_path):
    rows = [(i, t, "en") for i, t in EDGES] + [
        (30, "item words one two three four five six seven eight", "en"),
        (31, "clean text token = 'abcdef123456' more", None),
        (32, LONG + " tail", None),
    ]
    staged_docs(spark, tmp_path, rows)
    spark.createDataFrame([(1, rows[-3][1]), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == COLUMNS
        kept[name] = docs.collect()
    assert {r.doc_id for r in kept["language"]} == {4, None, 5, 6, 7, 8, 9, 30, 31, 32} and all(r.lang for r in kept["language"])
    assert sorted(r.doc_id or 0 for r in kept["near_duplicates"]) == [0, 4, 5, 7, 8, 9, 30, 31]
    assert {r.doc_id for r in kept["decontaminate"]} == {None, 4, 5, 7, 8, 9, 31}
    (row,) = [r for r in kept["secrets"] if r.doc_id == 31]
    assert row.text == f"clean text token = '{secrets.REPLACEMENT}' more" and row.n_chars == len(row.text)


def test_empty_table(spark, tmp_path):
    staged_docs(spark, tmp_path, [])
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_are_of_the_ten(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontaminate", "secrets", "packing"]
