"""The pipeline against plain Python, stage by stage."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

import corpus_pipeline as pipeline  # noqa: E402
from segmint.llm import secrets  # noqa: E402
from segmint.llm.common import DOC_COLUMNS, stage  # noqa: E402
from segmint.llm.decontaminate import words_of  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
def test_stages_on_their_own_inputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, tables = docs, {}
    for name, step in pipeline.STAGES:
        docs = stage(step(spark, docs, SF), name)
        tables[name] = {r.doc_id: r for r in docs.collect()}
        assert tuple(docs.columns)[: len(DOC_COLUMNS)] == DOC_COLUMNS
    start = {r.doc_id: r for r in before.collect()}
    assert tables["language"] == {i: r for i, r in start.items() if any(map(str.isalpha, r.text))}
    groups = brute.near_groups([(i, r.text) for i, r in tables["language"].items()])
    assert tables["near_copies"] == {i: r for i, r in tables["language"].items() if groups[i][0] == i}
    items = [" " + " ".join(words_of(r.text)) + " " for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {
        i: r for i, r in tables["near_copies"].items()
        if not any(u in " " + " ".join(words_of(r.text)) + " " for u in items)
    }
    assert tables["benchmark"] == clean
    assert tables["secrets"].keys() == clean.keys()
    for i, row in tables["secrets"].items():
        found = secrets.find_secrets(clean[i].text)
        assert (row.text == clean[i].text) == (not found) and row.n_chars == len(row.text)
        assert not [s for s in secrets.find_secrets(row.text) if s[0] != "assign"]
    import sentencepiece

    from segmint.llm.queries import tokenizer_path

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    for i, row in tables["pieces"].items():
        assert list(row.ids) == library.encode(tables["secrets"][i].text) and row.n_tokens == len(row.ids)
    assert tables["pieces"].keys() == clean.keys()


def test_stages_take_edge_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "one two three four five six", "en", "s", 27), (4, "le la les un de des que", "fr", "s", 22),
            (4, "le la les un de des que", "fr", "s", 22)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for frame in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        wide = frame.withColumn("spans", frame.doc_id).withColumn("score", frame.doc_id)
        for name, step in pipeline.STAGES:
            out = step(spark, wide, SF if os.path.exists(SF) else "")
            assert tuple(out.columns)[:5] == DOC_COLUMNS
            assert out.count() == (0 if not wide.count() else {"language": 3, "near_copies": 4}.get(name, 5))
