import re

import corpus_pipeline
from basketflow.llm import secrets
from tests.conftest import SMALL
from tests.llm import test_decontaminate, test_mixing, test_secrets, test_simhash


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "benchmark", "secrets", "mixture"]


def test_equals_brute_force(spark):
    """Each decision of the run, worked out plainly from the documents."""
    docs = [r.asDict() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    docs = [d for d in docs if any(c.isalpha() for c in d["text"] or "")]
    prints = [(d["doc_id"], test_simhash.brute_print(d["text"])) for d in docs]
    docs = [d for d, c in zip(docs, test_simhash.brute(prints), strict=True) if c == d["doc_id"]]
    hits = test_decontaminate.brute([d["text"] for d in docs], items)
    docs = [d for d, h in zip(docs, hits, strict=True) if not h[1]]
    for d in docs:
        text, spans = d["text"], sorted((a, b) for a, _, b in test_secrets.brute(d["text"]))
        out, at = "", 0
        for a, b in spans:
            if a >= at:
                out += text[at:a] + "[secret]"
            at = max(at, b)
        d["text"] = out + text[at:]
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert {r["doc_id"] for r in rows} == {d["doc_id"] for d in docs} and len(rows) == len(docs)
    test_mixing.check(spark.createDataFrame([(d["doc_id"], d["text"], d["source"]) for d in docs], "doc_id long, text string, source string"), rows)


def test_stages_return_the_columns_of_documents(spark, edge, no_docs):
    for docs in (edge, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SMALL)
            assert out.columns == docs.columns, name
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()


def test_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    after = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert set(before) == set(after)
    assert all(after[i] == t for i, t in before.items() if not re.search(r"(?i)passw|secret|token|api_?key|AKIA|[0-9a-f]{16}", t or ""))


def test_documents_stay_where_no_language_can_be_learned(spark):
    folds = spark.range(50).select("id", corpus_pipeline.held_out("id").alias("out")).collect()
    aside = next(r["id"] for r in folds if r["out"])
    for labelled in (None, aside):
        rows = [(i, "12 --" if i == 3 else f"some words {i}", "en" if i == labelled else None) for i in range(50)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        out = corpus_pipeline.language(spark, docs, SMALL)
        assert out.columns == docs.columns
        assert sorted(map(tuple, out.collect())) == sorted((r for r in rows if r[0] != 3), key=lambda r: r[0])
