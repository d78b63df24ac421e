"""The pipeline against plain versions of its stages, on whole small tables and on odd rows."""

import collections

import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from devsignals.llm import decontamination, language_id, queries
from test_operators import plain_components, plain_fingerprint


def test_run_against_plain_stages(spark, data):
    got = {r.doc_id: r for r in pipeline.run(spark, data).collect()}
    docs = spark.read.parquet(f"{data}/documents.parquet")
    # language: the operator is tested on its own; here its verdicts are applied by hand
    verdict = {r.doc_id: r for r in language_id.query(docs).collect()}
    table = {r.doc_id: r for r in docs.collect() if verdict[r.doc_id].lang_pred != "und" and verdict[r.doc_id].score >= 0.5}
    # lines
    form = lambda x: " ".join(x.lower().split(" ")).strip()
    pages, held = collections.Counter(r.source for r in table.values()), collections.Counter()
    for r in table.values():
        held.update({(r.source, form(x)) for x in r.text.split("\n")})
    drop = {k for k, n in held.items() if n >= 5 and n / pages[k[0]] > 0.1 and k[1]}
    text = {d: "\n".join(x for x in r.text.split("\n") if (r.source, form(x)) not in drop) for d, r in table.items()}
    # near-duplicates
    component = plain_components({d: plain_fingerprint(t) for d, t in text.items()})
    text = {d: t for d, t in text.items() if component[d] == d}
    # contamination
    items = spark.read.parquet(f"{data}/benchmark.parquet")
    left = spark.createDataFrame(list(text.items()), "doc_id long, text string")
    leaked = {r.doc_id for r in decontamination.query(left, items).collect()}
    text = {d: t for d, t in text.items() if d not in leaked}
    assert {d: r.text for d, r in got.items()} == text
    model = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    for d, r in got.items():
        assert r.ids == model.encode(text[d]) and r.decoded == model.decode(r.ids) and r.n_tokens == len(r.ids)
        assert (r.lang, r.source) == (table[d].lang, table[d].source)


def test_stages_keep_the_columns(spark, data, odd):
    docs = odd
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, data)
        assert out.columns == docs.columns, name
        docs = out
    assert pipeline.STAGES[-1][1](spark, docs, data).count() == docs.count()
    empty = odd.limit(0)
    assert all(stage(spark, empty, data).count() == 0 for _, stage in pipeline.STAGES)


def test_one_row_of_repeated_rows_stays(spark, data):
    docs = spark.createDataFrame([(1, "the same words in every row of this table", "en", "s", 1)] * 30,
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert pipeline.dedup_documents(spark, docs, data).count() == 1
    assert pipeline.dedup_documents(spark, docs.withColumn("doc_id", F.lit(None).cast("long")), data).count() == 1
