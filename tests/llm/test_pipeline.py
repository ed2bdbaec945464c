"""The pipeline's stages on the smallest tables, each judged on its own input."""

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from conftest import SMALL
from orderlens.llm import decontaminate, jaccard, secrets, toxicity
from orderlens.llm.common import table


def test_stages_decide_and_keep_the_rest(spark):
    docs = table(spark, SMALL, "documents").withColumn("d", F.col("source"))
    columns = docs.columns
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())

    scores = toxicity.toxicity_scores(docs, table(spark, SMALL, "labels")).collect()
    clean = pipeline.drop_toxic(spark, docs, SMALL)
    assert clean.columns == columns
    assert ids(clean) == sorted(r["doc_id"] for r in scores if not r["predicted"])

    found = jaccard.near_duplicates(docs).collect()
    single = pipeline.drop_near_duplicates(spark, docs, SMALL)
    assert single.columns == columns
    assert ids(single) == sorted({r["component_id"] for r in found})

    bad = {r["doc_id"] for r in decontaminate.contaminated(docs, table(spark, SMALL, "benchmark")).collect()}
    left = pipeline.drop_benchmark(spark, docs, SMALL)
    assert left.columns == columns and ids(left) == sorted(set(ids(docs)) - bad)

    before = {r["doc_id"]: (r["text"], r["spans"]) for r in secrets.secret_spans(docs).collect()}
    masked = pipeline.mask_secrets(spark, docs, SMALL)
    assert masked.columns == columns and masked.count() == docs.count()
    for r in masked.collect():
        text, spans = before[r["doc_id"]]
        assert (r["text"] == text) == (not spans)
        assert r["n_chars"] == len(r["text"]) or not spans


def test_run_packs_what_the_stages_keep(spark):
    rows = pipeline.run(spark, SMALL).collect()
    assert rows and all(0 < r["length"] <= 1024 for r in rows)
    assert [n for n, _ in pipeline.STAGES] == [
        "toxicity", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "packing",
    ]
