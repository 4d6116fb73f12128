"""The pipeline's stages against plain Python, and its guard."""

import hashlib
from collections import Counter

import corpus_pipeline
from linkweave.llm import queries
from linkweave.llm.common import table


def test_stages_keep_columns_and_decide(spark, sf_dir):
    from test_row_operators import base_counts, base_spans, library
    from test_tables import brute_components

    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality rules"](spark, docs, sf_dir).cache()
    assert good.columns == columns
    assert not any(base_counts(r["text"])[-1] for r in good.collect())
    one = stages["n-gram Jaccard join"](spark, good, sf_dir).cache()
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    assert one.columns == columns
    assert {r["doc_id"] for r in one.collect()} == {least for _, _, least in brute_components(rows, 80, 5)}
    clean = stages["PII"](spark, one, sf_dir).cache()
    assert clean.columns == columns and clean.count() == one.count()
    assert not any(base_spans(r["text"]) for r in clean.collect())
    mixed = stages["mixing sources to target weights"](spark, clean, sf_dir).cache()
    assert mixed.columns == columns and max(Counter(r["doc_id"] for r in mixed.collect()).values()) <= 3
    last = stages["BPE encoding and decoding"](spark, mixed, sf_dir).collect()
    ref = library()
    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    assert len(last) == mixed.count()
    for r in last:
        ids = ref.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_run_is_the_stages_in_order(spark, sf_dir):
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0


def test_every_operator_has_a_query():
    names = list(queries.queries())
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
