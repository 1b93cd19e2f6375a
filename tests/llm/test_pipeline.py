"""The pipeline's stages against the operators' definitions, and the registration."""

import re

import corpus_pipeline
from corpus_rows import SF

import __spark_entry__


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and {f"op{n}_" for n in range(1, 14)} == {
        m[0] for x in names if (m := re.match(r"op\d+_", x))}


def test_stages_over_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [re.findall(r"[^\W_]+", r["text"].lower()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    out = corpus_pipeline.run(spark, SF).collect()
    kept = [r["doc_id"] for r in out]
    assert len(kept) == len(set(kept)) and 0.5 * len(texts) < len(kept) < len(texts)
    assert all(r["round_trip"] for r in out)
    found = [" ".join(re.findall(r"[^\W_]+", texts[i].lower())) for i in kept]
    assert not [1 for b in bench for t in found if " ".join(b) in t]
    whole = [t.lower().split() for t in (texts[i] for i in kept)]
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in whole]
    assert not [1 for i, a in enumerate(sets) for b in sets[:i] if 100 * len(a & b) >= 80 * len(a | b)]
