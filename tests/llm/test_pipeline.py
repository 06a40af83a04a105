"""run() against the brute-force stages, one after the other."""
from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from cargoline.llm.language_id import train_language_model
from test_brute_force import SF_DIR, brute_components, brute_contamination, brute_lines


def test_run(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = train_language_model(docs)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    texts = {d: t for d, t in texts.items() if not model.predict(t)[3]}
    texts = {d: t for d, (_, _, t) in brute_lines(texts).items()}
    texts = {d: texts[d] for d, (_, c) in brute_components(texts, 5, 80, 100).items() if c == d}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    texts = {d: texts[d] for d, x in brute_contamination(texts, items).items() if not x[-1]}
    assert 0 < len(texts) < docs.count()
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = set()
    for d, t in texts.items():
        ids = tok.encode(t, add_special_tokens=False).ids + [0]
        want |= {(d, i, s, len(ids[s: s + 2048]), zlib.crc32(np.array(ids[s: s + 2048], "<u4").tobytes())) for i, s in enumerate(range(0, len(ids), 2048))}
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows} == want and len(rows) == len(want)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).schema.simpleString() == docs.schema.simpleString(), name
