"""Corpus pipeline: language ID, line dedup, near duplicates, decontamination, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns
the documents it keeps (the last one the packed pieces), which are written as parquet and
reread as the next stage's ``docs``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargoline.llm.common import written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; rejected ones (no letter, narrow margin) go."""
    from cargoline.llm.language_id import keep_identified, train_language_model

    return keep_identified(docs, train_language_model(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, except from the largest doc_id that holds them; ``n_chars`` follows the text."""
    from cargoline.llm.line_dedup import dedup_lines

    kept = dedup_lines(docs)
    columns = [F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType).alias(c)
               if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    return kept.select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group linked by five-word shingles at 0.8."""
    from cargoline.llm.jaccard_join import drop_near_duplicates

    return drop_near_duplicates(docs, k=5, num=80, den=100).select(*[F.col(f"`{c}`") for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item (or a whole shorter item) go."""
    from cargoline.llm.decontaminate import drop_contaminated

    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*[F.col(f"`{c}`") for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are left, as token pieces packed into sequences of 2048."""
    import public_tokenizers

    from cargoline.llm.packing import pack_best_fit, token_pieces

    return pack_best_fit(token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("packing", packing)]
#: language ID by compression cannot be expressed in SQL; tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
