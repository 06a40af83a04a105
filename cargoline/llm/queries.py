"""The registered training-data queries: one per operator, over its whole table."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargoline.llm.common import read_table, remainder
from cargoline.llm.sql import ORACLE_SQL  # noqa: F401


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cargoline.llm.language_id import identify_languages, train_language_model

    docs = read_table(spark, sf_dir, "documents")
    model = train_language_model(docs.where(remainder("doc_id", 3) != 1))
    out = identify_languages(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cargoline.llm.decontaminate import contamination

    out = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from cargoline.llm.token_counts import count_tokens

    out = count_tokens(read_table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.drop("text")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cargoline.llm.suffix_dedup import remove_repeats

    out = remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from cargoline.llm.packing import pack_best_fit, token_pieces

    pieces = token_pieces(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pack_best_fit(pieces)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cargoline.llm.sharding import shard_rows

    text = F.coalesce("text", F.lit(""))
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return shard_rows(docs, 40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cargoline.llm.syncmers import fingerprint_edits

    return fingerprint_edits(read_table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cargoline.llm.line_dedup import dedup_lines

    out = dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cargoline.llm.jaccard_join import jaccard_components

    return jaccard_components(read_table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cargoline.llm.toxicity import OPERATING_POINT, score_toxicity, train_toxicity

    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2)
    model = train_toxicity(docs, labels, lang_col="lang")
    out = score_toxicity(docs.select("doc_id", "text", "lang"), model, lang_col="lang")
    return out.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score",
                      (F.col("score") >= OPERATING_POINT).cast("int").alias("predicted"), "threshold", "toxic")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cargoline.llm.collocations import collocations

    return collocations(read_table(spark, sf_dir, "documents"), max_words=3, min_count=10, share=50, top=2000).drop("words")


def op12_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from cargoline.llm.harmonic import pack_harmonic

    return pack_harmonic(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=2)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cargoline.llm.vector_codes import codebooks_sha256, encode_vectors

    rows, books = encode_vectors(read_table(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4, scale=1024)
    return rows.select("vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_decontamination, op3_token_counts, op4_suffix_dedup, op5_best_fit_packing, op6_sharding, op7_fingerprints,
    op8_line_dedup, op9_jaccard_join, op10_toxicity, op11_collocations, op12_harmonic_packing, op13_vector_codes)}
