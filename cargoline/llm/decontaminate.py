"""Benchmark decontamination as a prefix-filtered containment join.

A benchmark item gives windows of ``window`` consecutive words (a shorter item is one
window).  A window occurs in a document only if all its words do, so one word of it is a
sufficient prefix, and the rarest word of the corpus makes the fewest candidates.  The
document's occurrences of that word, moved back by its offset in the window, are the
candidate places; places where the window would not fit are dropped at once, and the
rest are verified word by word.  Only DataFrame functions are used.
"""
from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoline.llm.common import written

#: everything but digits, a-z and code points beyond ASCII parts words (after A-Z is lowered)
_PARTING = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: the join sides below are broadcast up to so many rows, and shuffled beyond
BROADCAST_ROWS = 200_000


def item_words(text):
    """The words of a text column; a NULL has none."""
    ascii_only = F.octet_length(text) == F.length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), _PARTING), "")


def _sized(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def item_windows(benchmark: DataFrame, window: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(words, passage, items): each distinct window, as an array and as text, with the items that hold it.

    Items without words (NULL or empty text) have no window; a NULL id is the id ''.
    Repeated items count once.
    """
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), item_words(F.col(text_col)).alias("all"))
    n = F.least(F.lit(window), F.size("all"))
    places = F.transform(F.sequence(F.lit(1), F.size("all") - n + 1), lambda i: F.slice("all", i, n))
    return (
        items.where(F.size("all") > 0).select("item", F.explode(places).alias("words"))
        .groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items"))
        .withColumn("passage", F.array_join("words", " "))
    )


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, occurrences) of benchmark windows in documents.

    documents: doc_id, version (hash of the text), n_words, a row for each row of ``docs``.
    occurrences: doc_id, version, place (from 0), n (words of the window), items.
    """
    windows = written(item_windows(benchmark, window, item_id_col, item_text_col), "windows")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    words = texts.select("doc_id", "version", item_words(F.col("text")).alias("all"))

    # rarity over all documents; a window with a word that no document has cannot occur
    vocabulary = windows.select(F.explode("words").alias("word")).distinct()
    rarity = written(
        words.select(F.explode("all").alias("word")).join(_sized(vocabulary), "word").groupBy("word").agg(F.count("*").alias("uses")), "rarity")
    prefix = (
        windows.select("passage", F.size("words").alias("n"), F.posexplode("words").alias("offset", "word"))
        .join(rarity, "word").groupBy("passage", "n")
        .agg(F.count("*").alias("found"), F.min(F.struct("uses", "word", "offset")).alias("rarest"))
        .where("found = n").select(F.col("rarest.word").alias("word"), F.col("rarest.offset").alias("offset"), "n").distinct()
    )
    prefix = _sized(written(prefix, "prefix"))

    # candidate places within the length bounds, then the words that stand there
    candidates = (
        words.select("doc_id", "version", F.size("all").alias("n_words"), F.posexplode("all").alias("pos", "word"))
        .join(prefix, "word").withColumn("place", F.col("pos") - F.col("offset"))
        .where("place >= 0 and place + n <= n_words")
        .groupBy("doc_id", "version").agg(F.collect_set(F.struct("place", "n")).alias("places"))
    )
    c = candidates.select(F.col("doc_id").alias("c_id"), F.col("version").alias("c_version"), "places")
    held = texts.join(c.hint("merge"), texts["doc_id"].eqNullSafe(c["c_id"]) & (texts["version"] == c["c_version"]), "left")
    held = held.select("doc_id", "version", item_words(F.col("text")).alias("all"), "places")
    standing = F.transform("places", lambda p: F.struct(
        p["place"].alias("place"), p["n"].alias("n"), F.array_join(F.slice("all", p["place"] + 1, p["n"]), " ").alias("passage")))
    checked = written(held.select("doc_id", "version", F.size("all").cast("long").alias("n_words"), standing.alias("standing")), "candidates")
    occurrences = (
        checked.where("standing is not null").select("doc_id", "version", F.explode("standing").alias("s")).distinct()
        .select("doc_id", "version", "s.place", "s.n", "s.passage")
        .join(_sized(windows.select("passage", "items")), "passage").drop("passage")
    )
    return checked.select("doc_id", "version", "n_words"), occurrences


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, **columns) -> DataFrame:
    """One row per document: doc_id, version, n_words, n_hit, items (sorted), contaminated.

    A word is hit where it stands inside any occurrence of a window.  NULL and empty texts
    have no words and are clean; with an empty benchmark all documents are clean.
    """
    documents, occurrences = find_passages(docs, benchmark, window, **columns)
    hits = occurrences.groupBy("doc_id", "version").agg(
        F.collect_set(F.sequence("place", F.col("place") + F.col("n") - 1)).alias("runs"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    ).select(F.col("doc_id").alias("h_id"), F.col("version").alias("h_version"),
             F.size(F.array_distinct(F.flatten("runs"))).cast("long").alias("hit"), F.array_sort("items").alias("found"))
    joined = documents.join(hits, documents["doc_id"].eqNullSafe(hits["h_id"]) & (documents["version"] == hits["h_version"]), "left")
    return joined.select("doc_id", "version", "n_words", F.coalesce("hit", F.lit(0)).cast("long").alias("n_hit"),
                         F.coalesce("found", F.array().cast("array<string>")).alias("items"),
                         F.col("hit").isNotNull().alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs."""
    bad = contamination(docs, benchmark, window, id_col=id_col, text_col=text_col).where("contaminated").select(
        F.col("doc_id").alias("__id"), F.col("version").alias("__version"))
    return docs.join(bad.hint("merge"), docs[id_col].eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text_col]) == F.col("__version")), "left_anti")
