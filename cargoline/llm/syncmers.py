"""Document fingerprints from closed syncmers of words, and of code points in short texts.

A window of K units is an anchor where the smallest hash among its inner S-unit strings
is the first or the last of them.  Whether a window is chosen depends on its own units
alone, so an edit disturbs only the anchors that overlap it.  Units are words between
white space; code points of scripts written without blanks, and of words of more than 16
code points, are units of their own.  Texts of few units have windows of code points as
well: all of them up to ``FEW`` units, and a share, falling to none at ``MANY`` units, of
those with the smallest hashes, so that texts a little shorter or longer stay alike.
Only DataFrame functions are used.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K, S = 6, 2
#: windows of code points, and the units of a text from which they thin out and are not taken
CHAR_K, CHAR_S, FEW, MANY = 4, 2, 16, 64
_FIRST_ID = -(1 << 63)
_WHITE = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Thai to Myanmar, Khmer, CJK and kana: written without blanks
_DENSE = r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\uff66-\uff9f\x{20000}-\x{3ffff}"
_WORD = r"(?<![^{w}])(?:[!-~]{{1,16}}|[^{w}{d}]{{1,16}})(?![^{w}])".format(w=_WHITE, d=_DENSE)
_UNIT = rf"{_WORD}|[^{_WHITE}]"


def unit_hashes(text):
    """Hashes of the units of a text (NULL, empty and blank texts have none)."""
    units = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_UNIT), F.lit(0))
    return F.transform(units, lambda w: F.xxhash64(w))


def char_hashes(text):
    """Hashes of the code points of a text, a run of white space as one blank."""
    points = F.regexp_extract_all(F.trim(F.regexp_replace(text, f"[{_WHITE}]+", " ")), F.lit("(?s)."), F.lit(0))
    return F.transform(points, lambda c: F.xxhash64(c))


def _with_syncmers(df: DataFrame, hashes: str, out: str, k: int, s: int, *seed) -> DataFrame:
    """``df`` with the hashes of the closed syncmers of the array ``hashes`` in ``out`` (NULL below ``k``)."""
    h, strings = F.col(hashes), F.col("__s")
    n, inner = F.size(h), k - s
    string = (lambda x, i: F.xxhash64(x, F.get(h, i + 1))) if s == 2 else (lambda x, i: F.xxhash64(F.slice(h, i + 1, s)))
    smallest_at_edge = lambda i: F.array_min(F.slice(strings, i + 1, inner + 1)) == F.least(F.get(strings, i), F.get(strings, i + inner))
    places = F.when(n >= k, F.filter(F.sequence(F.lit(0), n - k), smallest_at_edge))
    return (
        df.withColumn("__s", F.transform(F.slice(h, 1, F.greatest(n - s + 1, F.lit(0))), string))
        .withColumn(out, F.transform(places, lambda i: F.hash(*seed, F.slice(h, i + 1, k))))
        .drop("__s")
    )


def with_anchors(df: DataFrame, text_col: str, out: str, k: int = K, s: int = S) -> DataFrame:
    """``df`` with the anchors of ``text_col`` (32-bit hashes) in ``out``: those of units, then
    those of code points, each in the order of their places.

    A text of units without an anchor, as those of fewer than ``CHAR_K`` code points are,
    has one: the hash of all its units.  A text without units has none.
    """
    n, nothing = F.size("__h"), F.array().cast("array<int>")
    share = F.least(F.lit(1.0), (F.lit(MANY) - n) / F.lit(float(MANY - FEW)))
    df = _with_syncmers(df.withColumn("__h", unit_hashes(F.col(text_col))), "__h", "__a", k, s)
    df = df.withColumn("__c", F.when((n > 0) & (n < MANY), char_hashes(F.col(text_col))))
    df = _with_syncmers(df, "__c", "__b", CHAR_K, CHAR_S, F.lit("code points"))
    thin = F.filter("__b", lambda a: F.pmod(a, F.lit(1 << 16)) < share * F.lit(1 << 16))
    df = df.withColumn("__a", F.concat(F.coalesce("__a", nothing), F.coalesce(thin, nothing)))
    return (
        df.withColumn(out, F.when(F.size("__a") > 0, F.col("__a")).when(n > 0, F.array(F.hash("__h"))).otherwise(nothing))
        .drop("__h", "__a", "__c", "__b")
    )


def fingerprint(anchors):
    """The anchors as text, eight hex digits each, in their order."""
    return F.lower(F.array_join(F.transform(anchors, lambda a: F.lpad(F.hex(a.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), ""))


def likeness(a, b):
    """Shared part of two texts' distinct anchors, 0 to 1 (1 where neither has any).

    Places, order and repeats of the anchors do not count.
    """
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_range: int = 2048, max_ranges: int = 8192):
    """(frame, window): rows (doc_id, text, tail) in ranges of the id, and the window in which
    the next row is the next document by id; after the last document the first one comes.

    The ranges come from approximate quantiles of the ids (at most ``max_ranges``
    numbers).  The first document of a range is repeated at the tail of the range before
    it, so that each range can be read alone; drop rows where ``tail`` is 1 in the end.
    A NULL id comes first; equal ids are ordered by a hash of their text.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_FIRST_ID))
    ids = docs.select(key.alias("key"))
    n = max(1, min(max_ranges, math.ceil(ids.count() / rows_per_range)))
    bounds: list[int] = []
    if n > 1:
        cuts = ids.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 100 * n).alias("c")).first()["c"]
        bounds = sorted(set(cuts or []))
    known = F.lit(bounds) if bounds else F.array().cast("array<bigint>")
    number = F.size(F.filter(known.cast("array<bigint>"), lambda b: b <= F.col("key")))
    firsts = {r["range"]: r["first"] for r in ids.groupBy(number.alias("range")).agg(F.min("key").alias("first")).collect()}
    order = sorted(firsts)
    edge = [f"struct({r} as range, {firsts[r]}L as first, {order[i - 1]} as before)" if firsts[r] != _FIRST_ID
            else f"struct({r} as range, cast('{_FIRST_ID}' as bigint) as first, {order[i - 1]} as before)" for i, r in enumerate(order)]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"), key.alias("key")).withColumn("range", number)
    if edge:
        edges = docs.sparkSession.range(1).select(F.explode(F.expr(f"array({', '.join(edge)})")).alias("e")).select("e.*")
        rows = rows.join(F.broadcast(edges), "range")
        at = F.array(F.struct("range", F.lit(0).alias("tail")))
        twice = F.concat(at, F.array(F.struct(F.col("before").alias("range"), F.lit(1).alias("tail"))))
        rows = rows.withColumn("at", F.explode(F.when(F.col("key") == F.col("first"), twice).otherwise(at)))
        rows = rows.select("doc_id", "key", "text", F.col("at.range").alias("range"), F.col("at.tail").alias("tail"))
    else:
        rows = rows.withColumn("tail", F.lit(0))
    return rows, Window.partitionBy("range").orderBy("tail", "key", F.xxhash64("text"))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, s: int = S, **ranges) -> DataFrame:
    """Fingerprints of all texts and of their edits, one row per document.

    The edit replaces the last half of the code points by as many from the start of the
    next document.  NULL counts as empty; equal texts have equal fingerprints.
    """
    rows, window = with_next(docs, id_col, text_col, **ranges)
    rows = rows.withColumn("next_text", F.lead("text").over(window))
    rows = with_anchors(rows, "text", "own", k, s)
    rows = rows.withColumn("next_own", F.lead("own").over(window)).where("tail = 0")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half)))
    rows = with_anchors(rows, "edited", "edited_own", k, s)
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("edited_own")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("edited_own")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"))
