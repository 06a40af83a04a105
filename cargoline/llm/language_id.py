"""Language ID by compression: the language whose dictionary compresses a text best.

Each language has one zstandard raw-content dictionary of a fixed size, learned from all its
labelled texts: excerpts of some different texts, then the words that are most frequent in
all whole texts.  A text is cut into blocks of ``block_bytes``, every block is compressed
under every dictionary, and the sizes are summed over the whole text; the smallest total
wins.  A text is rejected where no letter is found or where its margin is narrow: the bytes
that the runner-up needs more, over the bytes of the best.  How narrow is calibrated when
the dictionaries are made: every labelled text is scored under dictionaries that were made
without it, and the limit loses at most ``max_loss`` of those of any language that were told
rightly.  Texts of unlearned languages and letters without language compress about alike
under every dictionary and fall below it.
"""
from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cargoline.llm.common import per_worker

UNDETERMINED = "und"
_PADDING = bytes(64)
_LAST = (1 << 63) - 1
_OTHER = re.compile(r"[\W\d_]+")
#: lower-case ASCII letters and the bytes of other characters stay, all else is a blank
_BLANKED = bytes(c if c > 127 or 97 <= c <= 122 else 32 for c in range(256))
#: Thai to Myanmar, Khmer, CJK and kana: written without blanks, counted by pairs of code points as long words are
_BLANKLESS = re.compile(r"[฀-໿က-႟ក-៿⺀-鿿豈-﫿ｦ-ﾟ\U00020000-\U0003ffff]")
_LONG_WORD = 32
#: a task that counts words passes its counts on at so many different words, and after so many characters
COUNTED_WORDS, COUNTED_CHARS = 200_000, 1 << 25
#: texts are dealt to so many folds by a hash; each is scored under what the others taught
FOLDS = 4
#: margins are counted in steps of this share of the compressed size
MARGIN_STEP = 2.0 ** -16
RESULT = "lang_pred string, score double, margin double, rejected boolean"


def words_of(text: str) -> list[bytes]:
    """The runs of letters, in lower case."""
    text = text.lower()
    if not text.isascii():
        odd = [c for c in set(text) if c > "\x7f" and _OTHER.match(c)]
        if len(odd) > 16:
            text = _OTHER.sub(" ", text)
        else:
            for c in odd:
                text = text.replace(c, " ")
    return text.encode("utf-8", "replace").translate(_BLANKED).split()


def plain(text: str) -> bytes:
    """Lower case, with every run of other characters than letters as one blank."""
    return b" ".join(words_of(text))


@dataclass(frozen=True)
class LanguageModel:
    """Per-language dictionaries (a few hundred kB in all) and the decision's parameters.

    The dictionaries stand in the order that breaks ties: most frequent language first.
    """

    dictionaries: dict[str, bytes]
    level: int = 9
    block_bytes: int = 2048
    #: blocks below ``short_bytes`` are padded, or the compressor would store them as they are
    short_bytes: int = 256
    #: rejected where (second best - best) bytes < min_margin * best bytes; ties always are
    min_margin: float = 0.0
    #: bits of advantage are scaled by this before the soft maximum
    temperature: float = 0.05

    def compressors(self) -> dict:
        # one set in a worker: a task's own would stay until the worker collects its cycles
        held = per_worker(("language compressors",), dict)
        key = (self.level, *self.dictionaries.items())
        if held.get("key") != key:
            import zstandard as zstd

            ready = {}

            params = zstd.ZstdCompressionParameters.from_level(
                self.level, min_match=3, write_content_size=False, write_checksum=False, write_dict_id=False)
            for lang, raw in self.dictionaries.items():
                content = zstd.ZstdCompressionDict(raw, dict_type=zstd.DICT_TYPE_RAWCONTENT)
                content.precompute_compress(compression_params=params)
                ready[lang] = zstd.ZstdCompressor(dict_data=content, compression_params=params).compress
            held.update(key=key, ready=ready)
        return held["ready"]

    def predict(self, text: str | None) -> tuple[str, float, float, bool]:
        """(language, score, margin over the compressed size, rejected) of one whole text.

        A model of one language has no runner-up: its margin is infinite.
        """
        return self._decided([plain(text) if text and self.dictionaries else b""])[0]

    def predict_all(self, texts: Iterable[str | None]) -> list[tuple[str, float, float, bool]]:
        """``predict`` of every text, some megabyte at a time under one language after the other,
        whose tables then stay in the processor's cache."""
        out, held, size = [], [], 0
        for text in texts:
            held.append(plain(text) if text and self.dictionaries else b"")
            size += len(held[-1])
            if size > 1 << 20:
                out += self._decided(held)
                held, size = [], 0
        return out + self._decided(held)

    def _decided(self, plains: list[bytes]) -> list[tuple[str, float, float, bool]]:
        blocks, counts = [], []
        for raw in plains:
            own = [raw[i: i + self.block_bytes] for i in range(0, len(raw), self.block_bytes)]
            if own:
                own[-1] += _PADDING * (len(own[-1]) < self.short_bytes)
            blocks += own
            counts.append(len(own))
        sizes = {lang: map(len, map(c, blocks)) for lang, c in self.compressors().items()} if blocks else {}
        totals = {lang: [sum(islice(each, n)) for n in counts] for lang, each in sizes.items()}
        out = []
        for at, n in enumerate(counts):
            if not n:
                out.append((UNDETERMINED, 0.0, 0.0, True))
                continue
            ranked = sorted((totals[lang][at], i, lang) for i, lang in enumerate(totals))
            best = ranked[0]
            margin = (ranked[1][0] - best[0]) / best[0] if len(ranked) > 1 else math.inf
            weight = sum(math.exp(min(0.0, (best[0] - x) * 8 * self.temperature)) for x, _, _ in ranked)
            out.append((best[2], 1.0 / weight, margin, margin == 0.0 or margin < self.min_margin))
        return out


def train_language_model(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
                         docs_per_lang: int = 200, chars_per_doc: int = 500, max_langs: int = 256,
                         max_loss: float = 0.005, words_per_lang: int = 3000, **options) -> LanguageModel:
    """Dictionaries from all texts of each language (NULLs are not used).

    A dictionary has two parts.  The first are excerpts of ``docs_per_lang`` texts: the
    distinct ones with the smallest hash of their content, of each at
    most ``chars_per_doc`` characters, from a place chosen by a hash of the
    text; equal excerpts count once.  They are found by one estimate of the
    distinct texts per language and one filtered scan, repeated with a wider share for
    languages that gave fewer texts than wanted, until all their texts were looked at.
    The second are the ``words_per_lang`` words that occur most often in all whole texts of
    the language (``frequent_words``), the most frequent at the end, where references are
    shortest.  Both numbers are sizes of the model; every text is counted.
    Raises where the column has more than ``max_langs`` values: it is no language label
    then.  Without labelled rows the model rejects every text.

    The margin is calibrated on all texts (``narrow_margin``) unless ``min_margin``
    is given.
    """
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("place", F.xxhash64(F.lit("language sample"), "text"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("place").alias("texts")).limit(max_langs + 1).collect()
    if len(counts) > max_langs:
        raise ValueError(f"{lang_col} has more than {max_langs} values")
    if not counts:
        return LanguageModel({}, **options)
    # keep a text with probability 2 * wanted / texts of its language, by its hash
    share = {r["lang"]: min(1.0, 2.0 * docs_per_lang / max(1, r["texts"])) for r in counts}
    start = F.pmod(F.xxhash64(F.lit("excerpt"), "text"), F.greatest(F.length("text") - chars_per_doc + 1, F.lit(1))).cast("int")
    excerpt = F.substring("text", start + 1, F.lit(chars_per_doc))
    found: dict[str, list] = {}
    while share:
        limit = F.create_map(*[F.lit(x) for lang, s in share.items() for x in (lang, min(_LAST, int(s * 2.0 ** 64) - (1 << 63)))])
        picked = (
            rows.where(F.col("place") <= limit[F.col("lang")]).select("lang", "place", excerpt.alias("text"))
            .groupBy("lang", "text").agg(F.min("place").alias("place")).collect()
        )
        for lang in share:
            found[lang] = sorted((r["place"], r["text"]) for r in picked if r["lang"] == lang)
        share = {lang: min(1.0, 4.0 * s) for lang, s in share.items() if s < 1.0 and len(found[lang]) < docs_per_lang}
    excerpts = {r["lang"]: found[r["lang"]][:docs_per_lang] for r in sorted(counts, key=lambda r: (-r["n"], r["lang"]))}
    calibrate = "min_margin" not in options
    words = frequent_words(rows, words_per_lang, calibrate)
    if calibrate:
        models = [LanguageModel(_dictionaries(excerpts, words, fold), **options) for fold in range(FOLDS)]
        options["min_margin"] = narrow_margin(rows, models, max_loss)
    return LanguageModel(_dictionaries(excerpts, words), **options)


def _dictionaries(excerpts: dict[str, list[tuple[int, str]]], words: dict[tuple[str, int], str], without: int = -1) -> dict[str, bytes]:
    """The languages' dictionaries from all folds but ``without``."""
    out = {}
    for lang, texts in excerpts.items():
        parts = plain("\n".join(t for place, t in texts if place % FOLDS != without)), words.get((lang, without), "").encode("utf-8", "replace")
        if any(parts):
            out[lang] = b" ".join(p for p in parts if p)
    return out


def _slices(text: str) -> Iterator[str]:
    """``text`` some million characters at a time, cut between words."""
    start = 0
    while start < len(text):
        gap = _OTHER.search(text, start + (1 << 20)) if len(text) - start > 1 << 20 else None
        end = gap.start() if gap else len(text)
        yield text[start:end]
        start = end


def _units(counted: Counter) -> tuple[list[bytes], list[int]]:
    """Units and their numbers: words, but pairs of code points of long words and of scripts without blanks."""
    odd = [raw for raw in counted if len(raw) > _LONG_WORD or not raw.isascii()]
    units: Counter = Counter()
    for raw in odd:
        word = raw.decode()
        if len(word) > _LONG_WORD or len(word) > 2 and _BLANKLESS.search(word):
            n = counted.pop(raw)
            for a in range(len(word) - 1):
                units[word[a: a + 2].encode()] += n
    return [*counted, *units], [*counted.values(), *units.values()]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, fold, text) -> (lang, fold, word, n); a word may come several times."""
    held: dict[tuple[str, int], Counter] = {}
    different = seen = 0

    def passed_on():
        for (lang, fold), counter in held.items():
            words, numbers = _units(counter)
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(lang, len(words)), pa.repeat(pa.scalar(fold, pa.int32()), len(words)),
                 pa.array(words, pa.binary()).cast(pa.string()), pa.array(numbers, pa.int64())], ["lang", "fold", "word", "n"])
        held.clear()

    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            for lang, fold, text in zip(*(c.to_pylist() for c in part.columns)):
                counter = held.setdefault((lang, fold), Counter())
                for piece in _slices(text):
                    different -= len(counter)
                    counter.update(words_of(piece))
                    different += len(counter)
                seen += len(text)
                if different > COUNTED_WORDS or seen > COUNTED_CHARS:
                    yield from passed_on()
                    different = seen = 0
    yield from passed_on()


def frequent_words(rows: DataFrame, most: int, by_fold: bool = True) -> dict[tuple[str, int], str]:
    """The ``most`` most frequent words of each language, ascending, joined by blanks.

    All whole texts are counted, under (lang, -1); ``by_fold`` adds (lang, fold), counted in
    the texts of the other folds.  Ties go to the smaller word.  Tasks count on their own, so
    counts and not texts are exchanged.
    """
    counted = rows.select("lang", F.pmod("place", F.lit(FOLDS)).cast("int").alias("fold"), "text").mapInArrow(
        _count_words, "lang string, fold int, word string, n long")
    folds = [F.sum(F.when(F.col("fold") == f, F.col("n")).otherwise(0)).alias(f"n{f}") for f in range(FOLDS)]
    counted = counted.groupBy("lang", "word").agg(*folds)
    total = reduce(Column.__add__, [F.col(f"n{f}") for f in range(FOLDS)])
    others = [(f, total - F.col(f"n{f}")) for f in range(FOLDS) if by_fold]
    variants = [F.struct(F.lit(f).alias("without"), n.alias("n")) for f, n in [(-1, total), *others]]
    best = Window.partitionBy("lang", "without").orderBy(F.desc("n"), "word")
    ranked = counted.select("lang", "word", F.inline(F.array(*variants))).where("n > 0").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "word")), False), lambda e: e["word"]), " ")
    return {(r["lang"], r["without"]): r["words"] for r in ranked.groupBy("lang", "without").agg(joined.alias("words")).collect()}


def narrow_margin(rows: DataFrame, models: list[LanguageModel], max_loss: float) -> float:
    """The margin that loses at most ``max_loss`` of the different texts of any language.

    Every text of ``rows`` is scored whole, by the model of its fold, which was learned
    without it.  Of the rightly told ones of a language, the margin below which ``max_loss``
    of them lie is taken, from counts by steps of ``MARGIN_STEP`` (with fewer than
    1 / max_loss of them, the smallest, so none is lost); the smallest over languages counts.
    Languages of fewer texts than folds are left out; 0.0 (ties only) where none is left.
    """
    fold = F.pmod("place", F.lit(len(models)))
    scored = [rows.where(fold == i).select("lang", "place", language_column(model, F.col("text")).alias("found"))
              for i, model in enumerate(models) if len(model.dictionaries) > 1]
    if not scored:
        return 0.0
    # a filter before the groups would run the function, and its worker, twice
    texts = reduce(DataFrame.unionAll, scored).select("lang", "place", "found.lang_pred", "found.margin").groupBy("lang", "place").agg(
        F.min(F.when(F.col("lang_pred") == F.col("lang"), F.col("margin"))).alias("margin"))
    step = F.when(F.col("margin").isNotNull(), F.floor(F.least("margin", F.lit(1.0)) / MARGIN_STEP))
    steps = texts.groupBy("lang", step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min("margin").alias("margin"))
    lang = Window.partitionBy("lang")
    steps = steps.withColumn("texts", F.sum("n").over(lang)).where(F.col("step").isNotNull())
    steps = steps.withColumn("told", F.sum("n").over(lang)).withColumn("up_to", F.sum("n").over(lang.orderBy("step")))
    kept = steps.where((F.col("texts") >= len(models)) & (F.col("up_to") > F.floor(F.col("told") * max_loss)))
    return kept.agg(F.min("margin")).first()[0] or 0.0


def language_column(model: LanguageModel, text):
    """A struct column (lang_pred, score, margin, rejected) for a text column."""

    @F.pandas_udf(RESULT)
    def identify(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(model.predict_all(texts), columns=["lang_pred", "score", "margin", "rejected"])

    return identify(text)


def identify_languages(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score, margin and rejected; input columns of those names are replaced.

    No shuffle: each text is scored where it is read.  NULL, empty and letterless texts
    get ``und``, score 0.0 and are rejected.
    """
    new = ("lang_pred", "score", "margin", "rejected")
    kept = [c for c in docs.columns if c not in new]
    scored = docs.withColumn("__lid", language_column(model, F.col(text_col)))
    return scored.select(*[F.col(f"`{c}`") for c in kept], *[F.col("__lid").getField(c).alias(c) for c in new])


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not reject, with their columns as they were."""
    return docs.where(~language_column(model, F.col(text_col)).getField("rejected"))
