"""Phrase collocation mining: word n-grams counted by an FM-index per shard, summed across shards.

A task reads whole texts, cuts them into pieces and words and gathers them by language into
shards.  A shard is indexed in both directions over its word ids: the Burrows-Wheeler
transforms of the word sequence and of its reverse, suffixes ordered by as many words as
the longest phrase has.  From the interval of every word, extension to the left enumerates
all n-grams level by level, keeping the interval in both indexes; the two transforms give
how often an n-gram has a word before and after it.  No extension crosses a piece.

The n-grams of a shard are dealt by a hash of their words into buckets, whose number
follows the corpus, and travel as sorted, compressed Arrow batches: a few bytes an n-gram.
A task sums its buckets one by one and keeps n-grams of at least ``min_count``; every part
of a phrase is at least as frequent as the phrase, so the table that is left answers all
further questions by joins.
"""
from __future__ import annotations

import math
import zlib
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cargoline.llm.common import mix64, slices, written

#: bytes that end a piece, and bytes that part words inside one
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD_ENDS = b" \t"

_SALTS = 64


class Transform:
    """BWT of a sequence of symbols 0 .. sigma, rows ordered by their first ``depth`` symbols; ``rank`` by binary search."""

    def __init__(self, text: np.ndarray, sigma: int, depth: int):
        n = len(text)
        ahead = np.concatenate([text, np.zeros(depth, text.dtype)])
        bits = int(sigma).bit_length()
        if bits * depth <= 63:
            key = np.zeros(n, np.uint64)
            for i in range(depth):
                key <<= np.uint64(bits)
                key |= ahead[i: n + i].astype(np.uint64)
            order = np.argsort(key, kind="stable")
            del key
        else:
            order = np.lexsort([ahead[i: n + i] for i in reversed(range(depth))])
        self.last = text[order - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma + 1))])
        self.breaks = np.concatenate([[0], np.cumsum(self.last == 0)]).astype(np.int32)

    @cached_property
    def places(self) -> np.ndarray:
        """Rows by their symbol in the transform: symbol * (rows + 1) + row."""
        n = len(self.last)
        return np.sort(self.last * np.int64(n + 1) + np.arange(n))

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands in the transform before ``row``."""
        return np.searchsorted(self.places, symbol * np.int64(len(self.last) + 1) + row) - self.first[symbol]

    def words_in(self, low: np.ndarray, size: np.ndarray) -> np.ndarray:
        """How many rows of each interval have a word, not a break, in the transform."""
        return size - (self.breaks[low + size] - self.breaks[low])


class BidirectionalIndex:
    """FM-index of a word sequence and its reverse.  Words are 1 .. sigma; 0 parts pieces."""

    def __init__(self, text: np.ndarray, sigma: int, depth: int):
        self.sigma = sigma
        self.forward, self.backward = Transform(text, sigma, depth), Transform(text[::-1], sigma, depth)

    def words(self) -> tuple:
        """(phrases, low, low in the reverse, size) of all single words that occur."""
        words = np.arange(1, self.sigma + 1)
        low = self.forward.first[words]
        size = self.forward.first[words + 1] - low
        there = size > 0
        return words[there, None].astype(np.int32), low[there], low[there], size[there]

    def extend_left(self, level: tuple) -> tuple:
        """All phrases one word longer than those of ``level``, by the word before them."""
        phrases, low, back, size = level
        if not len(size):
            return np.zeros((0, phrases.shape[1] + 1), np.int32), *[np.zeros(0, np.int64)] * 3
        begin = np.cumsum(size) - size
        rows = np.repeat(low - begin, size)
        rows += np.arange(len(rows))
        key = np.repeat(np.arange(len(size)) * (self.sigma + 1), size)
        key += self.forward.last[rows]
        del rows
        key.sort()
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.diff(first, append=len(key))
        owner, symbol = np.divmod(key[first], self.sigma + 1)
        del key, first
        back = back[owner] + (np.cumsum(count) - count) - begin[owner]  # symbols that sort before this one
        real = symbol > 0
        owner, symbol, count, back = owner[real], symbol[real], count[real], back[real]
        low = self.forward.first[symbol] + self.forward.rank(symbol, low[owner])
        return np.column_stack([symbol.astype(np.int32), phrases[owner]]), low, back, count

    def extensions(self, level: tuple) -> tuple[np.ndarray, np.ndarray]:
        """How many occurrences of each phrase have a word before them, and after them."""
        _, low, back, size = level
        return self.forward.words_in(low, size), self.backward.words_in(back, size)


def _lookup(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"): ord("Z") + 1] += 32
_BREAKS, _PARTS = _lookup(PIECE_ENDS), _lookup(PIECE_ENDS + WORD_ENDS)


def _coded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(place of each word among the different words, which words end a piece, the different words) of texts."""
    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(texts)], texts), pa.scalar(b"\n", pa.large_binary()))[0].as_buffer()
    buf = _FOLD[np.frombuffer(joined, np.uint8)] if joined.size else np.empty(0, np.uint8)
    inside = ~_PARTS[buf]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    sizes = np.concatenate([[0], np.cumsum(ends - starts)])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(sizes), pa.py_buffer(buf[inside])])
    coded = words.dictionary_encode()
    breaks = np.searchsorted(np.flatnonzero(_BREAKS[buf]), starts)
    return coded.indices.to_numpy(), np.flatnonzero(np.diff(breaks, append=-1)), coded.dictionary  # the last word of each piece


def _words(texts: pa.Array, part_bytes: int = 1 << 20) -> tuple[np.ndarray, pa.Array]:
    """(word ids from 1 with a 0 after every piece, the words in byte order) of texts, some texts at a time."""
    offsets = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy())])
    parts = [_coded(texts.slice(a, b - a)) for a, b in slices(offsets, part_bytes)] or [_coded(texts)]
    coded = pa.concat_arrays([words for _, _, words in parts]).dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary).to_numpy()
    number = np.empty(len(order), np.int32)
    number[order] = np.arange(1, len(order) + 1)
    number, at, ids = number[coded.indices.to_numpy()], 0, []
    for places, last, words in parts:
        ids.append(np.insert(number[at: at + len(words)][places], last + 1, 0))
        at += len(words)
    pa.default_memory_pool().release_unused()
    return np.concatenate(ids), coded.dictionary.take(pa.array(order))


def count_ngrams(texts: pa.Array, depth: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All n-grams of up to ``depth`` words of one shard: (words in byte order, a row of word
    ids for each n-gram, 0 behind its last word, and its f, before and after)."""
    ids, words = _words(texts)
    index = BidirectionalIndex(ids, len(words), depth)
    level, grams, counts = index.words(), [], []
    for n in range(1, depth + 1):
        rows = np.zeros((len(level[0]), depth), np.int32)
        rows[:, :n] = level[0]
        grams.append(rows)
        counts.append(np.column_stack([c.astype(np.int32) for c in (level[3], *index.extensions(level))]))
        del rows
        if n < depth:
            level = index.extend_left(level)
    del index, level, ids
    grams = np.concatenate(grams)
    return words, grams, np.concatenate(counts)


_BLOBS = pa.schema([("lang", pa.string()), ("bucket", pa.int64()), ("ngrams", pa.binary())])
_NGRAMS = pa.schema([("phrase", pa.large_binary()), ("words", pa.int32()), ("f", pa.int32()), ("before", pa.int32()), ("after", pa.int32())])


def _phrases(words: pa.Array, grams: np.ndarray) -> pa.Array:
    """The n-grams' words joined by blanks."""
    columns = [words.take(pa.array(c - 1, mask=c == 0)) for c in grams.T]
    return pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.large_binary()), null_handling="skip")


def _blobs(lang: str | None, texts: pa.Array, depth: int, buckets: int, chunk_rows: int = 1 << 17):
    """The n-grams of a shard as one compressed batch a bucket; their text is made some buckets at a time."""
    words, grams, counts = count_ngrams(texts, depth)
    hashes = np.array([0, *[zlib.crc32(w) for w in words.to_pylist()]], np.uint64)
    bucket = np.empty(len(grams), np.int32)
    for a in range(0, len(grams), chunk_rows):
        mark = np.zeros(len(grams[a: a + chunk_rows]), np.uint64)
        for column in grams[a: a + chunk_rows].T:
            mark = mix64(mark + hashes[column])
        bucket[a: a + chunk_rows] = mark % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    at = 0
    while at < len(cuts) - 1:
        end = max(at + 1, int(np.searchsorted(cuts, cuts[at] + chunk_rows, "right")) - 1)
        own = order[cuts[at]: cuts[end]]
        columns = [_phrases(words, grams[own]), (grams[own] > 0).sum(1), *counts[own].T]
        batch = pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _NGRAMS)], schema=_NGRAMS)
        rows = []
        for a, b in zip((cuts[at:end] - cuts[at]).tolist(), (cuts[at + 1: end + 1] - cuts[at]).tolist()):
            if a < b:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, _NGRAMS, options=options) as stream:
                    stream.write_batch(batch.slice(a, b - a))
                rows.append((lang, int(bucket[cuts[at] + a]), sink.getvalue().to_pybytes()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _BLOBS)], schema=_BLOBS)
        at = end
    pa.default_memory_pool().release_unused()


def _shards(depth: int, buckets: int, shard_bytes: int):
    def run(batches):
        pending, held = {}, {}
        # a batch may have more text than a shard: only a part of it is copied at a time
        for batch in (whole.slice(a, 500) for whole in batches for a in range(0, len(whole), 500)):
            texts = pc.fill_null(batch.column(1).cast(pa.large_binary()), b"")
            langs = batch.column(0).dictionary_encode()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                own = texts.filter(pc.equal(langs.indices, code))
                size = pc.binary_length(own).to_numpy()
                at = 0
                while at < len(own):
                    room = shard_bytes - held.get(lang, 0)
                    end = max(at + 1, at + int(np.searchsorted(np.cumsum(size[at:]), room, "right")))
                    pending.setdefault(lang, []).append(own.slice(at, end - at))
                    held[lang] = held.get(lang, 0) + int(size[at:end].sum())
                    at = end
                    if at < len(own) or held[lang] >= shard_bytes:
                        held.pop(lang)
                        yield from _blobs(lang, pa.concat_arrays(pending.pop(lang)), depth, buckets)
                while sum(held.values()) > 2 * shard_bytes:  # many languages: the fullest goes
                    full = max(held, key=held.get)
                    held.pop(full)
                    yield from _blobs(full, pa.concat_arrays(pending.pop(full)), depth, buckets)
        for lang in list(pending):
            yield from _blobs(lang, pa.concat_arrays(pending.pop(lang)), depth, buckets)

    return run


_COUNTS = "lang string, phrase string, words int, f long, before long, after long"


def _merged(min_count: int, hold_rows: int):
    """Task over blobs sorted by (bucket, lang): one sum per n-gram; a row without phrase has the bucket's number of words."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("f", pa.int64()), ("before", pa.int64()), ("after", pa.int64())])
    sums = ["f", "before", "after"]
    wide = pa.schema([t if t.name not in sums else pa.field(t.name, pa.int64()) for t in _NGRAMS])

    def folded(tables):
        table = pa.concat_tables(tables)
        found = table.group_by(["phrase", "words"], use_threads=False).aggregate([(c, "sum") for c in sums])
        return found.select(["phrase", "words", *[f"{c}_sum" for c in sums]]).rename_columns(["phrase", "words", *sums])

    def result(key, tables):
        table = folded(tables)
        total = pc.sum(table.filter(pc.equal(table["words"], 1))["f"]).as_py() or 0
        table = table.filter(pc.greater_equal(table["f"], min_count))
        columns = [pa.array([key[1]] * len(table), pa.string()), table["phrase"].cast(pa.binary()).cast(pa.string()), *[table[c] for c in ("words", *sums)]]
        rows = pa.table([c.cast(t.type) for c, t in zip(columns, schema)], schema=schema)
        rest = pa.table([[key[1]], [None], [0], [total], [0], [0]], schema=schema)
        yield from pa.concat_tables([rows, rest]).combine_chunks().to_batches()

    def run(batches):
        key, held, n, base = None, [], 0, 0
        for batch in batches:
            for lang, bucket, blob in zip(batch.column("lang").to_pylist(), batch.column("bucket").to_pylist(), batch.column("ngrams")):
                if (bucket, lang) != key:
                    if held:
                        yield from result(key, held)
                    key, held, n, base = (bucket, lang), [], 0, 0
                held.append(pa.ipc.open_stream(blob.as_buffer()).read_all().cast(wide))
                n += len(held[-1])
                if n > base + hold_rows:  # copies of the same n-grams by many shards are summed on the way
                    held = [folded(held)]
                    n = base = len(held[0])
        if held:
            yield from result(key, held)

    return run


def phrase_counts(docs: DataFrame, max_words: int = 3, min_count: int = 10, lang_col: str = "lang", text_col: str = "text",
                  shard_bytes: int = 8 << 20, bucket_bytes: int = 8 << 20, hold_rows: int = 1 << 19) -> DataFrame:
    """Per language and phrase of 1 .. ``max_words`` words: lang, phrase, words, f, before, after.

    Only phrases with f >= ``min_count`` are returned; one row per language without a
    phrase (words 0) has in f the number of all word occurrences.  ``before`` and
    ``after`` are the occurrences with a word before and after them in the piece.  A NULL
    language is ``und``, a NULL text empty, a language without any word has no row.  Rows
    that repeat a document count again.  ``shard_bytes`` and ``bucket_bytes`` (bytes of text
    for one index and one bucket of sums) bound the memory of a task; a text longer than a
    shard is a shard of its own.
    """
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), text.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    blobs = rows.mapInArrow(_shards(max_words, buckets, shard_bytes), "lang string, bucket long, ngrams binary")
    dealt = blobs.select("lang", F.col("bucket").cast("int").alias("bucket"), "ngrams").repartitionById(buckets, "bucket").sortWithinPartitions("bucket", "lang")
    counts = written(dealt.mapInArrow(_merged(min_count, hold_rows), _COUNTS), "phrase-counts")
    n = counts.where(F.col("phrase").isNull()).groupBy("lang").agg(F.sum("f").alias("f")).where("f > 0")
    return counts.where(F.col("phrase").isNotNull()).unionByName(
        n.select("lang", F.lit(None).cast("string").alias("phrase"), F.lit(0).alias("words"), "f", F.lit(0).cast("long").alias("before"), F.lit(0).cast("long").alias("after")))


def _cut(phrase: F.Column, words: F.Column, k: F.Column) -> tuple:
    parts = F.split(phrase, " ")
    return F.concat_ws(" ", F.slice(parts, F.lit(1), k)), F.concat_ws(" ", F.slice(parts, k + 1, words - k))


def score_cuts(counts: DataFrame) -> DataFrame:
    """``counts`` of phrases of two words or more with l, r and score of the lowest-scoring cut (ties to the earliest).

    score = floor(1000000 * f * f / (l * r)), where l and r are the counts of the two
    parts, in exact decimals (counts up to 10^15).
    """
    longer = counts.where("words > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    first, rest = _cut(F.col("phrase"), F.col("words"), F.col("k"))
    part = lambda name, f: counts.select(F.col("lang").alias(f"{name}_lang"), F.col("phrase").alias(f"{name}_phrase"), F.col("f").alias(f))
    cuts = longer.withColumns({"first": first, "rest": rest})
    for name, f in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(part(name, f), (F.col("lang") == F.col(f"{name}_lang")) & (F.col(name) == F.col(f"{name}_phrase")))
    exact = lambda c: F.col(c).cast("decimal(16,0)")
    over = (exact("f") * exact("f")).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    cuts = cuts.withColumn("score", F.call_function("div", over, (exact("l") * exact("r")).cast("decimal(32,0)")))
    best = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "words", "f").agg(best).select("lang", "phrase", "words", "f", "cut.l", "cut.r", "cut.score")


def drop_contained(phrases: DataFrame, share: int = 50) -> DataFrame:
    """``phrases`` without those whose words lie in a longer one with 100 * f(longer) >= ``share`` * f."""
    spans = F.expr("""flatten(transform(sequence(2, words - 1), n ->
        transform(sequence(1, words - n + 1), i -> array_join(slice(split(phrase, ' '), i, n), ' '))))""")
    inside = (phrases.where("words > 2").select("lang", "f", F.explode(spans).alias("part"))
              .groupBy(F.col("lang").alias("in_lang"), "part").agg(F.max("f").alias("longer")))
    held = phrases.join(inside, (F.col("lang") == F.col("in_lang")) & (F.col("phrase") == F.col("part")), "left")
    return held.where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("f") * share)).select(*phrases.columns)


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, share: int = 50, top: int = 2000, **options) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, words, a, l, r, n, score.

    By score, then a, both descending, then phrase in byte order.  A phrase contained in a
    longer one with ``share`` percent of its count or more is left out, whether the longer
    one is ranked or not.  See ``phrase_counts`` for NULLs and options.
    """
    counts = phrase_counts(docs, max_words, min_count, **options)
    scored = score_cuts(counts.where("phrase is not null"))
    kept = written(drop_contained(scored, share), "phrases")
    order = [F.col("score").desc(), F.col("f").desc(), F.col("phrase")]
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    # a language's phrases are cut down in salted groups first, so that no task gets them all
    few = kept.withColumn("salt", F.pmod(F.hash("phrase"), F.lit(_SALTS))).withColumn("near", rank("lang", "salt")).where(F.col("near") <= top)
    ranked = few.withColumn("rank", rank("lang")).where(F.col("rank") <= top)
    n = counts.where("phrase is null").select(F.col("lang").alias("of"), F.col("f").alias("n"))
    out = ranked.join(n, F.col("lang") == F.col("of"))
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "words", F.col("f").alias("a"), "l", "r", "n", "score")
