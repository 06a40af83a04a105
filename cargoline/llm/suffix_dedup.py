"""Removal of long byte strings that occur more than once, by merging shard BWTs.

The strings that matter are long (400 bytes), so each one holds an anchor: the smallest
of the hashes of its 64-byte substrings, leftmost on ties.  Equal strings hold equal
anchors at equal places.  That gives three steps:

1. anchors of all texts; those found at one place only are done with;
2. each shard (a batch of texts) lays the bytes around its repeated anchors side by
   side, aligned at the anchor, and writes their Burrows-Wheeler transform: column by
   column, the bytes in the order of what stands before them;
3. a task receives the transforms of all shards for its anchors and merges them.  The
   interleave of the shards is refined one column at a time: the next byte of each row is
   read from its shard's transform in the present order, and a stable partition by that
   byte is the next order.  Suffixes are never sorted again.  Lengths of common strings of
   neighbours follow along, and a neighbour that agrees on 400 bytes marks a repeat.

Equal texts are processed once; each of them is a repeat throughout.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargoline.llm.common import WordHasher, slices, text_bytes, written

#: bytes of a hashed substring; no byte of UTF-8 text is 0xFF
GRAM, _PAD = 64, 0xFF
#: contexts that one task merges, and texts that hold one anchor before it is dealt to several
MERGE_ROWS, HOT_ROWS = 30_000, 50_000


class Grams:
    """Hashes of all GRAM-byte substrings of a buffer."""

    def __init__(self):
        self.hasher = WordHasher(np.ones(256, bool), np.arange(256))

    def __call__(self, buf: np.ndarray) -> np.ndarray:
        if len(buf) < GRAM:
            return np.empty(0, np.uint64)
        self.hasher(buf)
        at = np.arange(len(buf) - GRAM + 1)
        return self.hasher.between(at, at + GRAM)


def anchors(grams: np.ndarray, offsets: np.ndarray, length: int) -> np.ndarray:
    """Places of the anchors of all ``length``-byte strings that lie inside one text."""
    width = length - GRAM + 1
    if len(grams) < width:
        return np.empty(0, np.int64)
    # order by the upper half of the hash, then by place: the least is the leftmost smallest
    n = len(grams)
    rank = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    blocks = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    blocks[:n] = rank
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    count = n - width + 1
    least = np.minimum(behind[:count], ahead[width - 1: width - 1 + count]) & np.uint64(0xFFFFFFFF)
    inside = np.zeros(count + 1, np.int8)  # strings that begin here end in the same text
    for a, b in zip(offsets, offsets[1:]):
        if b - a >= length:
            inside[a] += 1
            inside[min(b - length + 1, count)] -= 1
    return np.unique(least[np.cumsum(inside[:count]).astype(bool)]).astype(np.int64)


def _find(length: int):
    schema = pa.schema([("anchor", pa.int64()), ("w1", pa.int64()), ("w2", pa.int64()), ("pos", pa.list_(pa.int64()))])

    def run(batches):
        make = Grams()
        for batch in batches:
            buf, offsets = text_bytes(batch.column("text"))
            w1, w2 = (batch.column(c).to_numpy() for c in ("w1", "w2"))
            for a, b in slices(offsets, 1 << 20):
                own = offsets[a: b + 1] - offsets[a]
                grams = make(buf[offsets[a]: offsets[b]])
                at = anchors(grams, own, length)
                doc = np.searchsorted(own, at, "right") - 1
                found, place = grams[at].view(np.int64), at - own[doc]
                order = np.lexsort((place, found, doc))  # one row for each text and anchor
                found, doc, place = found[order], doc[order], place[order]
                first = np.flatnonzero(np.concatenate([[True], (found[1:] != found[:-1]) | (doc[1:] != doc[:-1])])[: len(at)])
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(at)), pa.int32()), pa.array(place))
                yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in (found[first], w1[a:b][doc[first]], w2[a:b][doc[first]])), lists], schema=schema)

    return run


def _contexts(buf: np.ndarray, at: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int) -> np.ndarray:
    """The bytes from ``length - GRAM`` before to ``length`` after each place, padded outside its text."""
    left = length - GRAM
    places = at[:, None] + np.arange(-left, length)
    rows = buf[np.clip(places, 0, len(buf) - 1)]
    rows[(places < begin[:, None]) | (places >= end[:, None])] = _PAD
    return rows


def transform(rows: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Columns of the transform of every bucket's rows (sorted by bucket): column k has the
    bytes at place k in the order of the bytes before them, last one first."""
    out = np.empty(rows.shape[::-1], np.uint8)
    columns = np.ascontiguousarray(rows.T)
    _, group = np.unique(bucket, return_inverse=True)
    group = group.astype(np.uint16 if group.max(initial=0) < 256 else np.int64) << 8
    order = np.arange(len(rows))
    for k, column in enumerate(columns):
        out[k] = column[order]
        order = order[np.argsort(group + out[k], kind="stable")]
    return out


class _Shard:
    """Distinct contexts of a batch by bucket, with the places where they stand."""

    def __init__(self):
        self.number: dict[tuple[int, int], int] = {}
        self.rows, self.bucket, self.hot, self.inside, self.occurrences = [], [], [], [], []

    def packed(self) -> pa.RecordBatch:
        import zstandard as zstd

        bucket, occurrences = np.array(self.bucket), np.array(self.occurrences, np.int64)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        columns = transform(np.stack(self.rows)[order], bucket[order])
        occurrences[:, 0] = place[occurrences[:, 0]]
        occurrences = occurrences[np.argsort(occurrences[:, 0], kind="stable")]
        about = np.column_stack([np.array(self.hot, np.int64), np.array(self.inside, np.int64)])[order]
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
        out = []
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            own = occurrences[slice(*np.searchsorted(occurrences[:, 0], [lo, hi]))] - [lo, 0, 0, 0]
            parts = np.array([hi - lo, len(own)], np.int64), about[lo:hi].T, own.T, columns[:, lo:hi]
            out.append((int(bucket[order[lo]]), zstd.ZstdCompressor(level=3).compress(b"".join(np.ascontiguousarray(p).tobytes() for p in parts))))
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int32(), pa.binary()))], names=["bucket", "shard"])


def _shards(length: int, buckets: int, shard_rows: int = 20_000):
    """Texts with their repeated anchors -> packed transforms, one for each bucket and shard."""

    def run(batches):
        import xxhash

        make, shard, left = Grams(), _Shard(), length - GRAM
        for batch in batches:
            if not batch.num_rows:
                continue
            buf, offsets = text_bytes(batch.column("text"))
            w = np.stack([batch.column(c).to_numpy() for c in ("w1", "w2")], 1)
            places = batch.column("places").to_pylist()
            for a, b in slices(offsets, 1 << 20):
                part = buf[offsets[a]: offsets[b]]
                doc = np.repeat(np.arange(a, b), [sum(len(x["pos"]) for x in p) for p in places[a:b]])
                pos = np.array([q for p in places[a:b] for x in p for q in x["pos"]], np.int64)
                salts = np.array([x["salts"] for p in places[a:b] for x in p for _ in x["pos"]], np.uint64)
                begin, end = offsets[doc] - offsets[a], offsets[doc + 1] - offsets[a]
                at = begin + pos
                make.hasher(part)
                grams = make.hasher.between(at, at + GRAM)
                # the rows of an anchor that very many texts hold are dealt to several tasks
                with np.errstate(over="ignore"):
                    goes = (grams + (w[doc, 0].view(np.uint64) % salts) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(buckets)
                inside = np.stack([np.maximum(0, left - pos), left + np.minimum(length, end - at)], 1)
                for lo in range(0, len(at), 5_000):
                    some = slice(lo, lo + 5_000)
                    for i, row in enumerate(_contexts(part, at[some], begin[some], end[some], length), lo):
                        key = (xxhash.xxh3_128_intdigest(row.tobytes()), int(goes[i]))
                        number = shard.number.setdefault(key, len(shard.rows))
                        if number == len(shard.rows):
                            shard.rows.append(row)
                            shard.bucket.append(int(goes[i]))
                            shard.hot.append(salts[i] > 1)
                            shard.inside.append(inside[i])
                        shard.occurrences.append((number, w[doc[i], 0], w[doc[i], 1], pos[i]))
                    if len(shard.occurrences) >= shard_rows:
                        yield shard.packed()
                        shard = _Shard()
        if shard.rows:
            yield shard.packed()

    return run


def _unpack(blob: bytes, span: int):
    """(hot and first and last column inside the text by row, occurrences, columns of the transform) of a shard."""
    import zstandard as zstd

    raw = zstd.ZstdDecompressor().decompress(blob)
    n, m = np.frombuffer(raw, np.int64, 2).tolist()
    about = np.frombuffer(raw, np.int64, 3 * n, 16).reshape(3, n).T
    occurrences = np.frombuffer(raw, np.int64, 4 * m, 16 + 24 * n).reshape(4, m).T
    return about, occurrences, np.frombuffer(raw, np.uint8, offset=16 + 24 * n + 32 * m).reshape(span, n)


def _common(shared: np.ndarray, order: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Lengths shared with the row above after a partition: one more than the least over the
    rows between the two in the old order, 0 where the last bytes differ."""
    out = np.zeros(len(order), np.int16)
    here = np.flatnonzero(same) + 1
    low, high = order[here - 1] + 1, order[here]  # the rows after the one above, up to this one
    gap = high - low + 1
    best = shared[high].copy()
    table, level = shared, 0
    far = np.flatnonzero(gap > 1)
    while len(far):
        step = 1 << level
        use = far[(gap[far] >= step) & (gap[far] < 2 * step)]
        best[use] = np.minimum(table[low[use]], table[high[use] - step + 1])
        far = far[gap[far] >= 2 * step]
        table = np.minimum(table[:-step], table[step:]) if len(far) else table
        level += 1
    out[here] = best + 1
    return out


def merge_shards(columns: list[np.ndarray], length: int, keep_rows: bool = False):
    """Merge shard transforms: (repeats, rows).

    repeats[s, i] says whether the string of ``length`` bytes at place s of row i (shards'
    rows one after the other) stands at the same place of another row.  ``rows`` are the
    bytes, by column, if asked for.
    """
    sizes = [c.shape[1] for c in columns]
    joined = np.concatenate(columns, 1)
    span, n = joined.shape
    shard = np.repeat(np.arange(len(sizes), dtype=np.uint16 if len(sizes) < 65536 else np.int64), sizes)
    row = np.arange(n)
    shared = np.zeros(n, np.int16)  # bytes in common with the row above, back from this column
    repeats = np.zeros((span - length + 1, n), bool)
    rows = np.empty((span, n), np.uint8) if keep_rows else None
    for k in range(span):
        byte = np.empty(n, np.uint8)
        byte[np.argsort(shard, kind="stable")] = joined[k]  # each shard's bytes, in its own order
        if keep_rows:
            rows[k, row] = byte
        order = np.argsort(byte, kind="stable")
        byte = byte[order]
        shared = _common(shared, order, byte[1:] == byte[:-1])
        shard, row = shard[order], row[order]
        if k >= length - 1:
            enough = shared >= length
            twin = enough.copy()
            twin[:-1] |= enough[1:]
            repeats[k - length + 1, row] = twin
    return repeats, rows


_SPANS = "w1 long, w2 long, a long, b long, h1 long, h2 long"


def _merged(w1: np.ndarray, w2: np.ndarray, a: np.ndarray, b: np.ndarray):
    """The spans [a, b) of texts with those that touch or overlap joined."""
    order = np.lexsort((a, w2, w1))
    w1, w2, a, b = (x[order] for x in (w1, w2, a, b))
    if not len(a):
        return w1, w2, a, b
    fresh = np.concatenate([[True], (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])])
    shift = (np.cumsum(fresh) - 1) * (int(b.max()) + 1)  # the texts one after the other
    far = np.maximum.accumulate(b + shift)
    fresh[1:] |= (a + shift)[1:] > far[:-1]
    at = np.flatnonzero(fresh)
    last = np.append(at[1:], len(a)) - 1
    return w1[at], w2[at], a[at], far[last] - shift[last]


def _merge(length: int):
    """Shards of one task -> spans [a, b) to remove, and strings of dealt anchors still to be
    compared with other tasks (h1, h2 set)."""
    span = 2 * length - GRAM
    left = length - GRAM
    names = [x.split()[0] for x in _SPANS.split(", ")]

    def rows_of(w1, w2, a, b, h1=None, h2=None):
        return pa.RecordBatch.from_arrays([pa.nulls(len(a), pa.int64()) if c is None else pa.array(c, pa.int64()) for c in (w1, w2, a, b, h1, h2)], names=names)

    def run(batches):
        import xxhash

        about, occurrences, columns, base = [], [], [], 0
        for batch in batches:
            for blob in batch.column("shard").to_pylist():
                h, o, c = _unpack(blob, span)
                about.append(h)
                occurrences.append(o + [base, 0, 0, 0])
                columns.append(c)
                base += len(h)
        if not base:
            return
        about, occurrences = np.concatenate(about), np.unique(np.concatenate(occurrences), axis=0)
        hot = about[:, 0].astype(bool)
        repeats, rows = merge_shards(columns, length, bool(hot.any()))
        s = np.arange(len(repeats))[:, None]
        valid = (s >= about[:, 1]) & (s + length <= about[:, 2])
        repeats[:, np.bincount(occurrences[:, 0], minlength=base) > 1] = True
        repeats &= valid
        edge = np.diff(np.concatenate([np.zeros((1, base), np.int8), repeats.view(np.int8), np.zeros((1, base), np.int8)]), axis=0).T
        at, begin = np.nonzero(edge == 1)
        _, end = np.nonzero(edge == -1)
        # every occurrence of a row gets the row's spans
        first = np.searchsorted(at, occurrences[:, 0])
        count = np.searchsorted(at, occurrences[:, 0], "right") - first
        which = np.repeat(np.arange(len(occurrences)), count)
        own = np.arange(len(which)) - np.repeat(np.cumsum(count) - count - first, count)
        o = occurrences[which]
        yield rows_of(*_merged(o[:, 1], o[:, 2], o[:, 3] - left + begin[own], o[:, 3] - left + end[own] + length - 1))
        # strings of dealt anchors: those found once here, and a witness of those found twice
        out, witnessed = [], set()
        first_at = dict(zip(*(x.tolist() for x in np.unique(occurrences[:, 0], return_index=True))))
        for i in np.flatnonzero(hot).tolist():
            _, w1, w2, pos = occurrences[first_at[i]].tolist()  # a row with an open string has one occurrence
            raw = np.ascontiguousarray(rows[:, i]).tobytes()
            for s in np.flatnonzero(valid[:, i]).tolist():
                digest = xxhash.xxh3_128_intdigest(raw[s: s + length])
                h = (digest >> 64) - (1 << 63), (digest & 0xFFFFFFFFFFFFFFFF) - (1 << 63)
                if not repeats[s, i]:
                    out.append((w1, w2, pos - left + s, pos - left + s + length, *h))
                elif h not in witnessed:
                    witnessed.add(h)
                    out.append((0, 0, -1, -1, *h))
            if len(out) > 50_000:
                yield rows_of(*np.array(out, np.int64).T)
                out = []
        if out:
            yield rows_of(*np.array(out, np.int64).T)

    return run


def repeated_spans(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(w1, w2, whole, spans): for each distinct text with repeats, the byte spans [a, b) to remove.

    w1 and w2 are two hashes of the text (NULL as empty).  ``whole``: the text stands in
    several rows and is at least ``length`` long, so all of it goes.  Spans may overlap.
    Texts shorter than ``length`` have none.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("w1"), F.xxhash64(F.lit(1), text).alias("w2"), text.alias("text"))
    texts = keyed.where(F.octet_length("text") >= length)
    found = written(texts.select("w1", "w2", "text").mapInArrow(_find(length), "anchor long, w1 long, w2 long, pos array<long>"), "anchors")
    place = F.xxhash64("w1", "w2")
    counted = found.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min(place).alias("low"), F.max(place).alias("high"), F.max(F.size("pos")).alias("most"))
    repeated = counted.where("low <> high or most > 1").select("anchor", F.ceil(F.col("n") / HOT_ROWS).cast("int").alias("salts"))
    # one row of each distinct text speaks for all
    rows = written(texts.groupBy("w1", "w2").agg(F.count("*").alias("n"), F.min("id").alias("speaker")), "texts")
    places = found.join(repeated, "anchor").groupBy("w1", "w2").agg(F.collect_set(F.struct("pos", "salts")).alias("places"))
    per_text = written(places.join(rows, ["w1", "w2"]).withColumnsRenamed({"w1": "v1", "w2": "v2"}), "repeated-anchors")
    total = per_text.agg(F.sum(F.aggregate("places", F.lit(0), lambda n, p: n + F.size(p["pos"])))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / MERGE_ROWS))
    speaking = texts.join(per_text.hint("merge"), (F.col("w1") == F.col("v1")) & (F.col("w2") == F.col("v2")) & F.col("id").eqNullSafe(F.col("speaker")))
    shards = speaking.select("w1", "w2", "text", "places").mapInArrow(_shards(length, buckets), "bucket int, shard binary")
    spans = written(shards.repartitionById(buckets, "bucket").mapInArrow(_merge(length), _SPANS), "spans")
    dealt = spans.where("h1 is not null")
    mark = F.xxhash64("w1", "w2", "a")
    again = dealt.groupBy("h1", "h2").agg(F.min(mark).alias("low"), F.max(mark).alias("high")).where("low <> high").select("h1", "h2")
    spans = spans.where("h1 is null").select("w1", "w2", "a", "b").union(
        dealt.where("a >= 0").join(again, ["h1", "h2"], "left_semi").select("w1", "w2", "a", "b"))
    copies = rows.where("n > 1").select("w1", "w2", F.lit(True).alias("whole"))
    return spans.groupBy("w1", "w2").agg(F.collect_list(F.struct("a", "b")).alias("spans")).join(copies, ["w1", "w2"], "full").select(
        "w1", "w2", F.coalesce("whole", F.lit(False)).alias("whole"), "spans")


_NEW = ("n_bytes", "n_removed", "n_spans", "kept")


def _without(raw: memoryview, first: np.ndarray, end: np.ndarray) -> tuple[int, int, bytes]:
    """(bytes removed, maximal runs, the bytes that stay) of a text and the spans to remove."""
    if not len(first):
        return 0, 0, bytes(raw)
    order = np.lexsort((end, first))
    first, reach = first[order], np.maximum.accumulate(end[order])
    begins = np.concatenate([[True], first[1:] > reach[:-1]])
    runs, ends = first[begins], reach[np.append(np.flatnonzero(begins)[1:] - 1, len(reach) - 1)]
    gaps = zip([0, *ends.tolist()], [*runs.tolist(), len(raw)])
    return int((ends - runs).sum()), len(runs), b"".join(raw[x:y] for x, y in gaps)


def _remove(n_columns: int, batch_bytes: int = 4 << 20):
    """Rows (columns to keep, text, whole, spans) -> the columns and _NEW, some texts at a time."""
    types = pa.int64(), pa.int64(), pa.int64(), pa.binary()

    def run(batches):
        for batch in batches:
            text, whole, spans = batch.columns[n_columns:]
            buf, offsets = text_bytes(text)
            raw = memoryview(buf)
            whole, there, at = whole.to_pylist(), spans.is_valid().to_pylist(), spans.offsets.to_numpy()
            first, end = (np.asarray(spans.values.field(c)) for c in ("a", "b"))
            for lo, hi in slices(offsets, batch_bytes):
                out = [[] for _ in _NEW]
                for i in range(lo, hi):
                    own = raw[offsets[i]: offsets[i + 1]]
                    if whole[i]:
                        row = len(own), len(own), 1, b""
                    else:
                        mine = slice(at[i], at[i + 1]) if there[i] else slice(0, 0)
                        row = len(own), *_without(own, first[mine], end[mine])
                    for column, value in zip(out, row):
                        column.append(value)
                same = batch.slice(lo, hi - lo).columns[:n_columns]
                names = [*batch.schema.names[:n_columns], *_NEW]
                yield pa.RecordBatch.from_arrays([*same, *(pa.array(x, t) for x, t in zip(out, types))], names=names)

    return run


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans (maximal removed runs) and ``kept`` (bytes).

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in
    the same text or another; strings are judged on the input.  NULL counts as empty; rows
    that repeat a text are texts of their own.  Cuts may part a UTF-8 sequence, so ``kept``
    is binary.  Input columns of the new names are replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    spans = repeated_spans(docs, length, id_col, text_col).withColumnsRenamed({"w1": "__w1", "w2": "__w2", "whole": "__whole", "spans": "__spans"})
    joined = docs.withColumn("__a", F.xxhash64(text)).withColumn("__b", F.xxhash64(F.lit(1), text)).join(
        spans.hint("merge"), (F.col("__a") == F.col("__w1")) & (F.col("__b") == F.col("__w2")), "left")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in _NEW]
    rows = joined.select(*kept, text.alias("__text"), F.coalesce("__whole", F.lit(False)).alias("__whole"), "__spans")
    schema = T.StructType(rows.schema.fields[: len(kept)] + [T.StructField(c, T.LongType()) for c in _NEW[:3]] + [T.StructField("kept", T.BinaryType())])
    return rows.mapInArrow(_remove(len(kept)), schema)
