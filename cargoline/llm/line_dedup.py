"""Corpus-wide removal of repeated lines, as compressed per-document keep bitmaps.

Line hashes are range-partitioned with a secondary sort (hash, document descending,
position), so a line held by a third of all documents spans as many partitions as it
needs.  Each task streams its sorted rows: a group that lies wholly inside the partition
is decided on the spot, and the first and last groups, which a boundary may cut, are
settled in a second small step.  No text moves; a document that loses lines gets a
bitmap, which is applied where the text is read.
"""
from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargoline.llm.common import written

_SPACE = b" \t\n\x0b\x0c\r"
_LINES = "h1 long, h2 long, doc long, version long, pos int"
_ARROW = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc", pa.int64()), ("version", pa.int64()), ("pos", pa.int32())])


def _long_lines(min_chars: int):
    def scan(batches):
        import xxhash

        for batch in batches:
            h1, h2, doc, version, pos = [], [], [], [], []
            docs, versions, texts = (batch.column(i).to_pylist() for i in range(3))
            for d, v, text in zip(docs, versions, texts):
                for i, line in enumerate(text.encode("utf-8", "replace").split(b"\n")):
                    key = line.strip(_SPACE).lower()
                    if len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars):
                        digest = xxhash.xxh3_128_intdigest(key)
                        h1.append((digest >> 64) - (1 << 63))
                        h2.append((digest & 0xFFFFFFFFFFFFFFFF) - (1 << 63))
                        doc.append(d)
                        version.append(v)
                        pos.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip((h1, h2, doc, version, pos), _ARROW)], schema=_ARROW)

    return scan


def _stream(min_docs: int):
    """Sorted rows of one partition -> rows to drop (settled) and rows of cut groups (not settled)."""
    schema = _ARROW.append(pa.field("settled", pa.bool_()))

    def emit(rows, settled):
        return pa.RecordBatch.from_arrays(
            [*(pa.array(np.ascontiguousarray(c), t.type) for c, t in zip(rows, _ARROW)), pa.array(np.full(len(rows[0]), settled))], schema=schema)

    def run(batches):
        first_key, key, held, n_docs, last_doc, keeper = None, None, [], 0, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            h1, h2, doc = cols[:3]
            starts = np.flatnonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]))
            ends = np.append(starts[1:], len(h1))
            # groups that begin and end inside the batch and are too small to matter are passed over
            small = ends - starts < min_docs
            small[0] = small[-1] = False
            for a, b in zip(starts[~small].tolist(), ends[~small].tolist()):
                this = (int(h1[a]), int(h2[a]))
                if this != key:
                    key, held, n_docs, last_doc, keeper = this, [], 0, None, int(doc[a])
                    first_key = first_key or this
                rows = [c[a:b] for c in cols]
                if this == first_key:  # may have begun in an earlier partition
                    yield emit(rows, False)
                    continue
                fresh = np.concatenate([[int(doc[a]) != last_doc], doc[a + 1: b] != doc[a: b - 1]])
                seen = n_docs + np.cumsum(fresh)
                if n_docs < min_docs:  # hold the rows of the first min_docs documents
                    cut = int(np.searchsorted(seen, min_docs, "right"))
                    held.append([c[:cut] for c in rows])
                    if seen[-1] >= min_docs:
                        rows = [np.concatenate(x) for x in zip(*held, [c[cut:] for c in rows])]
                if seen[-1] >= min_docs:
                    yield emit([c[rows[2] != keeper] for c in rows], True)
                n_docs, last_doc = int(seen[-1]), int(doc[b - 1])
        if held and key != first_key:  # may go on in the next partition
            yield emit([np.concatenate(x) for x in zip(*held)], False)

    return run


@F.pandas_udf(T.BinaryType())
def _pack_drops(positions: pd.Series) -> pd.Series:
    def pack(p):
        keep = np.ones((int(max(p)) // 8 + 1) * 8, bool)
        keep[np.asarray(p)] = False
        return zlib.compress(np.packbits(keep).tobytes())

    return positions.map(pack)


def line_keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, version, n_dropped, keep) of every document that loses lines.

    A line's key is the line without ASCII white space at both ends, A-Z in lower case.
    Keys of at least ``min_chars`` code points that are found in at least ``min_docs``
    documents are dropped except in the largest id that holds them.  ``version`` is a
    hash of the text: rows that repeat an id count as one document, and each keeps its own
    bitmap.  ``keep`` is a zlib-compressed bit string, one bit a line; lines after its end
    stay.  NULL ids and NULL or empty texts hold no line that counts.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text")).where(
        F.col("doc").isNotNull() & (F.length("text") >= min_chars))
    lines = written(rows.mapInArrow(_long_lines(min_chars), _LINES), "lines")
    order = ["h1", "h2", F.col("doc").desc(), "version", "pos"]
    judged = written(
        lines.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_stream(min_docs), _LINES + ", settled boolean"), "line-drops")
    # at most two groups a partition are not settled; a cut one is whole again here
    cut = judged.where("not settled")
    settled_now = (
        cut.groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc").alias("keeper"))
        .where(F.col("n_docs") >= min_docs)
    )
    drops = judged.where("settled").select("doc", "version", "pos").unionByName(
        cut.join(F.broadcast(settled_now), ["h1", "h2"]).where("doc <> keeper").select("doc", "version", "pos"))
    return drops.groupBy("doc", "version").agg(F.sort_array(F.collect_set("pos")).alias("drop")).select(
        "doc", "version", F.size("drop").cast("long").alias("n_dropped"), _pack_drops("drop").alias("keep"))


@F.pandas_udf(T.StructType([T.StructField("n_lines", T.LongType()), T.StructField("kept", T.StringType())]))
def _apply(texts: pd.Series, bitmaps: pd.Series) -> pd.DataFrame:
    def one(text, packed):
        if packed is None:
            return (text.count("\n") if text else 0) + 1, text or ""
        lines = text.split("\n")
        keep = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8))
        return len(lines), "\n".join([x for i, x in enumerate(lines) if i >= len(keep) or keep[i]])

    return pd.DataFrame([one(t, b) for t, b in zip(texts, bitmaps)], columns=["n_lines", "kept"])


def apply_keep_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with their kept lines as text, plus ``n_lines`` (before) and ``n_dropped``.

    A NULL or empty text is one empty line and stays empty.  Input columns named n_lines
    or n_dropped are replaced.
    """
    b = bitmaps.select(F.col("doc").alias("__doc"), F.col("version").alias("__version"), F.col("n_dropped").alias("__dropped"), F.col("keep").alias("__keep"))
    joined = docs.withColumn("__hash", F.xxhash64(text_col)).join(
        b.hint("merge"), (F.col(id_col).cast("long") == F.col("__doc")) & (F.col("__hash") == F.col("__version")), "left")
    done = joined.withColumn("__out", _apply(F.col(text_col), F.col("__keep")))
    kept = [F.col("__out").getField("kept").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return done.select(*kept, F.col("__out").getField("n_lines").alias("n_lines"), F.coalesce("__dropped", F.lit(0)).cast("long").alias("n_dropped"))


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without their repeated lines (see ``line_keep_bitmaps``)."""
    return apply_keep_bitmaps(docs, line_keep_bitmaps(docs, min_chars, min_docs, id_col, text_col), id_col, text_col)
