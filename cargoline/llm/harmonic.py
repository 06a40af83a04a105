"""Harmonic packing of tokenized documents into sequences of a fixed capacity C.

Every task packs the documents it reads, in one pass and without a shuffle.  What is left
of a document after its full sequences of C tokens belongs to class k where
C / (k + 1) < length <= C / k: a bin of class k takes exactly k of them.  The last class
(all that is no longer than C / ``classes``) is filled by next fit, and as documents may be
cut anywhere it also closes the gaps of the other bins: a bin with its k documents takes as
many tokens as it lacks from the documents of the last class.  Where these do not suffice,
the next document goes to them, whatever its length.

At the end of a task the open bins' documents are cut in a row into full sequences, and
the rest into sequences whose lengths are powers of two, which need no padding.  So there
is no padding anywhere, and about one cut a sequence.

Open space is bounded: k - 1 documents a class, fewer than 2 C tokens of the last class and
at most one bin that waits for tokens.
"""
from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoline.llm.common import per_worker, slices, text_bytes
from cargoline.llm.packing import WordIds

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Harmonic:
    """Bins of ``capacity`` by reciprocal classes; ``add`` and ``finish`` yield closed sequences.

    A sequence is a list of (document, start, end); a document is any object.
    """

    def __init__(self, capacity: int, classes: int):
        if not 1 <= classes <= capacity:
            raise ValueError("classes must be in 1 .. capacity")
        self.capacity, self.classes = capacity, classes
        self.open: list[list[tuple]] = [[] for _ in range(classes)]
        self.waiting: list[tuple] | None = None  # a bin with its documents and too few tokens to fill it
        self.small: deque[tuple] = deque()
        self.spare = 0

    def add(self, doc, length: int):
        full = length - length % self.capacity
        for start in range(0, full, self.capacity):
            yield [(doc, start, start + self.capacity)]
        if full < length:
            yield from self._rest((doc, full, length))

    def _rest(self, piece: tuple):
        k = self.capacity // (piece[2] - piece[1])
        if k >= self.classes or self.waiting:
            yield from self._cuttable(piece)
            return
        row = self.open[k]
        row.append(piece)
        if len(row) == k:
            self.open[k] = []
            self.waiting = row
            yield from self._cuttable(None)

    def _cuttable(self, piece: tuple | None):
        if piece:
            self.small.append(piece)
            self.spare += piece[2] - piece[1]
        if self.waiting:
            gap = self.capacity - sum(b - a for _, a, b in self.waiting)
            if gap > self.spare:
                return
            row, self.waiting = self.waiting, None
            yield row + self._take(gap)
        while self.spare >= 2 * self.capacity:
            yield self._take(self.capacity)

    def _take(self, tokens: int) -> list[tuple]:
        self.spare -= tokens
        out = []
        while tokens:
            doc, a, b = self.small.popleft()
            cut = min(b, a + tokens)
            out.append((doc, a, cut))
            tokens -= cut - a
            if cut < b:
                self.small.appendleft((doc, cut, b))
        return out

    def finish(self):
        left = [piece for row in [*self.open, self.waiting or []] for piece in row]
        self.open, self.waiting = [[] for _ in self.open], None
        for piece in left:
            yield from self._cuttable(piece)
        while self.spare >= self.capacity:
            yield self._take(self.capacity)
        while self.spare:
            yield self._take(1 << self.spare.bit_length() - 1)


def _pack(path: str, capacity: int, end_id: int, classes: int, batch_bytes: int, with_ids: bool):
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
                       + [("ids", pa.list_(pa.int64()))] * with_ids)

    def rows(number, sequence, out):
        at = 0
        for (doc_id, ids), a, b in sequence:
            part = ids[a:b]
            for column, value in zip(out, (doc_id, a, b - a, zlib.crc32(part.tobytes()), len(ids), number, at, part)):
                column.append(value)
            at += b - a

    def run(batches):
        from pyspark import TaskContext

        tokenize = per_worker(("word ids", path), lambda: WordIds(path))
        bins, number = Harmonic(capacity, classes), TaskContext.get().partitionId() << 40
        out = [[] for _ in schema]

        def batch():
            made = pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(out, schema)], schema=schema)
            for x in out:
                x.clear()
            return made

        for got in batches:
            doc_ids = got.column(0).to_pylist()
            buf, offsets = text_bytes(got.column(1))
            for a, b in slices(offsets, batch_bytes):
                ids, sizes = tokenize(buf[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                at = 0
                for doc_id, n in zip(doc_ids[a:b], sizes.tolist()):
                    own = np.append(ids[at: at + n], np.uint32(end_id)).astype("<u4", copy=False)
                    at += n
                    for sequence in bins.add((doc_id, own), len(own)):
                        rows(number, sequence, out)
                        number += 1
                if out[0]:
                    yield batch()
        for sequence in bins.finish():
            rows(number, sequence, out)
            number += 1
        if out[0]:
            yield batch()

    return run


def pack_harmonic(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 2, classes: int = 64,
                  id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = 1 << 20, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ``ids`` on request).

    A document is its ids and ``end_id``; a NULL or empty text is the end id alone.  Rows
    that repeat an id are documents of their own; a NULL id is an id like any other.  An
    empty table gives no row.  ``capacity`` must be a power of two.  Sequences are numbered by input partition, so ``docs``
    should be a table or another input whose partitions a retry reads alike.
    """
    if capacity & capacity - 1:
        raise ValueError("capacity must be a power of two")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_pack(tokenizer_path, capacity, end_id, classes, batch_bytes, with_ids), PIECES + ", ids array<long>" * with_ids)


def sequences(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """One row per sequence: sequence_id, n_pieces, n_tokens and the padding it needs (0 at a power of two)."""
    n = F.col("n_tokens")
    rows = pieces.groupBy("sequence_id").agg(F.count(F.lit(1)).alias("n_pieces"), F.sum("length").alias("n_tokens"))
    return rows.withColumn("padding", F.when(n.bitwiseAND(n - 1) == 0, F.lit(0)).otherwise(F.lit(capacity) - n))
