"""Vector codes by equal-average search: product codebooks in integers.

A vector's components become floor(scale * x) and are cut into equal consecutive parts.
Each part position has a codebook that starts from the vectors of the smallest ids and is
refined in a few rounds: parts go to their nearest entry, entries become the floored mean
of their parts.  The search orders a codebook by component sum.  For n components
(sum difference)^2 / n is a lower bound of the squared distance, so a part starts at its
own sum and goes outward on both sides until that bound strictly exceeds its best distance.

A round is one pass over the rows: tasks send one sum and count per entry and component,
whatever the number of rows.  Only codebooks (entries x dimension numbers) reach the driver.
All arithmetic is exact: values too large for it raise an error.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoline.llm.common import written

#: labels up to this number are broadcast (some tens of bytes each); beyond, they are joined salted
BROADCAST_LABELS = 100_000
_SALTS = 64
_BLOCK = 4096


def nearest(vectors: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of each vector's nearest entry of ``book``, ties to the lower index."""
    n, d = vectors.shape
    most = max(int(np.abs(vectors).max(initial=0)), int(np.abs(book).max(initial=0)))
    small = max(d, 1) * (2 * most + 1) ** 2 < 2**31
    kind = np.int32 if small else np.int64
    vectors, book = vectors.astype(kind), book.astype(kind)
    sums = book.sum(1, dtype=np.int64)
    order = np.argsort(sums, kind="stable")
    sums, entries = sums[order], book[order]
    index, best = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max)
    for at in range(0, n, _BLOCK):
        _outward(vectors[at: at + _BLOCK], entries, sums, order, index[at: at + _BLOCK], best[at: at + _BLOCK])
    return index, best


def _outward(vectors, entries, sums, order, index, best) -> None:
    """Fill ``index`` and ``best`` of one block: one entry a side and step, until both sides have stopped."""
    d = max(vectors.shape[1], 1)
    own = vectors.sum(1, dtype=np.int64)
    place = np.searchsorted(sums, own)
    rows = [np.arange(len(vectors)), np.arange(len(vectors))]
    step = 0
    while len(rows[0]) or len(rows[1]):
        for side in (0, 1):
            row = rows[side]
            entry = place[row] + step if side == 0 else place[row] - 1 - step
            inside = entry < len(sums) if side == 0 else entry >= 0
            row, entry = row[inside], entry[inside]
            gap = np.abs(sums[entry] - own[row])
            go = gap * gap <= np.minimum(best[row], np.iinfo(np.int64).max // d) * d  # bound gap^2 / d, not above best
            row, entry = row[go], entry[go]
            rows[side] = row
            if len(row):
                away = vectors[row] - entries[entry]
                distance = np.einsum("ij,ij->i", away, away).astype(np.int64)
                found = order[entry]
                better = (distance < best[row]) | (distance == best[row]) & (found < index[row])
                index[row[better]], best[row[better]] = found[better], distance[better]
        step += 1


def _matrix(column, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), dim)


def _tally(books: np.ndarray):
    """Task: sums and counts of the parts that go to each entry."""
    parts, entries, width = books.shape
    names = ["part", "entry", "position", "total", "n"]

    def run(batches):
        total, count = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            vectors = _matrix(batch.column(0), parts * width)
            for p in range(parts):
                own = vectors[:, p * width: (p + 1) * width]
                index, _ = nearest(own, books[p])
                order = np.argsort(index, kind="stable")
                used, first = np.unique(index[order], return_index=True)
                if len(used):
                    total[p, used] += np.add.reduceat(own[order], first, axis=0)
                    count[p] += np.bincount(index, minlength=entries)
        p, e = np.nonzero(count)
        if len(p):
            columns = (np.repeat(p, width), np.repeat(e, width), np.tile(np.arange(width), len(p)), total[p, e].ravel(), np.repeat(count[p, e], width))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return run


def _code(books: np.ndarray, schema: pa.Schema):
    """Task: code and error of each vector, beside its other columns."""
    parts, _, width = books.shape

    def run(batches):
        for batch in batches:
            vectors = _matrix(batch.column(0), parts * width)
            found = [nearest(vectors[:, p * width: (p + 1) * width], books[p]) for p in range(parts)]
            codes = np.stack([i for i, _ in found], 1).astype(np.uint8)
            text = pa.array([bytes(c).hex() for c in codes], pa.string())
            error = pa.array(sum(e for _, e in found), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], text, error], schema=schema)

    return run


def _refined(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    sums = (rows.select("v").mapInArrow(_tally(books), "part long, entry long, position long, total long, n long")
            .groupBy("part", "entry", "position").agg(F.sum("total").alias("total"), F.sum("n").alias("n")))
    books = books.copy()
    for r in sums.collect():  # at most parts x entries x width rows
        books[r["part"], r["entry"], r["position"]] = r["total"] // r["n"]
    return books


def codebooks_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> tuple[DataFrame, np.ndarray]:
    """(rows, codebooks): per kept vector its id, label, code, error and label_error; codebooks by part, entry, position.

    Rows go whose vector is NULL or holds a NULL or non-finite component.  NULL ids sort
    last and are kept, rows that repeat an id are vectors of their own (for the first
    codebook in the order of id and vector), NULL labels are one group.  Fewer vectors than
    ``entries`` give that many entries.  An empty table gives no rows and empty codebooks.
    Vectors of unequal dimension, a dimension that the parts do not divide, and values so
    large that a bound passes 64 bits raise a ValueError; ``entries`` is 256 at most.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be in 1 .. 256")
    vector = F.col(f"`{vector_col}`")
    good = vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    value = lambda x: F.floor(x.cast("double") * scale)
    bounded = lambda x: F.abs(x.cast("double") * scale) < 2.0**52
    kept = df.where(good).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"),
                                 F.forall(vector, bounded).alias("fits"), vector)
    v = F.when(F.col("fits"), F.transform(F.col(f"`{vector_col}`"), value))
    rows = written(kept.select("id", "label", v.alias("v")), "vectors")
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("fit"), F.min(F.size("v")).alias("low"), F.max(F.size("v")).alias("dim"),
                    F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("most")).first()
    dim = seen["dim"] or 0
    if seen["n"] and (seen["low"] != dim or dim % parts):
        raise ValueError(f"vectors must have one dimension that {parts} divides; found {seen['low']} to {dim}")
    if seen["fit"] < seen["n"] or (dim * (2 * (seen["most"] or 0) + 1)) ** 2 >= 2**63:
        raise ValueError("components are too large for exact distances and bounds of 64 bits")
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").select("v").limit(entries).collect()  # the first codebook
    books = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, dim // parts).transpose(1, 0, 2)
    for _ in range(rounds if first else 0):
        books = _refined(rows, books)

    coded = _coded(rows, books) if first else rows.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    out = _with_label_error(coded)
    return out.select(F.col("id").alias(id_col), F.col("label").alias(label_col), "code", "error", "label_error"), books


def _coded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType, StringType

    plain = rows.select("v", "id", "label")
    spark_schema = plain.drop("v").schema.add("code", StringType()).add("error", LongType())
    return written(plain.mapInArrow(_code(books, to_arrow_schema(spark_schema)), spark_schema), "vector-codes")


def _with_label_error(coded: DataFrame) -> DataFrame:
    """The error summed over equal labels: one row a label, joined back without moving a label's vectors to one task."""
    sums = written(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    sums = sums.withColumnRenamed("label", "of")
    if sums.count() <= BROADCAST_LABELS:
        return coded.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col("of")), "left")
    salted = coded.withColumn("salt", F.pmod(F.hash("id", "code"), F.lit(_SALTS)))
    sums = sums.withColumn("grain", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return salted.join(sums, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("grain")), "left")
