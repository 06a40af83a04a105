"""Toxicity by a convolutional text classifier, trained in numpy by shards of all labelled texts.

A word's embedding is the sum of hashed rows for the word and for its first few bytes.
Filters of several widths run over a document's words, each filter keeps its largest
response anywhere in the text (max pooling), and a logistic layer reads the responses.
Scores are calibrated on a held-back part of the texts so that 0.3 is the operating
point; per-language thresholds on top are calibrated the same way.
"""
from __future__ import annotations

import copy
import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoline.llm.common import WordHasher, ascii_fold, slices, text_bytes, written

WIDTHS = (1, 2, 3)
FILTERS = 16
DIM = 8
#: hash buckets of whole words, then of word prefixes of so many bytes
BUCKETS = 1 << 15
PREFIXES = (4, 6, 8)
KINDS = 1 + len(PREFIXES)
OPERATING_POINT = 0.3


class Words:
    """Rows of the embedding table for the words of texts."""

    def __init__(self):
        b = np.arange(256)
        letters = (b >= 0x80) | ((b >= ord("0")) & (b <= ord("9"))) | ((b | 32) >= ord("a")) & ((b | 32) <= ord("z"))
        self.hasher = WordHasher(letters, ascii_fold())

    def __call__(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """((words, kinds) rows, word offsets of each text); words do not cross texts."""
        n = len(offsets) - 1
        padded = np.full(len(buf) + n, 32, np.uint8)  # a blank after each text
        padded[np.arange(len(buf)) + np.repeat(np.arange(n), np.diff(offsets))] = buf
        starts, ends, words = self.hasher(padded)
        at = np.searchsorted(starts, offsets + np.arange(n + 1))
        if not len(starts):
            return np.zeros((0, 1 + len(PREFIXES)), np.int32), at
        kinds = [words] + [self.hasher.between(starts, np.minimum(ends, starts + k)) for k in PREFIXES]
        mask = np.uint64(BUCKETS - 1)
        return np.stack([(h & mask).astype(np.int32) + np.int32(i * BUCKETS) for i, h in enumerate(kinds)], 1), at


@dataclass
class ToxicityModel:
    """About 4 MB of float32 parameters; ``threshold`` has a value per language and ``None`` for others."""

    table: np.ndarray  # (kinds * BUCKETS, DIM)
    kernels: dict[int, np.ndarray]  # width -> (width, DIM, FILTERS)
    biases: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: float
    scale: float = 1.0
    shift: float = 0.0
    threshold: dict = field(default_factory=lambda: {None: OPERATING_POINT})

    def responses(self, rows: np.ndarray, at: np.ndarray):
        """Per width: response of every filter at every word; a text is followed by empty words."""
        pad = max(WIDTHS) - 1
        n = len(at) - 1
        emb = np.zeros((len(rows) + (n * pad), DIM), np.float32)
        place = np.arange(len(rows)) + np.repeat(np.arange(n) * pad, np.diff(at))
        emb[place] = self.table[rows].sum(1)
        for w in WIDTHS:
            total = emb @ self.kernels[w][0]
            for j in range(1, w):
                total[:-j] += emb[j:] @ self.kernels[w][j]
            yield w, total, at + np.arange(n + 1) * pad

    def logits(self, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        pooled = []
        for w, total, starts in self.responses(rows, at):
            best = np.maximum.reduceat(total, starts[:-1], axis=0) if len(total) else np.zeros((len(at) - 1, FILTERS), np.float32)
            best[np.diff(at) == 0] = 0
            pooled.append(np.maximum(best + self.biases[w], 0))
        return np.concatenate(pooled, 1) @ self.out + self.out_bias

    def score(self, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        z = np.clip(self.scale * self.logits(rows, at) + self.shift, -30, 30)
        return (1 / (1 + np.exp(-z))).astype(float)


def _best_threshold(scores: np.ndarray, labels: np.ndarray, counts: np.ndarray, among: np.ndarray) -> float:
    """The threshold of best F1, in the middle of its gap; ``counts`` texts, ``labels`` of them
    toxic, have each score, ``among`` gives the candidates."""
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum(labels[order])
    f1 = 2 * hits / (np.cumsum(counts[order]) + max(1, labels.sum()))
    k = int(np.argmax(f1))
    low = scores[order[k + 1]] if k + 1 < len(order) else among.min()
    return float((scores[order[k]] + low) / 2)


def _start(seed: int) -> tuple[np.random.Generator, ToxicityModel]:
    rng = np.random.default_rng(seed)
    shape = lambda *s: (rng.standard_normal(s) * 0.2).astype(np.float32)
    return rng, ToxicityModel(shape(KINDS * BUCKETS, DIM) * 0.2, {w: shape(w, DIM, FILTERS) for w in WIDTHS},
                              {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}, np.abs(shape(len(WIDTHS) * FILTERS)), -2.0)


def _first_squares(model: ToxicityModel) -> dict:
    squares = {"table": np.full((len(model.table), 1), 1e-3, np.float32), "out": np.full(len(model.out), 1e-3, np.float32), "bias": 1e-3}
    return squares | {("k", w): np.full_like(model.kernels[w], 1e-3) for w in WIDTHS} | {("b", w): np.full(FILTERS, 1e-3, np.float32) for w in WIDTHS}


def _pass(model: ToxicityModel, squares: dict, live: np.ndarray, words: list, labels: np.ndarray, weight: np.ndarray,
          order: np.ndarray, rate: float, batch: int) -> np.ndarray:
    """One pass of Adagrad over texts in ``order``, in place; the rows of the table that it changed."""
    touched = np.zeros(len(model.table), bool)

    def step(value, grad, square):  # Adagrad
        square += grad * grad
        value -= rate * grad / np.sqrt(square)

    for part in np.array_split(order, max(1, len(order) // batch)):
        own = [_rows(words[i]) for i in part]
        sub = np.concatenate([[0], np.cumsum([len(r) for r in own])]).astype(np.int64)
        flat = np.concatenate(own) if own else np.zeros((0, KINDS), np.int32)
        best, where = [], []
        for w, total, starts in model.responses(flat, sub):
            spot = np.zeros((len(part), FILTERS), np.int64)
            for k in range(len(part)):
                if sub[k + 1] > sub[k]:
                    spot[k] = total[starts[k]: starts[k] + sub[k + 1] - sub[k]].argmax(0)
            where.append(spot)
            peak = np.take_along_axis(total, starts[:-1, None] + spot, 0) if len(total) else np.zeros(spot.shape, np.float32)
            peak[np.diff(sub) == 0] = 0
            best.append(np.maximum(peak + model.biases[w], 0))
        hidden = np.concatenate(best, 1)
        z = np.clip(hidden @ model.out + model.out_bias, -30, 30)
        delta = (weight[part] * (1 / (1 + np.exp(-z)) - labels[part]) / max(1, len(part))).astype(np.float32)
        back = np.where(hidden > 0, delta[:, None] * model.out, 0).astype(np.float32)
        step(model.out, hidden.T @ delta + 1e-5 * model.out, squares["out"])
        squares["bias"] += float(delta.sum()) ** 2
        model.out_bias -= rate * float(delta.sum()) / squares["bias"] ** 0.5
        ids, grads = [], []
        for i, w in enumerate(WIDTHS):
            g = back[:, i * FILTERS: (i + 1) * FILTERS]
            step(model.biases[w], g.sum(0), squares["b", w])
            kernel_grad = np.zeros_like(model.kernels[w])
            for j in range(w):
                spot = where[i] + j
                k, f = np.nonzero((spot < np.diff(sub)[:, None]) & (g != 0))
                r = flat[sub[k] + spot[k, f]]
                emb = model.table[r].sum(1)
                np.add.at(kernel_grad[j].T, f, emb * g[k, f, None])
                ids.append(r)
                grads.append(model.kernels[w][j].T[f] * g[k, f, None])
            step(model.kernels[w], kernel_grad, squares["k", w])
        r = np.concatenate(ids)
        used, inverse = np.unique(r, return_inverse=True)
        total = np.zeros((len(used), DIM), np.float32)
        np.add.at(total, inverse.reshape(r.shape).ravel(), np.repeat(np.concatenate(grads), KINDS, 0))
        total *= live[used, None]
        squares["table"][used] += (total * total).mean(1, keepdims=True)
        model.table[used] -= rate * total / np.sqrt(squares["table"][used])
        touched[used] = True
    return np.flatnonzero(touched)


# --- the labelled texts as words, in shards --------------------------------------
_WORDS = pa.schema([("shard", pa.int32()), ("lang", pa.string()), ("toxic", pa.int32()), ("held", pa.bool_()), ("words", pa.binary())])


def _rows(words: bytes) -> np.ndarray:
    """(words, kinds) rows of the embedding table from their stored form (two bytes a bucket)."""
    return np.frombuffer(words, np.uint16).reshape(-1, KINDS).astype(np.int32) + np.arange(KINDS, dtype=np.int32) * BUCKETS


def _to_words(batches):
    """Task over marks and texts sorted by (shard, place, id), the mark of an id before its texts: the words of the
    first text of every marked id; every fifth of a shard is held back."""
    words, shard, place, marked = Words(), None, 0, (None, None)
    for batch in batches:
        keep, toxic = [], []
        for own, mark in zip(batch.column("id").to_pylist(), batch.column("toxic").to_pylist()):
            if mark is not None:
                marked = (own, mark)
            elif own == marked[0]:
                toxic.append(marked[1])
                marked = (None, None)
                keep.append(True)
                continue
            keep.append(False)
        batch = batch.filter(pa.array(keep, pa.bool_()))
        for a in range(0, len(batch), 100):
            part = batch.slice(a, 100)
            rows, at = words(*text_bytes(part.column("text")))
            rows = (rows & np.int32(BUCKETS - 1)).astype(np.uint16)
            held = []
            for own in part.column("shard").to_pylist():
                shard, place = own, place + 1 if own == shard else 0
                held.append(place % 5 == 4)
            texts = [rows[i:j].tobytes() for i, j in zip(at[:-1], at[1:])]
            columns = [part.column("shard"), part.column("lang"), pa.array(toxic[a: a + 100]), pa.array(held), pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays([c.cast(t.type) for c, t in zip(columns, _WORDS)], schema=_WORDS)


def _by_shard(batches):
    """(shard, labels, held, words) of every shard of a task; only one is in memory."""
    shard, labels, held, words = None, [], [], []
    for batch in batches:
        for own, label, back, text in zip(*[batch.column(c).to_pylist() for c in ("shard", "toxic", "held", "words")]):
            if own != shard:
                if words:
                    yield shard, np.array(labels, np.int64), np.array(held), words
                shard, labels, held, words = own, [], [], []
            labels.append(label)
            held.append(back)
            words.append(text)
    if words:
        yield shard, np.array(labels, np.int64), np.array(held), words


def _seen(batches):
    """Task over words: how many texts hold each row of the embedding table."""
    seen = np.zeros(KINDS * BUCKETS, np.int64)
    for batch in batches:
        for words in batch.column("words"):
            seen[np.unique(_rows(words.as_py()))] += 1
    rows = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array(seen[rows])], ["row", "n"])


#: a changed row of the table with its sum of squares, or so many other parameters (rows below 0)
_CELLS = [f"v{i}" for i in range(DIM + 1)]


def _others(model: ToxicityModel, squares: dict) -> list[np.ndarray]:
    return [model.out, squares["out"], *[x for w in WIDTHS for x in (model.kernels[w], squares["k", w], model.biases[w], squares["b", w])]]


def _learned(model: ToxicityModel, squares: dict, touched: np.ndarray) -> pa.RecordBatch:
    flat = np.concatenate([np.array([model.out_bias, squares["bias"]]), *[x.ravel() for x in _others(model, squares)]])
    dense = np.concatenate([flat, np.zeros(-len(flat) % len(_CELLS))]).reshape(-1, len(_CELLS))
    cells = np.concatenate([np.column_stack([model.table[touched], squares["table"][touched]]).astype(float), dense])
    rows = np.concatenate([touched, -1 - np.arange(len(dense))]).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(rows), *[pa.array(c) for c in cells.T]], ["row", *_CELLS])


def _take(model: ToxicityModel, squares: dict, rows: np.ndarray, cells: np.ndarray) -> None:
    """The mean of what the shards learned into ``model`` and ``squares``; a table row is the mean of those that changed it."""
    table = rows >= 0
    model.table[rows[table]] = cells[table, :DIM]
    squares["table"][rows[table]] = cells[table, DIM:]
    flat = cells[~table][np.argsort(-rows[~table])].ravel()
    model.out_bias, squares["bias"] = float(flat[0]), float(flat[1])
    at = 2
    for x in _others(model, squares):
        x[...] = flat[at: at + x.size].reshape(x.shape)
        at += x.size


def _epoch(model: ToxicityModel, squares: dict, live: np.ndarray, all_rows: bool, toxic_weight: float, epoch: int, seed: int, rate: float, batch: int):
    def run(batches):
        for shard, labels, held, words in _by_shard(batches):
            own, sums = copy.deepcopy((model, squares))
            train = np.arange(len(words)) if all_rows else np.flatnonzero(~held)
            rng = _start(seed + shard)[0]
            for _ in range(epoch + 1):
                order = rng.permutation(train)
            weight = np.where(labels == 1, toxic_weight, 1.0).astype(np.float32)
            yield _learned(own, sums, _pass(own, sums, live, words, labels, weight, order, rate, batch))

    return run


#: logits of the texts held back are counted in steps of 1 / _STEPS
_STEPS = 4096


def _logits(model: ToxicityModel):
    def run(batches):
        for batch in batches:
            z = [model.logits(r, np.array([0, len(r)]))[0] for r in (_rows(w.as_py()) for w in batch.column("words"))]
            steps = np.round(np.clip(np.array(z, float), -60, 60) * _STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("toxic"), pa.array(steps)], ["lang", "toxic", "step"])

    return run


def _calibrate(model: ToxicityModel, checked: DataFrame) -> None:
    """Scale, shift and thresholds from the counts of all ``checked`` texts by language and logit."""
    counted = checked.mapInArrow(_logits(model), "lang string, toxic int, step long").groupBy("lang", "step").agg(
        F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("hits")).toArrow()
    langs = np.array(counted["lang"].to_pylist(), object)
    steps, n, hits = (counted[c].to_numpy() for c in ("step", "n", "hits"))
    steps, place = np.unique(steps, return_inverse=True)
    z = steps / _STEPS
    total = lambda values, own: np.bincount(place[own], values[own], len(z)).astype(np.int64)
    everyone = np.ones(len(place), bool)
    sizes, toxic = total(n, everyone), total(hits, everyone)
    mean = np.average(z, weights=sizes)
    model.scale = min(1.0, 4.0 / max(1e-3, float(np.average((z - mean) ** 2, weights=sizes) ** 0.5)))
    cut = _best_threshold(z, toxic, sizes, z)
    model.shift = float(np.log(OPERATING_POINT / (1 - OPERATING_POINT)) - model.scale * cut)
    scores = 1 / (1 + np.exp(-np.clip(model.scale * z + model.shift, -30, 30)))
    for lang in sorted({x for x in langs if x is not None}):
        sizes, toxic = total(n, langs == lang), total(hits, langs == lang)
        there = sizes > 0
        if toxic.sum() >= 10:
            model.threshold[lang] = _best_threshold(scores[there], toxic[there], sizes[there], scores)


#: bits of the filter that keeps texts without a label where they are (4 MB, whatever the input)
FILTER_BITS = 1 << 25


def _slot(id_col: str):
    """(word, bit) of an id in the filter: 64 bits to a word."""
    slot = F.pmod(F.xxhash64(F.lit("toxicity filter"), id_col), F.lit(FILTER_BITS))
    return F.shiftright(slot, 6), F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))


def labelled_words(docs: DataFrame, labels: DataFrame, shard_docs: int = 8_000, id_col: str = "doc_id",
                   text_col: str = "text", lang_col: str | None = None) -> DataFrame:
    """All labelled documents, one row an id, as words in shards of about ``shard_docs``, written.

    Texts move once, with the labels, to their shard: a filter over the labels' ids (bits by a
    hash; where it fills up more texts pass, never fewer) keeps others in place, and the
    tasks of the shards match ids exactly.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                        (F.col(lang_col) if lang_col else F.lit(None)).cast("string").alias("lang"))
    marks = labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    kind = texts.select("id").unionAll(marks.select("id")).schema["id"].dataType
    marks = written(marks.withColumn("id", F.col("id").cast(kind)), "toxicity-marks")
    shards = max(1, math.ceil(marks.count() / shard_docs))
    own, bit = _slot("id")
    bits = marks.groupBy(own.alias("slot")).agg(F.bit_or(bit).alias("bits"))
    some = texts.withColumn("id", F.col("id").cast(kind)).join(F.broadcast(bits), (own == F.col("slot")) & (bit.bitwiseAND(F.col("bits")) != 0))
    place = F.pmod(F.xxhash64(F.lit("toxicity sample"), "id"), F.lit(1 << 30))
    rows = (
        some.select("id", "text", "lang", F.lit(None).cast("int").alias("toxic"))
        .unionAll(marks.select("id", F.lit(None).cast("string"), F.lit(None).cast("string"), "toxic"))
        .withColumn("place", place).withColumn("shard", (F.col("place") % shards).cast("int"))
        .withColumn("id", F.col("id").cast("string")).repartitionById(shards, "shard")
        .sortWithinPartitions("shard", "place", "id", F.col("toxic").isNull(), "text", "lang")
    )
    return written(rows.mapInArrow(_to_words, "shard int, lang string, toxic int, held boolean, words binary"), "toxicity-words", compression="zstd")


def train_toxicity(docs: DataFrame, labels: DataFrame, shard_docs: int = 8_000, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str | None = None, epochs: int = 6, seed: int = 5, rate: float = 0.05, batch: int = 32) -> ToxicityModel:
    """Fit on all labelled documents; every fifth one of a shard is held back to calibrate.

    ``labels`` has the id and ``toxic`` (0 or 1; NULLs are not used; an id labelled twice
    is toxic if one label says so).  The documents lie in shards of about ``shard_docs``, by a
    hash of the id.  In every epoch each shard makes one pass over its texts from the common
    parameters, and their means over the shards are the next common ones: the driver
    sees sums by parameter only.  Without rows, or with one class only, every score is the
    same.  ``lang_col`` serves the per-language thresholds alone.
    """
    rows = labelled_words(docs, labels, shard_docs, id_col, text_col, lang_col)
    found = {r["held"]: r for r in rows.groupBy("held").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).collect()}
    n, toxic = (sum(r[c] for r in found.values()) for c in ("n", "toxic"))
    _, model = _start(seed)
    if toxic in (0, n):
        model.out[:], model.out_bias = 0, -30.0 if toxic == 0 else 30.0
        return model
    # rows that fewer than three texts hold say nothing about other texts
    counts = rows.mapInArrow(_seen, "row int, n long").groupBy("row").agg(F.sum("n").alias("n")).where("n >= 3").toArrow()
    live = np.zeros(KINDS * BUCKETS, np.float32)
    live[counts["row"].to_numpy()] = 1
    model.table[live == 0] = 0
    all_rows = n < 50 or True not in found or found[True]["toxic"] in (0, found[True]["n"])
    share = toxic / n if all_rows else found[False]["toxic"] / found[False]["n"]
    toxic_weight = min(5.0, 0.5 / max(share, 0.02))
    squares = _first_squares(model)
    for epoch in range(epochs):
        learned = rows.mapInArrow(_epoch(model, squares, live, all_rows, toxic_weight, epoch, seed, rate, batch),
                                  "row int, " + ", ".join(f"{c} double" for c in _CELLS))
        sums = learned.groupBy("row").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in _CELLS]).toArrow()
        _take(model, squares, sums["row"].to_numpy(), np.column_stack([sums[c].to_numpy() for c in _CELLS]) / sums["n"].to_numpy()[:, None])
    _calibrate(model, rows if all_rows else rows.where("held"))
    return model


def toxicity_column(model: ToxicityModel, text, batch_bytes: int = 1 << 18):
    """A score column (0 to 1) for a text column; whole texts, NULL as empty."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        words = Words()
        buf, offsets = text_bytes(pa.array(texts.tolist(), pa.string()))
        parts = [model.score(*words(buf[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])) for a, b in slices(offsets, batch_bytes)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return score(text)


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", lang_col: str | None = None) -> DataFrame:
    """``docs`` with score, threshold (of the row's language, else the general one) and toxic.

    Input columns of those names are replaced.  No shuffle: texts are scored where read.
    """
    general = F.lit(float(model.threshold[None]))
    known = [F.lit(x) for k, v in model.threshold.items() if k is not None for x in (k, float(v))]
    limit = F.coalesce(F.create_map(*known)[F.col(lang_col)], general) if lang_col and known else general
    new = ("score", "threshold", "toxic")
    out = docs.withColumn("__limit", limit).withColumn("__score", toxicity_column(model, F.col(text_col)))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new], F.col("__score").alias("score"),
                      F.col("__limit").alias("threshold"), (F.col("__score") >= F.col("__limit")).alias("toxic"))
