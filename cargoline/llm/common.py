"""Helpers shared by the training-data operators."""
from __future__ import annotations

import os
import sys
import types
import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoline.session import checkpoint_dir


def written(df: DataFrame, label: str, **options) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder (``options`` of the writer) and read it back.

    Cuts the lineage: a lost executor rereads files instead of recomputing, and a
    frame that is used twice is computed once.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), f"llm-{label}-{uuid.uuid4().hex[:12]}")
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def per_worker(key: tuple, make):
    """``make()``, kept in the Python worker process from task to task."""
    held = sys.modules.setdefault("cargoline_llm_worker", types.ModuleType("cargoline_llm_worker")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(id_col: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus`` (a NULL id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


_MASK64 = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), elementwise on uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHasher:
    """Word boundaries and 64-bit word hashes of a byte buffer, all in numpy.

    A byte belongs to a word where ``is_word[byte]``; ``fold`` maps bytes before
    hashing (case folding).  A word's hash is a polynomial in an odd base over its
    bytes, taken from a prefix sum and then mixed.
    """

    _BASE = 0x9E3779B97F4A7C15

    def __init__(self, is_word: np.ndarray, fold: np.ndarray):
        self.is_word = is_word
        rng = np.random.default_rng(20240229)
        self.value = rng.integers(1, 2**63, 256, dtype=np.uint64)[fold]
        self._powers(1 << 16)

    def _powers(self, n: int) -> None:
        inverse = pow(self._BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, self._BASE, np.uint64)]), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, inverse, np.uint64)]), dtype=np.uint64)

    def __call__(self, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, hashes) of the words of ``buf`` (uint8)."""
        inside = self.is_word[buf]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        if not len(starts):
            return starts, ends, np.empty(0, np.uint64)
        if len(buf) >= len(self.up):
            self._powers(2 * len(buf))
        prefix = np.zeros(len(buf) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(self.value[buf] * self.up[: len(buf)], out=prefix[1:], dtype=np.uint64)
            self.prefix = prefix
            return starts, ends, self.between(starts, ends)

    def between(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the byte ranges [start, end) of the buffer hashed last."""
        with np.errstate(over="ignore"):
            raw = (self.prefix[ends] - self.prefix[starts]) * self.down[starts]
            return mix64(raw + (ends - starts).astype(np.uint64))


def ascii_fold() -> np.ndarray:
    fold = np.arange(256)
    fold[ord("A"): ord("Z") + 1] += 32
    return fold


def text_bytes(texts) -> tuple[np.ndarray, np.ndarray]:
    """A pyarrow string array as (bytes, offsets); a NULL is an empty text."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    arr = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset: arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, budget: int):
    """Row ranges [a, b) whose bytes stay near ``budget`` (a longer row is alone)."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + budget, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def short_keys(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(which, low, high): the ranges under 16 bytes, each held exactly by two 64-bit words."""
    which = np.flatnonzero(lengths < 16)
    padded = np.concatenate([buf, np.zeros(16, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 16)[starts[which]].copy()
    words[np.arange(16) >= lengths[which, None]] = 0
    words[:, 15] = lengths[which]
    low, high = np.ascontiguousarray(words).view(np.uint64).T if len(which) else np.zeros((2, 0), np.uint64)
    return which, low, high


def group_keys(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, inverse, odd): one place per distinct key, the key of each place, and the
    places whose key shares its hash with another one (to be handled singly)."""
    _, first, inverse = np.unique(mix64(low + mix64(high)), return_index=True, return_inverse=True)
    return first, inverse, np.flatnonzero((low != low[first][inverse]) | (high != high[first][inverse]))
