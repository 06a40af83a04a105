"""Best-fit packing of tokenized documents into sequences of a fixed length.

Each document becomes its token ids and an end id; one longer than a sequence is cut
into full pieces and a rest.  Pieces are then dealt to as many partitions as whole sets
of open bins fill, and every partition packs its pieces in one pass, longest first, by
bounded-space best fit: a fixed number of open bins in a bitset keyed by free space.  A
piece goes to the open bin with the least room that still fits; where none fits and all
bins are open, the fullest one closes.
"""
from __future__ import annotations

import json
import math
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoline.llm.common import group_keys, mix64, per_worker, short_keys, slices, text_bytes, written

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class BestFit:
    """Bounded-space online best fit over bins of ``capacity``."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by free space
        self.bits = 0  # bit f is set where a bin with f free is open
        self.n_open = self.n_bins = 0

    def _take(self, free: int) -> int:
        row = self.bins[free]
        number = row.pop()
        if not row:
            self.bits &= ~(1 << free)
        self.n_open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece of 1 .. capacity tokens."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.n_open >= self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            number, free = self.n_bins, self.capacity
            self.n_bins += 1
        left = free - length
        if left:
            self.bins[left].append(number)
            self.bits |= 1 << left
            self.n_open += 1
        return number, self.capacity - free


#: what the splitter below reproduces; any other pipeline goes to the library text by text
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: below this code point no character composes with its neighbour, and all but the dotted
#: capital I become one character in lower case
_PLAIN_BELOW = 0x300
_DOTTED_I = "\u0130".encode()


def _room(x: np.ndarray, n: int) -> np.ndarray:
    """``x``, or a longer copy of it with room for n entries."""
    return x if n <= len(x) else np.concatenate([x, np.zeros(max(len(x), n - len(x)), x.dtype)])


class WordIds:
    """Token ids of whole texts by a BPE with word ends, remembered by pre-token.

    Texts of code points below U+0300 are split here in numpy, as the file's own pattern
    does after lowering, and every distinct pre-token goes once through the library's
    model.  Texts with other code points or with a special token's string go through the
    library as a whole.

    What is remembered lies in arrays: a pre-token of up to 15 bytes is found by binary
    search among the sorted hashes and compared in full; a longer one, or one that shares its
    hash with another, by a dictionary.
    """

    def __init__(self, path: str, remember: int = 400_000):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        steps = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        split = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.known_form = (steps == ["NFC", "Replace", "Lowercase"] and split[0].get("pattern") == {"Regex": _PATTERN}
                           and [x["type"] for x in split] == ["Split", "ByteLevel"])
        self.marks = [t["content"].encode() for t in spec["added_tokens"]]
        self.kind = np.zeros(_PLAIN_BELOW, np.uint8)  # 0 other, 1 letter, 2 number, 3 white space
        for c in range(_PLAIN_BELOW):
            for kind, pattern in ((1, r"\p{L}"), (2, r"\p{N}"), (3, r"\s")):
                if regex.fullmatch(pattern, chr(c)):
                    self.kind[c] = kind
        letters = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # the format's stand-ins of bytes
        rest = [b for b in range(256) if b not in set(letters)]
        self.letters = {b: chr(b) for b in letters} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.remember = remember
        self._clear()

    def _clear(self):
        # by code: the key's two words, and where its ids are; code 0 is no pre-token's
        self.low, self.high = np.zeros((2, 1 << 12), np.uint64)
        self.begin, self.size = np.zeros((2, 1 << 12), np.int64)
        self.known = 1
        self.flat = np.empty(1 << 16, np.uint32)
        self.used = 0
        self.hashes, self.code_of = np.array([0xFFFFFFFFFFFFFFFF], np.uint64), np.zeros(1, np.int64)  # sorted by hash
        self.single: dict[bytes, int] = {}

    def _pre_tokens(self, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Starts of the pre-tokens (runs of white space among them) of texts joined in ``codes``."""
        kind = self.kind[codes]
        begins = np.empty(len(codes), bool)
        begins[0] = True
        np.not_equal(kind[1:], kind[:-1], out=begins[1:])
        begins |= kind == 2
        begins[bounds[:-1][bounds[:-1] < len(codes)]] = True
        quotes = np.flatnonzero((codes == ord("'")) & begins)
        if len(quotes):
            ends = bounds[np.searchsorted(bounds, quotes, "right")]
            at = lambda i: np.where(quotes + i < ends, codes[np.minimum(quotes + i, len(codes) - 1)] | 32, 0)
            one, two = at(1), at(2)
            letter = lambda c, s: np.isin(c, [ord(x) for x in s])
            short = letter(one, "stmd") & (self.kind[np.minimum(one, _PLAIN_BELOW - 1)] == 1)
            long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
            for which, n in ((short, 2), (long & ~short, 3)):
                q = quotes[which]
                for i in range(1, n):
                    begins[q + i] = False
                begins[(q + n)[q + n < len(codes)]] = True
        return np.flatnonzero(begins)

    def _learn(self, pieces: list[bytes], low=0, high=0) -> np.ndarray:
        """New codes of distinct pre-tokens, which hold no white space."""
        if not pieces:
            return np.empty(0, np.int64)
        lowered = b"\n".join(pieces).decode().lower().encode().decode("latin-1").translate(self.letters)
        tokenize = self.tokenizer.model.tokenize
        found = [[t.id for t in tokenize(x)] for x in lowered.split(self.letters[ord("\n")])]
        size = np.fromiter(map(len, found), np.int64, len(found))
        end, used = self.known + len(found), self.used + int(size.sum())
        self.low, self.high, self.begin, self.size = (_room(x, end) for x in (self.low, self.high, self.begin, self.size))
        self.flat = _room(self.flat, used)
        self.flat[self.used: used] = np.fromiter(chain.from_iterable(found), np.uint32, used - self.used)
        codes = np.arange(self.known, end)
        self.low[codes], self.high[codes], self.size[codes] = low, high, size
        self.begin[codes] = self.used + np.cumsum(size) - size
        self.known, self.used = end, used
        return codes

    def _codes(self, buf: np.ndarray, data: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The code of each pre-token; every distinct one is looked up once."""
        code = np.empty(len(starts), np.int64)
        which, low, high = short_keys(buf, starts, lengths)
        first, inverse, odd = group_keys(low, high)
        own_low, own_high = low[first], high[first]
        hashes = mix64(own_low + mix64(own_high))  # ascending
        at = np.searchsorted(self.hashes, hashes)
        found, there = self.code_of[at], self.hashes[at] == hashes
        other = there & ((self.low[found] != own_low) | (self.high[found] != own_high))
        new = np.flatnonzero(~there)
        begin = starts[which[first[new]]].tolist()
        end = [a + k for a, k in zip(begin, lengths[which[first[new]]].tolist())]
        found[new] = self._learn([data[a:b] for a, b in zip(begin, end)], own_low[new], own_high[new])
        self.hashes, self.code_of = np.insert(self.hashes, at[new], hashes[new]), np.insert(self.code_of, at[new], found[new])
        code[which] = found[inverse]
        rest = np.concatenate([which[odd], which[other[inverse]], np.flatnonzero(lengths >= 16)])
        pieces = [data[a:b] for a, b in zip(starts[rest].tolist(), (starts + lengths)[rest].tolist())]
        fresh = list({p: None for p in pieces if p not in self.single})
        self.single.update(zip(fresh, self._learn(fresh).tolist()))
        code[rest] = [self.single[p] for p in pieces]
        return code

    def __call__(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the UTF-8 texts buf[offsets[i]:offsets[i + 1]] one after the other, and the number of ids of each."""
        return self._split(buf, offsets) if self._plain(buf) else self._by_text(buf, offsets)

    def _split(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The fast way, for texts that are plain one by one."""
        n = len(offsets) - 1
        if not len(buf):
            return np.empty(0, np.uint32), np.zeros(n, np.int64)
        if self.known > self.remember:
            self._clear()
        data = buf.tobytes()
        codes = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
        at = np.flatnonzero((buf & 0xC0) != 0x80)
        first = self._pre_tokens(codes, np.searchsorted(at, offsets))
        starts = at[first]
        lengths = np.diff(starts, append=len(buf))
        real = self.kind[codes[first]] != 3
        starts, lengths = starts[real], lengths[real]
        code = self._codes(buf, data, starts, lengths)
        k = self.size[code]
        last = np.cumsum(k)
        total = int(last[-1]) if len(last) else 0
        ids = self.flat[np.arange(total) - np.repeat(last - k - self.begin[code], k)]
        owner = np.searchsorted(offsets, starts, "right") - 1
        return ids, np.bincount(owner, k, minlength=n).astype(np.int64)

    def _plain(self, buf: np.ndarray) -> bool:
        data = buf.tobytes()
        return self.known_form and not any(m in data for m in (*self.marks, _DOTTED_I)) and not bool((buf >= 0xCC).any())

    def _by_text(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The fast way for all texts where it holds, together, and the library for each of the others."""
        texts = [buf[a:b] for a, b in zip(offsets, offsets[1:])]
        plain = [self._plain(x) for x in texts]
        fast = [x for x, fits in zip(texts, plain) if fits]
        ids, n = self._split(np.concatenate([buf[:0], *fast]), np.cumsum([0, *map(len, fast)]))
        done = iter(np.split(ids, np.cumsum(n)[:-1]))
        encode = lambda x: self.tokenizer.encode(x.tobytes().decode(), add_special_tokens=False).ids
        ids = [next(done) if fits else np.array(encode(x), np.uint32) for x, fits in zip(texts, plain)]
        return np.concatenate(ids), np.array([len(x) for x in ids], np.int64)


def _cut(path: str, capacity: int, end_id: int, batch_bytes: int, with_ids: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
                       + [("ids", pa.list_(pa.int64()))] * with_ids)

    def run(batches):
        tokenize = per_worker(("word ids", path), lambda: WordIds(path))
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            buf, offsets = text_bytes(batch.column(1))
            for a, b in slices(offsets, batch_bytes):
                ids, sizes = tokenize(buf[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                out, at = [[] for _ in schema], 0
                for doc_id, n in zip(doc_ids[a:b], sizes.tolist()):
                    own = np.append(ids[at: at + n], np.uint32(end_id))
                    at += n
                    for i, start in enumerate(range(0, len(own), capacity)):
                        part = own[start: start + capacity].astype("<u4")
                        for column, value in zip(out, (doc_id, i, start, len(part), zlib.crc32(part.tobytes()), part)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(out, schema)], schema=schema)

    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = 1 << 20, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ``ids`` on request).

    A NULL or empty text is the end id alone.  Rows that repeat an id are documents of
    their own.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_cut(tokenizer_path, capacity, end_id, batch_bytes, with_ids), PIECES + ", ids array<long>" * with_ids)


def _pack(capacity: int, open_bins: int):
    def run(batches):
        from pyspark import TaskContext

        rows = pa.Table.from_batches(list(batches))
        if not rows.num_rows:
            return
        fit, base = BestFit(capacity, open_bins), TaskContext.get().partitionId() << 40
        placed = [fit.place(n) for n in rows.column("length").to_pylist()]
        rows = rows.append_column("sequence_id", pa.array([base + b for b, _ in placed], pa.int64()))
        yield from rows.append_column("offset", pa.array([o for _, o in placed], pa.int64())).to_batches()

    return run


def pack_best_fit(pieces: DataFrame, capacity: int = 2048, open_bins: int = 4096) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    The pieces are written once; their tokens fix the number of partitions, so that a
    partition fills about ``open_bins`` sequences and holds that many short rows, never
    tokens or text.  Order inside a partition is total up to equal rows, so a retry packs
    alike.
    """
    rows = written(pieces, "pieces")
    total = rows.agg(F.sum("length")).first()[0] or 0
    n = max(1, math.ceil(total / (capacity * open_bins)))
    dealt = rows.repartition(n).sortWithinPartitions(F.col("length").desc(), "doc_id", "piece", "start", "ids_crc32")
    return dealt.mapInArrow(_pack(capacity, open_bins), PIECES + ", sequence_id long, offset long")
