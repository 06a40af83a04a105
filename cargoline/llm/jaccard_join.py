"""Exact n-gram Jaccard self-join by signature trees.

Documents are sets of hashed word shingles; equal sets count as one.  The join runs in
three steps:

1. *Routing.*  Two sets within the threshold differ in at most d shingles.  Shingles are
   dealt by hash to so many parts (a number fixed by the size class) that at least one
   part with content is equal in both sets, so documents with an equal part are
   candidates, and no link is lost.  Keys of parts travel as packed, sorted blocks.
   A part of fewer than three shingles says little (a common passage would make
   candidates of strangers): among its documents, those stay candidates whose bitmaps
   allow the threshold, found by the trees of step 3.
2. *Blocks.*  Connected candidates form a block; a large block is cut into sub-blocks.
3. *Trees.*  Each sub-block builds a tree whose nodes hold the OR of their documents'
   token bitmaps and the range of their sizes.  A dual traversal drops a pair of nodes
   where even the largest possible overlap is too small or where all are linked already;
   document pairs that are left are verified on the shingles themselves.

Only links that join components are kept, so a group of n copies yields n - 1 rows.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoline.llm.common import WordHasher, ascii_fold, mix64, slices, text_bytes, written
from cargoline.llm.components import connected_components

#: bits of a bitmap: a power of two, twice the set's size between these bounds
LEAST_BITS, MOST_BITS = 1024, 65536
FANOUT = 8
#: documents of a weak key that one task compares by bitmap
WEAK_MEMBERS = 4096
#: shingles in a sub-block, and shingles of the corpus for each bucket of keys
BLOCK_SHINGLES, BUCKET_SHINGLES = 1 << 19, 1 << 23
#: bits of the filter that thins the texts to members of blocks (8 MB, whatever the input)
FILTER_BITS = 1 << 26
_WEAK = np.uint64(1)


class Shingles:
    """Sorted distinct shingle hashes of texts."""

    def __init__(self, k: int):
        self.k = k
        inside = np.ones(256, bool)
        inside[[0x20, *range(0x09, 0x0E)]] = False
        self.hasher = WordHasher(inside, ascii_fold())

    def __call__(self, buf: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        n, k = len(offsets) - 1, self.k
        padded = np.full(len(buf) + n, 32, np.uint8)
        padded[np.arange(len(buf)) + np.repeat(np.arange(n), np.diff(offsets))] = buf
        starts, _, words = self.hasher(padded)
        at = np.searchsorted(starts, offsets + np.arange(n + 1))
        salts = mix64(np.arange(1, k + 1, dtype=np.uint64))
        out = []
        with np.errstate(over="ignore"):
            rolled = np.zeros(max(0, len(words) - k + 1), np.uint64)
            for j in range(k if len(rolled) else 0):
                rolled += mix64(words[j: j + len(rolled)] + salts[j])* (np.uint64(2 * j + 3))
            rolled = mix64(rolled)
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                if b - a >= k:
                    out.append(np.unique(rolled[a: b - k + 1]))
                elif b > a:  # fewer words than a shingle: the whole sequence
                    own = mix64(words[a:b] + salts[: b - a]) * (2 * np.arange(b - a, dtype=np.uint64) + np.uint64(3))
                    out.append(mix64(np.array([own.sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64)))
                else:
                    out.append(np.empty(0, np.uint64))
        return out


class Routing:
    """Size classes and their numbers of parts for a Jaccard threshold of num / den."""

    RATIO = 1.5

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.low = [1]
        self.made: dict[int, tuple[int, int, int]] = {}

    def parts(self, c: int) -> tuple[int, int, int]:
        """(largest size that takes part, parts, differences at most) of class ``c``."""
        if c not in self.made:
            self.made[c] = self._make(c)
        return self.made[c]

    def _make(self, c: int) -> tuple[int, int, int]:
        self._extend(c + 1)
        high = self.low[c + 1] - 1
        top = high * self.den // self.num
        d = (self.den - self.num) * (high + top) // (self.den + self.num)
        parts = d + 1
        for _ in range(8):  # room for parts without content
            empty = parts * math.exp(-self.low[c] / parts)
            parts = min(d + 1 + math.ceil(empty + math.sqrt(empty)), (3 * (d + 1) + 1) // 2) if d else 1
        return top, parts, d

    def _extend(self, c: int) -> None:
        while len(self.low) <= c:
            self.low.append(max(self.low[-1] + 1, math.ceil(self.low[-1] * self.RATIO)))

    def classes(self, n: int) -> list[int]:
        """The classes a set of ``n`` takes part in: its own, and those of smaller partners."""
        while self.low[-1] <= n:
            self._extend(len(self.low))
        c = int(np.searchsorted(self.low, n, "right")) - 1
        out = [c]
        while c and self.parts(c - 1)[0] >= n:
            c -= 1
            out.append(c)
        return out

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        """Keys of the parts of a set; the lowest bit marks parts of fewer than three shingles.

        A part without content is left out where enough parts with content remain.
        """
        n, found = len(shingles), []
        spread, value = mix64(shingles ^ np.uint64(0x5851F42D4C957F2D)), mix64(shingles + np.uint64(0x14057B7EF767814F))
        for c in self.classes(n):
            _, parts, d = self.parts(c)
            part = (spread % np.uint64(parts)).astype(np.int64)
            total, size = np.zeros(parts, np.uint64), np.bincount(part, minlength=parts)
            with np.errstate(over="ignore"):
                np.add.at(total, part, value)
                key = mix64(total + mix64(np.arange(parts, dtype=np.uint64) + np.uint64(c << 32)))
            key = np.where((size < 3) & (parts > 1), key | _WEAK, key & ~_WEAK)
            filled = size > 0
            found.append(key[filled] if filled.sum() > d else key)
        return np.concatenate(found)


def _sets(batch, k: int, budget: int = 1 << 20):
    make = Shingles(k)
    buf, offsets = text_bytes(batch.column("text"))
    for a, b in slices(offsets, budget):
        yield from make(buf[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])


def _set_hash(s: np.ndarray) -> tuple[int, int]:
    import xxhash

    digest = xxhash.xxh3_128_intdigest(s.tobytes())
    return (digest >> 64) - (1 << 63), (digest & 0xFFFFFFFFFFFFFFFF) - (1 << 63)


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """The token bitmap of a set, as 64-bit words."""
    width = min(MOST_BITS, max(LEAST_BITS, 1 << (2 * len(shingles) - 1).bit_length()))
    bits = np.zeros(width, np.uint8)
    bits[(shingles & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.uint64)


def _folded(bitmaps: list[np.ndarray]) -> np.ndarray:
    """Bitmaps of one width: wider ones are folded, as a place is a hash modulo the width."""
    width = min(len(b) for b in bitmaps)
    return np.stack([np.bitwise_or.reduce(b.reshape(-1, width), 0) for b in bitmaps])


def _describe(k: int):
    def run(batches):
        for batch in batches:
            sets = list(_sets(batch, k))
            hashes = [_set_hash(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), *(pa.array([h[i] for h in hashes], pa.int64()) for i in (0, 1)),
                 pa.array([bitmap(s).tobytes() for s in sets], pa.binary())], names=["doc_id", "n_shingles", "h1", "h2", "bits"])

    return run


def _squeeze(keys: np.ndarray, members: np.ndarray) -> bytes:
    """Sorted keys and the members that hold them, packed: differences of keys by byte plane."""
    import zstandard as zstd

    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    who, place = np.unique(members, return_inverse=True)
    raw = np.array([len(keys), len(who)], "<i8").tobytes() + steps.view(np.uint8).reshape(-1, 8).T.tobytes() + who.astype("<i8").tobytes() + place.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstd.ZstdCompressor(level=1).compress(raw)


def _unsqueeze(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard as zstd

    raw = np.frombuffer(zstd.ZstdDecompressor().decompress(blob), np.uint8)
    n, m = raw[:16].view("<i8").tolist()
    steps = np.ascontiguousarray(raw[16: 16 + 8 * n].reshape(8, n).T).view("<u8").ravel()
    who = raw[16 + 8 * n: 16 + 8 * (n + m)].copy().view("<i8")
    place = np.ascontiguousarray(raw[16 + 8 * (n + m):].reshape(4, n).T).view("<u4").ravel()
    with np.errstate(over="ignore"):
        return np.cumsum(steps, dtype=np.uint64), who[place]


def _stars(keys: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For entries sorted by key: (center's place of each entry, whether the key has several
    members, whether it is the first entry of its key)."""
    first = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, bool)
    begin = np.flatnonzero(first)
    size = np.diff(begin, append=len(keys))
    return np.repeat(begin, size), np.repeat(size > 1, size), first


def _route(k: int, num: int, den: int, buckets: int):
    """Texts -> packed blocks of (key, member) by bucket, and links from a batch's other
    members of a strong key to its center.

    A bucket gets one member of a strong and two of a weak key from a batch: with two there,
    the key is known to be shared.  The others of a weak key go to any task, so none holds all members
    of a frequent one.
    """

    def run(batches):
        routing = Routing(num, den)
        for batch in batches:
            keys, members, seen = [], [], set()
            for s in _sets(batch, k):
                if len(s) and (h := _set_hash(s)[0]) not in seen:
                    seen.add(h)
                    keys.append(routing.keys(s))
                    members.append(np.full(len(keys[-1]), h))
            if not keys:
                continue
            keys, members = np.concatenate(keys), np.concatenate(members)
            order = np.lexsort((members, keys))
            keys, members = keys[order], members[order]
            once = np.concatenate([[True], (keys[1:] != keys[:-1]) | (members[1:] != members[:-1])])
            keys, members = keys[once], members[once]
            center, several, first = _stars(keys, members)
            strong = (keys & _WEAK) == 0
            link = strong & ~first
            links = np.unique(np.stack([members[center[link]], members[link]], 1), axis=0)
            dealt = ~strong & (np.arange(len(keys)) >= center + 2)
            stay = ~link & ~dealt
            bucket = (mix64(keys[stay]) % np.uint64(buckets)).astype(np.int64)
            out_keys, out_members = keys[stay], members[stay]
            rows = [(int(links[i, 0]) % buckets, None, links[i: i + 100_000].tobytes(), None) for i in range(0, len(links), 100_000)]
            others = np.stack([keys[dealt].view(np.int64), members[dealt]], 1)
            for some in np.split(others, range(100_000, len(others), 100_000)) if len(others) else ():
                # all members have a say in the bucket, as batches may share their first ones
                rows.append((int(np.bitwise_xor.reduce(some.ravel())) % buckets, None, None, some.tobytes()))
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in range(buckets):
                own = order[cuts[b]: cuts[b + 1]]
                if len(own):
                    rows.append((b, _squeeze(out_keys[own], out_members[own]), None, None))
            types = pa.int32(), pa.binary(), pa.binary(), pa.binary()
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=["bucket", "entries", "links", "others"])

    return run


def _candidates(batches):
    """One task's buckets -> links (block NULL: a, b) and members of weak blocks (block, a),
    some of them several times."""
    keys, members, links = [], [], []
    for batch in batches:
        for entries, packed, others in zip(*(batch.column(c).to_pylist() for c in ("entries", "links", "others"))):
            if entries is not None:
                k, m = _unsqueeze(entries)
                keys.append(k)
                members.append(m)
            elif packed is not None:
                links.append(np.frombuffer(packed, np.int64).reshape(-1, 2))
            else:
                block, a = np.frombuffer(others, np.int64).reshape(-1, 2).T.copy()
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(a), pa.nulls(len(a), pa.int64())], names=["block", "a", "b"])
    if keys:
        keys, members = np.concatenate(keys), np.concatenate(members)
        order = np.lexsort((members, keys))
        keys, members = keys[order], members[order]
        once = np.concatenate([[True], (keys[1:] != keys[:-1]) | (members[1:] != members[:-1])])
        keys, members = keys[once], members[once]
        center, several, first = _stars(keys, members)
        strong = (keys & _WEAK) == 0
        link = strong & ~first
        links.append(np.stack([members[center[link]], members[link]], 1))
        weak = ~strong & several
        yield pa.RecordBatch.from_arrays([pa.array(keys[weak].view(np.int64)), pa.array(members[weak]), pa.nulls(int(weak.sum()), pa.int64())], names=["block", "a", "b"])
    if links:
        all_links = np.unique(np.concatenate(links), axis=0)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(all_links), pa.int64()), pa.array(all_links[:, 0].copy()), pa.array(all_links[:, 1].copy())], names=["block", "a", "b"])


class SignatureTree:
    """A tree over sets sorted by size: each node has the OR of bitmaps, the size range, and
    the most shingles that any set below has beyond its bits."""

    def __init__(self, bitmaps: list[np.ndarray], sizes: list[int]):
        bits = _folded(bitmaps)
        self.order = np.lexsort((bits[:, 0], sizes))
        bits, size = bits[self.order], np.asarray(sizes, np.int64)[self.order]
        slack = size - np.bitwise_count(bits).sum(1)
        self.levels = [(bits, size, size, slack)]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, more = self.levels[-1]
            cuts = np.arange(0, len(bits), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(bits, cuts), np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts), np.maximum.reduceat(more, cuts)))


def dual_traversal(tree: SignatureTree, num: int, den: int, linked, check) -> None:
    """Visit the pairs of documents of a tree that may reach the threshold.

    ``linked(a0, a1, b0, b1)`` says whether nothing is to be found between two ranges, and
    ``check(i, j)`` takes a pair of documents (places in the tree's order).
    """
    stack = [(len(tree.levels) - 1, 0, 0)]
    while stack:
        level, a, b = stack.pop()
        width = FANOUT ** level
        if linked(a * width, (a + 1) * width, b * width, (b + 1) * width):
            continue
        if level == 0:
            check(a, b)
            continue
        bits, least, most, slack = tree.levels[level - 1]
        sa, sb = slice(a * FANOUT, (a + 1) * FANOUT), slice(b * FANOUT, (b + 1) * FANOUT)
        shared = np.bitwise_count(bits[sa, None] & bits[None, sb]).sum(2) + np.minimum(slack[sa, None], slack[None, sb])
        overlap = np.minimum(shared, np.minimum(most[sa, None], most[None, sb]))
        # |x & y| >= t |x | y| needs (1 + t) |x & y| >= t (|x| + |y|), and sizes within a factor t
        fits = (num + den) * overlap >= num * (least[sa, None] + least[None, sb])
        fits &= (den * most[sa, None] >= num * least[None, sb]) & (den * most[None, sb] >= num * least[sa, None])
        for i, j in np.argwhere(fits)[::-1].tolist():
            if a * FANOUT + i <= b * FANOUT + j:
                stack.append((level - 1, a * FANOUT + i, b * FANOUT + j))


def link_sets(bitmaps: list[np.ndarray], sizes: list[int], num: int, den: int, verify, labels: list | None = None,
              minor: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (pairs of places) that join components.  ``verify(i, j)`` decides a pair that the
    bitmaps allow.  ``labels`` are components known before; with ``minor``, only pairs with
    a minor set are looked at."""
    tree = SignatureTree(bitmaps, sizes)
    order = tree.order
    known = {}
    label = np.array([known.setdefault(labels[i] if labels else i, len(known)) for i in order])
    small = minor[order] if minor is not None else None
    found: list[tuple[int, int]] = []

    def linked(a0, a1, b0, b1):
        la, lb = label[a0:a1], label[b0:b1]
        return bool((la == la[0]).all() and (lb == la[0]).all()) or small is not None and not small[a0:a1].any() and not small[b0:b1].any()

    def check(i, j):
        if label[i] != label[j] and verify(order[i], order[j]):
            found.append((int(order[i]), int(order[j])))
            label[label == label[j]] = label[i]

    dual_traversal(tree, num, den, linked, check)
    return found


def _allowed(num: int, den: int):
    """Rows (block, cell, a, n, bits) sorted by block and cell -> links (a, b) that bitmaps allow."""

    def solve(rows):
        members, sizes, bits = zip(*rows)
        maps = [np.frombuffer(b, np.uint64) for b in bits]
        return [(members[i], members[j]) for i, j in link_sets(maps, list(sizes), num, den, lambda i, j: True)]

    return _grouped(2, solve)


def _grouped(n_keys: int, solve):
    """mapInArrow over rows sorted by their first ``n_keys`` columns: links of each group."""

    def run(batches):
        key, rows, out = None, [], []
        for batch in batches:
            for values in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                if values[:n_keys] != key:
                    if len(rows) > 1:
                        out += solve(rows)
                    key, rows = values[:n_keys], []
                rows.append(values[n_keys:])
            if len(out) > 10_000:
                yield _links(out)
                out = []
        if len(rows) > 1:
            out += solve(rows)
        yield _links(out)

    return run


def _links(pairs):
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])


_HELD = "doc long, h1 long, h2 long, shingles binary"


def _slots(docs: np.ndarray) -> np.ndarray:
    """Bits of the filter for ids: two of ``FILTER_BITS`` each."""
    first = mix64(docs.view(np.uint64))
    return np.stack([first, mix64(first)]) & np.uint64(FILTER_BITS - 1)


def _filter_words(batches):
    """Ids -> the words of a filter that holds them, one row for each word of a task that is not 0."""
    words = np.zeros(FILTER_BITS // 64, np.uint64)
    for batch in batches:
        slots = _slots(np.asarray(batch.column(0).cast(pa.int64())))
        np.bitwise_or.at(words, (slots >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slots & np.uint64(63)))
    at = np.flatnonzero(words)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(words[at].view(np.int64))], names=["word", "bits"])


def _filter(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of fixed size over the column ``doc``: where it is full it lets more pass, never fewer."""
    words = np.zeros(FILTER_BITS // 64, np.uint64)
    rows = ids.select("doc").mapInArrow(_filter_words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words[np.asarray(rows.column("word").combine_chunks())] = np.asarray(rows.column("bits").combine_chunks()).view(np.uint64)
    return words


def _hold(k: int, words):
    """Texts -> the sets of those whose id may be wanted; the others end here."""

    def run(batches):
        for batch in batches:
            slots = _slots(np.asarray(batch.column("doc_id").cast(pa.int64())))
            found = (words.value[(slots >> np.uint64(6)).astype(np.int64)] >> (slots & np.uint64(63))) & np.uint64(1)
            some = batch.filter(pa.array(found.all(0)))
            sets = list(_sets(some, k))
            hashes = [_set_hash(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [some.column("doc_id"), *(pa.array([h[i] for h in hashes], pa.int64()) for i in (0, 1)), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["doc", "h1", "h2", "shingles"])

    return run


def _join(num: int, den: int):
    """Rows (block, sub, node, label, minor, shingles) sorted by block and sub -> links (a, b)."""

    def solve(rows):
        sets, labels, minors = {}, [], []
        for node, label, minor, raw in rows:
            if node not in sets:
                sets[node] = np.frombuffer(raw, np.uint64)
                labels.append(label)
                minors.append(minor)
        who, values = list(sets), list(sets.values())

        def verify(i, j):
            x, y = values[i], values[j]
            both = len(np.intersect1d(x, y, assume_unique=True))
            return den * both >= num * (len(x) + len(y) - both)

        only = np.array(minors, bool) if minors[0] is not None else None
        links = link_sets([bitmap(x) for x in values], [len(x) for x in values], num, den, verify, labels, only)
        return [(who[i], who[j]) for i, j in links]

    return _grouped(2, solve)


def _solve(held: DataFrame, places: DataFrame, num: int, den: int) -> DataFrame:
    """Links found in the sub-blocks of ``places`` (node, block, sub, label, minor) by the sets of ``held`` (node, shingles)."""
    # no bound is known for either side: the same join at every size, never a broadcast
    own = places.groupBy("node").agg(F.collect_list(F.struct("block", "sub", "label", "minor")).alias("places"))
    placed = held.join(own.hint("merge"), "node").select("node", "shingles", F.explode("places").alias("p"))
    placed = placed.select("p.block", "p.sub", "node", "p.label", "p.minor", "shingles")
    return placed.repartition("block", "sub").sortWithinPartitions("block", "sub", "node").mapInArrow(_join(num, den), "a long, b long")


def _grid(large: DataFrame) -> DataFrame:
    """Places (node, block, sub, label, minor) at which every minor document of a block meets
    all the others.

    Minor and other documents are dealt to chunks of their own; a cell holds a minor chunk
    and one other chunk of either kind, so about two sub-blocks' shingles at most.  Cells
    are numbered within the block: pairs of minor chunks (i <= j) at i * minors + j, then
    (minor chunk, other chunk).
    """
    chunks = lambda own: F.ceil(F.coalesce(F.sum(F.when(own, F.col("n"))), F.lit(0)) / BLOCK_SHINGLES).cast("long")
    counted = large.groupBy("block").agg(chunks(F.col("minor")).alias("minors"), chunks(~F.col("minor")).alias("others"))
    minors, others, own = F.col("minors"), F.col("others"), F.col("chunk")
    rows = large.join(counted.where("minors > 0"), "block").withColumn("chunk", F.pmod(F.xxhash64("node"), F.when(F.col("minor"), minors).otherwise(others)))
    each = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    with_minors = F.transform(each(minors), lambda i: F.least(own, i) * minors + F.greatest(own, i))
    with_others = F.transform(each(others), lambda i: minors * minors + own * others + i)
    from_others = F.transform(each(minors), lambda i: minors * minors + i * others + own)
    cells = F.when(F.col("minor"), F.concat(with_minors, with_others)).otherwise(from_others)
    return rows.select("node", "block", F.explode(cells).alias("sub"), "label", "minor")


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row with an id.

    Words are runs without ASCII white space, A-Z in lower case.  A text of fewer than
    ``k`` words is one shingle; a NULL text or one without words has none and links with
    nothing.  Two documents link where ``den * |x & y| >= num * |x | y|``; a component is
    named by the smallest id in it.  Rows without an id have no component and are left
    out; rows that repeat an id are told apart by their texts.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where(F.col("doc_id").isNotNull())
    about = written(texts.mapInArrow(_describe(k), "doc_id long, n_shingles long, h1 long, h2 long, bits binary"), "sets")
    # equal sets are one member: a number of its own, and the smallest id that has it
    filled = about.where("n_shingles > 0")
    member = filled.groupBy("h1", "h2").agg(F.min("doc_id").alias("doc"), F.max("n_shingles").alias("n"))
    member = written(member.withColumn("node", F.monotonically_increasing_id()), "members")

    total = about.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / BUCKET_SHINGLES))
    routed = texts.mapInArrow(_route(k, num, den, buckets), "bucket int, entries binary, links binary, others binary")
    found = written(routed.repartitionById(buckets, "bucket").mapInArrow(_candidates, "block long, a long, b long"), "candidates")
    # documents of a weak key whose bitmaps allow the threshold; a large group in cells
    weak = found.where("block is not null").select("block", "a").distinct()
    sized = weak.groupBy("block").agg(F.ceil(F.count("*") / WEAK_MEMBERS).cast("int").alias("subs"))
    sub = F.pmod(F.xxhash64("a"), F.col("subs")).cast("int")
    cells = weak.join(sized, "block").withColumn("sub", sub).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)))
    cells = cells.select("block", (F.least("sub", "other") * F.col("subs") + F.greatest("sub", "other")).alias("cell"), "a")
    signed = about.join(member.select("h1", "h2", "doc"), (about["doc_id"] == F.col("doc")) & (about["h1"] == member["h1"]) & (about["h2"] == member["h2"]))
    signed = signed.select(about["h1"].alias("a"), F.col("n_shingles").alias("n"), "bits")
    allowed = cells.join(signed, "a").select("block", "cell", "a", "n", "bits").repartition("block", "cell").sortWithinPartitions("block", "cell", "a")
    allowed = allowed.mapInArrow(_allowed(num, den), "a long, b long")
    of = member.select(F.col("h1").alias("h"), "node")
    pairs = (
        found.where("block is null").select("a", "b").union(allowed).distinct()
        .join(of.withColumnsRenamed({"h": "a", "node": "x"}), "a").join(of.withColumnsRenamed({"h": "b", "node": "y"}), "b").select("x", "y")
    )
    routed = connected_components(pairs, "x", "y").select(F.col("component").alias("block"), "node")
    blocks = written(routed.join(member.select("node", "n", "doc", "h1", "h2"), "node"), "blocks")
    # the sets of all that are in a block, once: texts are read again but never moved
    words = spark.sparkContext.broadcast(_filter(blocks))
    held = texts.mapInArrow(_hold(k, words), _HELD).dropDuplicates(["doc", "h1", "h2"])
    held = written(held.join(blocks.select("node", "doc", "h1", "h2").hint("merge"), ["doc", "h1", "h2"]).select("node", "shingles"), "held")
    sized = blocks.groupBy("block").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("subs"), F.min("node").alias("leader"), F.count("*").alias("size")).where("size > 1")
    placed = blocks.join(sized, "block").withColumn("sub", F.pmod(F.xxhash64("node"), F.col("subs")).cast("int"))
    everywhere = F.sequence(F.lit(0), F.col("subs") - 1)
    nothing = [F.lit(None).cast("long").alias("label"), F.lit(None).cast("boolean").alias("minor")]
    first = placed.select("node", "block", F.explode(F.when(F.col("node") == F.col("leader"), everywhere).otherwise(F.array("sub"))).alias("sub"),
                          F.col("node").alias("label"), nothing[1])
    links = written(_solve(held, first, num, den), "links")

    # blocks of several sub-blocks: whoever is not in the block's largest component meets all
    large = placed.where("subs > 1")
    if not large.isEmpty():
        known = connected_components(links, "a", "b")
        large = written(large.join(known, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component"), "large")
        main = large.groupBy("block", "label").agg(F.count("*").alias("c")).groupBy("block").agg(F.max_by("label", F.struct("c", "label")).alias("main"))
        large = large.join(main, "block").withColumn("minor", F.col("label") != F.col("main"))
        links = links.union(written(_solve(held, _grid(large), num, den), "links"))
    # a component is named by the smallest id of its members
    whole = written(connected_components(links, "a", "b").join(member.select("node", "doc"), "node"), "whole")
    named = whole.join(whole.groupBy("component").agg(F.min("doc").alias("component_id")), "component").select("node", "component_id")
    member = member.join(named, "node", "left").select("h1", "h2", F.coalesce("component_id", "doc").alias("component_id"))
    rows = about.select("doc_id", "n_shingles", "h1", "h2").join(member, ["h1", "h2"], "left")
    return rows.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document, the smallest id, of every component."""
    extra = jaccard_components(docs, k, num, den, id_col, text_col).where("component_id <> doc_id").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(extra.hint("merge"), docs[id_col].cast("long") == extra["__id"], "left_anti")
