"""Collocations, harmonic packing and vector codes against plain Python, and their odd inputs."""
from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cargoline.llm import collocations, harmonic, vector_codes
from cargoline.llm.queries import QUERIES
from test_brute_force import SF_DIR

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- collocations -------------------------------------------------------------


def pieces_of(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
        words = re.findall(r"[^\x20\x09]+", piece)
        if words:
            yield words


def brute_counts(docs, most):
    f, before, after = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, text in docs:
        for words in pieces_of(text):
            for n in range(1, most + 1):
                for i in range(len(words) - n + 1):
                    key = tuple(words[i: i + n])
                    f[lang][key] += 1
                    before[lang][key] += i > 0
                    after[lang][key] += i + n < len(words)
    return f, before, after


def brute_collocations(docs, most=3, least=10, share=50, top=2000):
    counts, _, _ = brute_counts(docs, most)
    out = {}
    for lang, f in counts.items():
        n = sum(a for p, a in f.items() if len(p) == 1)
        rows, covered = [], set()
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((score, a, p, f[p[:k]], f[p[k:]]))
            for m in range(2, len(p)):
                covered |= {p[i: i + m] for i in range(len(p) - m + 1) if 100 * a >= share * f[p[i: i + m]]}
        rows = [r for r in rows if r[2] not in covered]
        rows.sort(key=lambda r: (-r[0], -r[1], " ".join(r[2]).encode()))
        for rank, (score, a, p, left, right) in enumerate(rows[:top], 1):
            out[lang, rank] = (" ".join(p), a, left, right, n, score)
    return out


def found(rows):
    return {(r["lang"], r["rank"]): (r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in rows}


def test_op11_matches_plain_counts(spark):
    docs = [(r["lang"] or "und", r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    rows = QUERIES["op11_collocations"](spark, SF_DIR)
    assert rows.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows = rows.collect()
    want = brute_collocations(docs)
    assert found(rows) == want and len(rows) == len(want) > 100


def words_like_zipf(rng, n):
    return rng.choices([f"w{i}" for i in range(40)], [1 / (i + 1) for i in range(40)], k=n)


@pytest.mark.parametrize("most", [1, 2, 4])
def test_phrases_of_any_depth_over_many_shards(spark, most):
    """Tiny shards, buckets and folds: sums, extensions and drops do not depend on how texts are dealt."""
    rng = random.Random(most)
    docs = [(rng.choice(["aa", "bb", "cc", None]), " ".join(w + rng.choice(["", "", "", ",", "\n", "\t", "!? "]) for w in words_like_zipf(rng, rng.randint(0, 60))))
            for _ in range(300)]
    docs += [("aa", "Same Words here again and again")] * 200 + [(None, None), ("dd", " ,. \t"), ("ee", "alone")]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(5)
    named = [(lang or "und", t) for lang, t in docs]
    f, before, after = brute_counts(named, most)
    options = dict(shard_bytes=2000, bucket_bytes=1500, hold_rows=50)
    rows = collocations.phrase_counts(df, most, 7, **options).collect()
    want = {(lang, " ".join(p)): (len(p), a, before[lang][p], after[lang][p]) for lang in f for p, a in f[lang].items() if a >= 7}
    assert {(r["lang"], r["phrase"]): (r["words"], r["f"], r["before"], r["after"]) for r in rows if r["phrase"] is not None} == want
    assert {r["lang"]: r["f"] for r in rows if r["phrase"] is None} == {lang: sum(a for p, a in c.items() if len(p) == 1) for lang, c in f.items()}
    for share, top in ((50, 30), (90, 5)):
        got = collocations.collocations(df, most, 7, share, top, **options).collect()
        assert found(got) == brute_collocations(named, most, 7, share, top)


def test_index_intervals_in_both_directions():
    """Every phrase's intervals count the same occurrences in the text and in its reverse."""
    rng = np.random.default_rng(5)
    text = np.append(rng.integers(0, 7, 500), 0)
    index = collocations.BidirectionalIndex(text, 6, 4)
    level = index.words()
    for n in range(1, 5):
        seen = Counter(tuple(text[i: i + n].tolist()) for i in range(len(text) - n + 1) if text[i: i + n].all())
        phrases, low, back, size = level
        assert dict(zip(map(tuple, phrases.tolist()), size.tolist())) == dict(seen)
        ahead = np.concatenate([text, np.zeros(4, int)])
        order = sorted(range(len(text)), key=lambda i: ahead[i: i + 4].tolist())
        turned = np.concatenate([text[::-1], np.zeros(4, int)])
        reverse = sorted(range(len(text)), key=lambda i: turned[i: i + 4].tolist())
        for p, a, b, k in zip(phrases.tolist(), low, back, size):
            assert {tuple(ahead[i: i + n].tolist()) for i in order[a: a + k]} == {tuple(p)}
            assert {tuple(turned[i: i + n].tolist()) for i in reverse[b: b + k]} == {tuple(p[::-1])}
        if n < 4:
            level = index.extend_left(level)


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 987_654_321_012_345, 999_999_999_999_937, 987_654_321_012_347
    counts = spark.createDataFrame([("x", "p q", 2, a), ("x", "p", 1, left), ("x", "q", 1, right)], "lang string, phrase string, words int, f long")
    row = collocations.score_cuts(counts).first()
    assert row["score"] == 1_000_000 * a * a // (left * right) and (row["l"], row["r"]) == (left, right)


def test_collocations_odd_inputs(spark):
    docs = spark.createDataFrame([("en", None, "x"), (None, "", "x"), ("en", "UPPER Upper uppeR ÄÖ äö", "x"), ("en", "no" * 100_000, "x"),
                                  ("en", "tick tock " * 20_000, "x")], "lang string, text string, phrase string")
    docs = docs.withColumns({c: F.lit("clash") for c in ("words", "f", "l", "r", "a", "n", "score", "rank", "bucket", "salt", "doc_id")})
    rows = collocations.collocations(docs).collect()
    assert found(rows) == brute_collocations([(r["lang"] or "und", r["text"]) for r in docs.collect()])
    assert collocations.collocations(docs.where("false")).collect() == []
    assert collocations.collocations(docs.where("text is null")).collect() == []


# --- harmonic packing ---------------------------------------------------------


def check_packing(rows, ids_of, capacity):
    """Every id once, bins gapless, no padding but at lengths that are no power of two (there are none)."""
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == set(ids_of)
    for d, ids in ids_of.items():
        at = 0
        for r in sorted(pieces[d], key=lambda r: r["start"]):
            part = np.array(ids[r["start"]: r["start"] + r["length"]], "<u4")
            assert r["start"] == at and r["length"] == len(part) > 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
            at += r["length"]
        assert at == len(ids)
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    sizes = []
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity and at & at - 1 == 0
        sizes.append(at)
    return sizes


def test_op12(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    rows = QUERIES["op12_harmonic_packing"](spark, SF_DIR)
    assert rows.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    rows = rows.collect()
    ids = {r["doc_id"]: tok.encode(r["text"] or "", add_special_tokens=False).ids + [2] for r in docs}
    sizes = check_packing(rows, ids, 4096)
    assert len(sizes) <= sum(map(len, ids.values())) // 4096 + 13 * 8  # tasks that read


def test_harmonic_bins_hold_a_fixed_number_of_documents():
    """A bin has k whole documents of class k and tokens of cut ones, and little space stays open."""
    rng = random.Random(3)
    lengths = [rng.choice([rng.randint(1, 40), rng.randint(1, 300), rng.randint(200, 256), rng.randint(1, 1000)]) for _ in range(5000)]
    bins = harmonic.Harmonic(256, 16)
    sequences, most = [], 0
    for d, n in enumerate(lengths):
        sequences += bins.add(d, n)
        most = max(most, bins.spare + sum(b - a for row in [*bins.open, bins.waiting or []] for _, a, b in row))
    assert most < 256 * (16 + 4)
    before = len(sequences)
    sequences += bins.finish()
    seen = defaultdict(list)
    for s in sequences:
        for d, a, b in s:
            seen[d].append((a, b))
    for d, n in enumerate(lengths):
        spans = sorted(seen[d])
        assert spans[0][0] == 0 and spans[-1][1] == n and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
    whole = Counter()
    for s in sequences[:before]:
        assert sum(b - a for _, a, b in s) == 256
        rest = [(d, lengths[d] % 256) for d, a, b in s if b == lengths[d] and a == lengths[d] - lengths[d] % 256 and 256 // (b - a) < 16]
        if rest and 256 // rest[0][1] == sum(256 // n == 256 // rest[0][1] for _, n in rest):
            whole[256 // rest[0][1]] += 1
    assert set(range(1, 6)) <= set(whole)
    assert all(n & n - 1 == 0 for n in (sum(b - a for _, a, b in s) for s in sequences))
    cuts = sum(len(v) - 1 for v in seen.values()) - sum(n // 256 - (n % 256 == 0) for n in lengths)
    assert cuts < 2 * len(sequences)


@pytest.mark.parametrize("lengths", [[256] * 50, [129] * 50, [1] * 1000, [255], [128] * 7, [17] * 99, [], [1], [300, 5, 600], [86] * 400])
def test_harmonic_ties(lengths):
    bins = harmonic.Harmonic(256, 16)
    sequences = [s for d, n in enumerate(lengths) for s in bins.add(d, n)] + list(bins.finish())
    assert sum(b - a for s in sequences for _, a, b in s) == sum(lengths)
    sizes = [sum(b - a for _, a, b in s) for s in sequences]
    assert all(n <= 256 and n & n - 1 == 0 for n in sizes) and len(sizes) <= sum(lengths) // 256 + 8


def test_harmonic_odd_inputs(spark):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [(None, None), (None, "a b"), (1, ""), (1, ""), (2, "日本語 😀"), (3, "word " * 30_000), (4, "x" * 150_000), (5, "\x00<|endoftext|>")]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumns(
        {c: F.lit("clash") for c in ("start", "length", "ids", "offset", "sequence_id", "ids_crc32", "doc_tokens", "piece")})
    pieces = harmonic.pack_harmonic(df, path, capacity=64, classes=8, with_ids=True)
    rows = pieces.collect()
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    want = Counter(t for d, text in texts for t in [(d, i) for i in tok.encode(text or "", add_special_tokens=False).ids + [2]])
    assert Counter((r["doc_id"], i) for r in rows for i in r["ids"]) == want
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    done = harmonic.sequences(pieces, 64).collect()
    assert sum(r["n_tokens"] for r in done) == sum(want.values()) and all(r["padding"] == 0 for r in done)
    assert harmonic.pack_harmonic(df.where("false"), path).collect() == []
    with pytest.raises(ValueError):
        harmonic.pack_harmonic(df, path, capacity=1000)


# --- vector codes -------------------------------------------------------------


def brute_codes(vectors, labels, parts, entries, rounds, scale=1024):
    """vectors: (id, list) in the order of the first codebook."""
    import math

    ints = [[math.floor(x * scale) for x in v] for _, v in vectors]
    width = len(ints[0]) // parts
    cut = [[v[p * width: (p + 1) * width] for p in range(parts)] for v in ints]
    books = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]

    def near(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for v in cut:
                members[near(v[p], books[p])[1]].append(v[p])
            for i, m in members.items():
                books[p][i] = [sum(c) // len(m) for c in zip(*m)]
    out, by_label = [], Counter()
    for (i, _), v, label in zip(vectors, cut, labels):
        best = [near(v[p], books[p]) for p in range(parts)]
        out.append((i, bytes(e for _, e in best).hex(), sum(d for d, _ in best), label))
        by_label[label] += out[-1][2]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, code, error, by_label[label]) for i, code, error, label in out), sha


def test_op13(spark):
    rows = QUERIES["op13_vector_codes"](spark, SF_DIR)
    assert sorted(rows.columns) == sorted(["vec_id", "code", "error", "label_error", "codebooks_sha256"])
    rows = rows.collect()
    import math

    got = [r for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
           if r["embedding"] is not None and all(x is not None and math.isfinite(x) for x in r["embedding"])]
    got.sort(key=lambda r: r["vec_id"])
    want, sha = brute_codes([(r["vec_id"], r["embedding"]) for r in got], [r["label"] for r in got], 4, 256, 4)
    assert Counter((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in rows) == want
    assert {r["codebooks_sha256"] for r in rows} == {sha}


@pytest.mark.parametrize("d, span", [(1, 3), (4, 5), (16, 200), (3, 100_000)])
def test_search_is_exact_with_ties(d, span):
    rng = np.random.default_rng(d)
    book, vectors = rng.integers(-span, span, (100, d)), rng.integers(-span, span, (9000, d))
    book[50:60] = book[:10]  # equal entries: the lower index wins
    vectors[:100] = book
    index, distance = vector_codes.nearest(vectors, book)
    for at in range(0, len(vectors), 1000):
        away = ((vectors[at: at + 1000, None] - book[None]) ** 2).sum(2)
        assert (index[at: at + 1000] == away.argmin(1)).all() and (distance[at: at + 1000] == away.min(1)).all()


def test_vector_codes_odd_inputs(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1.5, -0.25, 0.0, 0.5, rng.random()]) for _ in range(8)], rng.choice([None, 1, 2])) for i in range(60)]
    rows += [(None, [0.5] * 8, 1), (3, [0.25] * 8, None), (3, [0.25] * 8, None)]
    bad = [(100, None, 1), (101, [0.0] * 7 + [None], 1), (102, [0.0] * 7 + [float("nan")], 2), (103, [float("inf")] + [0.0] * 7, 2)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int").withColumns(
        {c: F.lit("clash") for c in ("v", "code", "error", "of", "salt", "grain", "part", "id", "n", "total", "fits", "label_error")})
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want, sha = brute_codes([r[:2] for r in order], [r[2] for r in order], 2, 16, 3)
    for bound in (vector_codes.BROADCAST_LABELS, 0):
        monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", bound)
        out, books = vector_codes.encode_vectors(df, parts=2, entries=16, rounds=3)
        assert Counter((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in out.collect()) == want
        assert vector_codes.codebooks_sha256(books) == sha
    empty, books = vector_codes.encode_vectors(df.where("false"))
    assert empty.collect() == [] and books.size == 0
    few, books = vector_codes.encode_vectors(df.where("vec_id < 3"))
    assert books.shape == (4, 3, 2) and {r["error"] for r in few.collect()} == {0}
    for wrong in ([0.5] * 7, [0.5] * 4, [1e300] * 8, [1e9] * 8):
        with pytest.raises(ValueError):
            vector_codes.encode_vectors(df.select("vec_id", "embedding", "label").union(spark.createDataFrame([(900, wrong, 1)], "vec_id long, embedding array<double>, label int")))


def test_shard_of_no_words():
    words, grams, counts = collocations.count_ngrams(pa.array([b"", b" .,"], pa.large_binary()), 3)
    assert len(words) == len(grams) == len(counts) == 0 and list(collocations._blobs("x", pa.array([b""], pa.large_binary()), 3, 4)) == []


def test_words_of_a_shard_in_parts():
    texts = pa.array([b"b a. c", b"", b"A b", b" . ", "\u00e9 zz, b".encode(), b"a"], pa.large_binary())
    ids, words = collocations._words(texts, 1)
    assert words.to_pylist() == sorted({b"a", b"b", b"c", b"zz", "\u00e9".encode()})
    assert ids.tolist() == [2, 1, 0, 3, 0, 1, 2, 0, 5, 4, 0, 2, 0, 1, 0]
    whole = collocations._words(texts)
    assert ids.tolist() == whole[0].tolist() and words.equals(whole[1])


def test_memory_of_a_shard():
    """The arrays that one shard needs at once stay below 12 times its text (14.7 before)."""
    import tracemalloc

    rng = np.random.default_rng(3)
    names = np.array([f"word{i:05d}" for i in range(20_000)])
    texts = pa.array([" ".join(names[(rng.pareto(1.0, 300) * 20).astype(int) % 20_000]).encode() for _ in range(700)], pa.large_binary())
    tracemalloc.start()
    try:
        for _ in collocations._blobs("x", texts, 3, 4):
            pass
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    size = sum(map(len, texts.to_pylist()))
    assert peak < 12 * size, peak / size
