"""The training-data operators against plain Python over the smallest driver tables."""
from __future__ import annotations

import hashlib
import os
import zlib
from collections import Counter, defaultdict

import pytest

from cargoline.llm.queries import QUERIES

SF_DIR = os.environ.get("CARGOLINE_LLM_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def result(spark):
    def get(name):
        rows = QUERIES[name](spark, SF_DIR).collect()
        return rows

    return get


def test_op1(docs, result):
    rows = result("op1_language_id")
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in docs[r["doc_id"]]["text"] or ""))
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held) / len(held) > 0.9
    assert sum(r["rejected"] for r in rows if r["lang_pred"] != "und") / len(rows) <= 0.02


def test_op1_sizes(spark, docs, result):
    """Prediction, margin and score from plain sums of compressed sizes."""
    import math

    import zstandard

    from cargoline.llm.common import remainder
    from cargoline.llm.language_id import plain, train_language_model

    model = train_language_model(spark.read.parquet(f"{SF_DIR}/documents.parquet").where(remainder("doc_id", 3) != 1))
    parameters = zstandard.ZstdCompressionParameters.from_level(9, min_match=3, write_content_size=False, write_checksum=False, write_dict_id=False)

    def size(lang, block):
        content = zstandard.ZstdCompressionDict(model.dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(compression_params=parameters)
        return len(zstandard.ZstdCompressor(dict_data=content, compression_params=parameters).compress(block))

    checked = 0
    for r in result("op1_language_id"):
        raw = plain(docs[r["doc_id"]]["text"] or "")
        if not raw or len(raw) > 4000:
            continue
        blocks = [raw[i: i + 2048] for i in range(0, len(raw), 2048)]
        if len(blocks[-1]) < 256:
            blocks[-1] += bytes(64)
        total = {lang: sum(size(lang, b) for b in blocks) for lang in model.dictionaries}
        first, second = sorted(total.values())[:2]
        assert total[r["lang_pred"]] == first
        assert r["margin"] == (second - first) / first
        assert r["rejected"] == (first == second or r["margin"] < model.min_margin)
        assert r["score"] == pytest.approx(1 / sum(math.exp((first - t) * 0.4) for t in total.values()))
        checked += 1
    assert checked > 50


def test_op5(docs, result):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for d, r in docs.items():
        ids = tok.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        for i, s in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[s: s + 2048], "<u4")
            want[d, i] = (s, len(part), zlib.crc32(part.tobytes()))
    rows = result("op5_best_fit_packing")
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want and len(rows) == len(want)
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(n for _, n, _ in want.values()) // 2048)
    assert len(bins) <= least * 1.05 + 2


def test_op6(docs, result):
    rows = result("op6_sharding")
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        raw = (docs[r["doc_id"]]["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(40))
    counts = [len(slots.get(s, [])) for s in range(40)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def brute_lines(docs, min_chars=40, min_docs=5):
    space = " \t\n\x0b\x0c\r"
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    holders = defaultdict(set)
    for d, text in docs.items():
        for line in (text or "").split("\n"):
            key = line.strip(space).translate(fold)
            if len(key) >= min_chars:
                holders[key].add(d)
    out = {}
    for d, text in docs.items():
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(k := x.strip(space).translate(fold)) >= min_chars and len(holders[k]) >= min_docs and max(holders[k]) != d)]
        out[d] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def test_op8(docs, result):
    want = {d: (n, k, hashlib.sha256(t.encode()).hexdigest()) for d, (n, k, t) in brute_lines({d: r["text"] for d, r in docs.items()}).items()}
    rows = result("op8_line_dedup")
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in rows} == want and len(rows) == len(want)
    assert sum(k for _, k, _ in want.values()) > 0


def ascii_words(text):
    import re

    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(fold))


def brute_contamination(docs, items):
    windows = defaultdict(set)
    for item, text in items.items():
        w = ascii_words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i: i + n])].add(str(item))
    sizes = sorted({len(w) for w in windows})
    out = {}
    for d, text in docs.items():
        w, hit, found = ascii_words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i: i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[k]
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def test_op2(spark, docs, result):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    want = brute_contamination({d: r["text"] for d, r in docs.items()}, items)
    rows = result("op2_decontamination")
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == want and len(rows) == len(want)
    assert sum(x[-1] for x in want.values()) > 0


def test_op3(docs, result):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = result("op3_token_counts")
    assert len(rows) == len(docs)
    for r in rows:
        text = docs[r["doc_id"]]["text"] or ""
        n = len(tok.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 1024)


def test_op7(docs, result):
    order = sorted(docs)
    texts = {d: r["text"] or "" for d, r in docs.items()}
    rows = {r["doc_id"]: r for r in result("op7_fingerprints")}
    assert sorted(rows) == order
    by_text = defaultdict(set)
    for d, after in zip(order, order[1:] + order[:1]):
        t = texts[d]
        half = len(t) // 2
        edited = t[: len(t) - half] + texts[after][:half]
        r = rows[d]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        by_text[t].add(r["fingerprint"])
        by_text[edited].add(r["edited_fingerprint"])
        sets = [set(f[i: i + 8] for i in range(0, len(f), 8)) for f in (r["fingerprint"], r["edited_fingerprint"], rows[after]["fingerprint"])]
        assert r["near_edited"] == pytest.approx(len(sets[0] & sets[1]) / len(sets[0] | sets[1]) if sets[0] | sets[1] else 1.0)
        assert r["near_next"] == pytest.approx(len(sets[0] & sets[2]) / len(sets[0] | sets[2]) if sets[0] | sets[2] else 1.0)
    assert all(len(v) == 1 for v in by_text.values())
    long = [r for d, r in rows.items() if len(texts[d].split()) > 100]
    assert sum(r["near_edited"] > r["near_next"] for r in long) / len(long) > 0.9


def test_op10(spark, docs, result):
    rows = {r["doc_id"]: r for r in result("op10_toxicity")}
    assert sorted(rows) == sorted(docs)
    for d, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_tokenizers_on_awkward_texts():
    """Both token paths give the library's result on quotes, blanks, specials and odd code points."""
    import random

    import numpy as np
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    from cargoline.llm.common import slices, text_bytes
    from cargoline.llm.packing import WordIds
    from cargoline.llm.token_counts import TokenCounter

    rng = random.Random(3)
    plain, odd = "''  \n\t strvelmdSTRVELMDabcÉé1²!?_-ſª\x1c\x85\xa0", "İ日本　😀́"
    texts = ["", "a", "'re", "'r", "WE'RE'V", "x 'll  '", "  \n", "a'", "''s'", "don't", "a<|endoftext|>b <|endoftext|>", "x" * 3000, " " * 700]
    texts += ["".join(rng.choice(plain + odd * (i % 2)) for _ in range(rng.randint(0, 200))) for i in range(1500)]
    texts += ["".join(rng.choice(["<|endoftext|>", "'ll", "'RE", "'", "  ", " ", "\n", "word", "12"]) for _ in range(30)) for _ in range(200)]
    buf, offsets = text_bytes(pa.array(texts))
    counter, words = (cls(public_tokenizers.path(f)) for cls, f in ((TokenCounter, "byte_bpe_50k.json"), (WordIds, "word_bpe_49k.json")))
    counts, ids = [], []
    for a, b in slices(offsets, 5000):
        part = buf[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]
        counts += counter.counts(*part).tolist()
        found, n = words(*part)
        ids += [x.tolist() for x in np.split(found, np.cumsum(n)[:-1])]
    library = [Tokenizer.from_file(public_tokenizers.path(f)) for f in ("byte_bpe_50k.json", "word_bpe_49k.json")]
    assert counts == [len(library[0].encode(t, add_special_tokens=False).ids) for t in texts]
    assert ids == [library[1].encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("clash,remember", [(False, 400_000), (False, 20), (True, 400_000)])
def test_word_ids_ask_the_library_once_a_word(monkeypatch, clash, remember):
    """Words seen before cost no call, also beside odd texts, and equal hashes of other words are told apart."""
    import numpy as np
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    from cargoline.llm import common, packing

    if clash:
        mix = common.mix64
        for module in (common, packing):
            monkeypatch.setattr(module, "mix64", lambda x: mix(x) % np.uint64(7))
    path = public_tokenizers.path("word_bpe_49k.json")
    words, library = packing.WordIds(path, remember), Tokenizer.from_file(path)
    learnt, learn = [], words._learn
    monkeypatch.setattr(words, "_learn", lambda pieces, *keys: learnt.extend(pieces) or learn(pieces, *keys))
    base = [f"word{chr(97 + i)} Ünïque{chr(98 + i % 20)}, averyveryverylongword{chr(97 + i % 5)} it's 4{i} <|endof" for i in range(20)]
    base[7] += "text|>"
    for texts in (base, base[::-1], ["text|>", *base, "", "\u4e2d \u2019s wordb", "x" * 20], ["\u4e2d"]):
        buf, offsets = common.text_bytes(pa.array(texts))
        ids, n = words(buf, offsets)
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    if not clash and remember > 1000:
        assert len(learnt) == len(set(learnt))


def test_word_ids_cost_of_what_is_remembered():
    """A call's time follows its texts, not the words remembered; an odd text leaves the others to the fast way."""
    import time

    import public_tokenizers
    import pyarrow as pa

    from cargoline.llm.common import text_bytes
    from cargoline.llm.packing import WordIds

    letters = "abcdefghijklmnopqrst"
    words = WordIds(public_tokenizers.path("word_bpe_49k.json"))
    words(*text_bytes(pa.array([" ".join(a + b + c + d for a in letters for b in letters for c in letters for d in letters)])))
    odd = text_bytes(pa.array(["\u4e2d", *["abcd bcde cdef"] * 1000]))
    began = time.process_time()
    ids, n = words(*odd)
    took = time.process_time() - began
    assert ids.tolist() == [*words(*text_bytes(pa.array(["\u4e2d"])))[0].tolist(), *words(*text_bytes(pa.array(["abcd bcde cdef"])))[0].tolist() * 1000]
    assert took < 2  # 10 s and more where each text converted the whole memory


def brute_components(docs, k=3, num=90, den=100):
    import re

    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for d, text in docs.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(fold))
        sets[d] = {tuple(w[i: i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {d: d for d in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    shared = Counter((a, b) for v in holders.values() for i, a in enumerate(v) for b in v[i + 1:])
    for (a, b), n in shared.items():
        if den * n >= num * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (len(sets[d]), find(d)) for d in docs}


def test_op9(docs, result):
    want = brute_components({d: r["text"] for d, r in docs.items()})
    rows = result("op9_jaccard_join")
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == want and len(rows) == len(want)
    assert any(c != d for d, (_, c) in want.items())


@pytest.mark.parametrize("k,num,den", [(5, 80, 100), (2, 60, 100)])
def test_jaccard_small_blocks(spark, docs, monkeypatch, k, num, den):
    """Other thresholds, and blocks cut into many sub-blocks."""
    import random

    from cargoline.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 300)
    rng = random.Random(k)
    base = [f"w{i}" for i in range(40)]
    texts = {d: r["text"] for d, r in list(docs.items())[:80]}
    for i in range(120):  # a chain of copies with more and more changes, and short ones
        words = base.copy()
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(40)] = f"x{rng.randrange(6)}"
        texts[1000 + i] = " ".join(words[: rng.choice([3, 8, 40, 40, 40])])
    texts |= {2000: None, 2001: "", 2002: " \n ", 2003: "one", 2004: "ONE", 2005: "one two"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = brute_components(texts, k, num, den)
    rows = jaccard_join.jaccard_components(df, k, num, den).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == want
    kept = {r["doc_id"] for r in jaccard_join.drop_near_duplicates(df, k, num, den).collect()}
    assert kept == {c for _, c in want.values()}


def brute_repeats(texts, length=400):
    """{id: (n_bytes, n_removed, n_spans, kept)} of byte strings by id."""
    seen = Counter()
    for raw in texts.values():
        for i in range(len(raw) - length + 1):
            seen[hash(raw[i: i + length])] += 1
    out = {}
    for d, raw in texts.items():
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen[hash(raw[i: i + length])] > 1:
                gone[i: i + length] = b"\1" * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone) if not g))
    return out


def test_op4(docs, result):
    want = {d: (n, k, s, hashlib.sha256(raw).hexdigest()) for d, (n, k, s, raw) in
            brute_repeats({d: (r["text"] or "").encode() for d, r in docs.items()}).items()}
    rows = result("op4_suffix_dedup")
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == want and len(rows) == len(want)
    assert sum(k for _, k, _, _ in want.values()) > 0


@pytest.mark.parametrize("hot_rows", [20_000, 3])
def test_repeats_of_periodic_and_shared_texts(spark, monkeypatch, hot_rows):
    """Runs of one word, passages that many texts share, copies, and anchors dealt to several tasks."""
    import random

    from cargoline.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "HOT_ROWS", hot_rows)
    rng = random.Random(hot_rows)
    word = lambda n: "".join(rng.choice("abé") for _ in range(n))
    passages = [word(n) for n in (99, 100, 101, 150, 300)]
    texts = {0: None, 1: "", 2: "a" * 99, 3: "a" * 100, 4: "a" * 101, 5: "ab " * 200, 6: "x" + "ab " * 80, 7: word(500), 8: word(120)}
    texts |= {9: texts[7], 10: texts[8], 11: texts[7][50:200], 12: word(99), 13: passages[0] * 2}
    for i in range(14, 60):
        texts[i] = word(rng.randint(0, 200)) + rng.choice(passages) + word(rng.randint(0, 200)) + rng.choice(passages + [""]) + word(rng.randint(0, 40))
    df = spark.createDataFrame([(d, t, 7) for d, t in texts.items()], "doc_id long, text string, kept int").repartition(5)
    rows = suffix_dedup.remove_repeats(df, 100).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in rows}
    assert got == brute_repeats({d: (t or "").encode() for d, t in texts.items()}, 100)
