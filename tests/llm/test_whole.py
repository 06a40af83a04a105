"""Inputs on which an operator did less than its whole job."""
from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from test_brute_force import brute_components


def test_second_round_tasks_are_bounded(spark, monkeypatch):
    """Strangers with a common passage form one block: no cell of the second round holds it."""
    from cargoline.llm import jaccard_join

    budget, seen, solve = 3000, [], jaccard_join._solve

    numbers = {}

    def spied(held, places, *rest):
        seen.append([tuple(r) for r in places.select("block", "sub", "node", "minor").collect()])
        numbers.update({r["node"]: len(r["shingles"]) // 8 for r in held.collect()})
        return solve(held, places, *rest)

    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", budget)
    monkeypatch.setattr(jaccard_join, "_solve", spied)
    passage = " ".join(f"p{i}" for i in range(54))
    texts = {d: passage + " " + " ".join(f"d{d}x{i}" for i in range(60)) for d in range(300)}
    texts |= {1000 + d: texts[d].replace(f"d{d}x30", "edited") for d in range(0, 300, 10)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = brute_components(texts, 5, 80, 100)
    rows = jaccard_join.jaccard_components(df, 5, 80, 100).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == want
    assert len(seen) == 2 and sum(d != c for d, (_, c) in want.items()) == 30
    cells = {}
    for block, sub, node, _ in seen[1]:
        cells.setdefault((block, sub), []).append(numbers[node])
    assert max(map(sum, cells.values())) < 2 * 1.5 * budget < sum(n for n, _ in want.values())


def test_members_of_a_frequent_weak_key_are_dealt(spark, monkeypatch):
    """Short strangers that share a passage: two of a batch go to the key's task, no pair is lost."""
    import random

    import numpy as np
    import pyarrow as pa

    from cargoline.llm import jaccard_join

    draw = random.Random(7)
    word = lambda: "".join(draw.choices("abcdefghij", k=6))
    shared = [word() for _ in range(40)]
    texts = {}
    for i in range(0, 600, 2):
        own = [word() for _ in range(12)]
        texts[i] = " ".join(shared + own)
        texts[i + 1] = " ".join(shared + own + [word() for _ in range(1 if i % 3 else 20)])
    batches = [pa.RecordBatch.from_pydict({"doc_id": list(texts)[i::5], "text": list(texts.values())[i::5]}) for i in range(5)]
    home, dealt, whole = [], [], set()
    for batch in batches:
        routing = jaccard_join.Routing(80, 100)
        for s in jaccard_join._sets(batch, 3):
            whole |= {(int(x), jaccard_join._set_hash(s)[0]) for x in routing.keys(s) if int(x) & 1}
        for out in jaccard_join._route(3, 80, 100, 4)(iter([batch])):
            entries = [jaccard_join._unsqueeze(e) for e in out.column("entries").to_pylist() if e is not None]
            home.append([(int(x), int(m)) for keys, members in entries for x, m in zip(keys, members) if int(x) & 1])
            dealt += [(int(np.int64(x).view(np.uint64)), int(m)) for e in out.column("others").to_pylist() if e for x, m in np.frombuffer(e, np.int64).reshape(-1, 2)]
    assert max(max(Counter(x for x, _ in own).values()) for own in home) == 2
    assert max(Counter(x for x, _ in dealt).values()) > 100
    assert set(dealt).union(*home) == whole
    monkeypatch.setattr(jaccard_join, "WEAK_MEMBERS", 64)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)
    rows = jaccard_join.jaccard_components(docs, 3, 80, 100).collect()
    want = brute_components(texts, 3, 80, 100)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == want
    assert 50 < sum(d != c for d, (_, c) in want.items()) < 300


def test_language_sample_counts_texts_not_rows(spark):
    """Copies of a text leave the other texts of the language their places in the sample."""
    from cargoline.llm.language_id import train_language_model

    text = lambda lang, i: F.concat(F.lit(f"{lang} "), F.translate(i.cast("string"), "0123456789", "abcdefghij"), F.lit(" ."))
    i = F.col("id")
    rows = spark.range(100_000).select(text("hot", F.when(i < 3000, i).otherwise(F.lit(99_999))).alias("text"), F.lit("aa").alias("lang"))
    rows = rows.union(spark.range(100_000).select(text("few", i % 20).alias("text"), F.lit("bb").alias("lang")))
    found = train_language_model(rows).dictionaries
    assert len(set(found["aa"].split(b"hot ")) - {b""}) == 200
    assert len(set(x.strip() for x in found["bb"].split(b"few ")) - {b""}) == 20


def test_language_sample_widens(spark, monkeypatch):
    """An estimate that is far too large costs another scan, not texts."""
    from cargoline.llm import language_id

    monkeypatch.setattr(language_id.F, "approx_count_distinct", lambda c: F.count(F.lit(1)) * 1000)
    rows = spark.range(500).select(F.concat(F.lit("w "), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("text"), F.lit("aa").alias("lang"))
    assert len(language_id.train_language_model(rows).dictionaries["aa"].split(b"w ")) == 201


def test_language_margin_rejects_what_was_not_learned(spark):
    """Unlearned languages, letters at random and program text go; held-out clean texts stay."""
    import random

    from cargoline.llm.language_id import train_language_model

    draw = random.Random(5)
    syllables = {"aa": "ka mi ro te su na", "bb": "blon grif dest wurm schal kein", "cc": "ção lhe nho vei mui tar"}

    def text(lang, words):
        return " ".join("".join(draw.choices(syllables[lang].split(), k=draw.randint(1, 3))) for _ in range(words))

    clean = [(text(lang, draw.randint(15, 120)), lang) for lang in syllables for _ in range(150)]
    model = train_language_model(spark.createDataFrame(clean, "text string, lang string"))
    assert 0 < model.min_margin < 1
    held = [(text(lang, draw.randint(15, 120)), lang) for lang in syllables for _ in range(100)]
    assert all(model.predict(t)[0] == lang for t, lang in held)
    assert sum(model.predict(t)[3] for t, _ in held) <= 6
    junk = [" ".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(2, 9))) for _ in range(60)) for _ in range(50)]
    other = ["Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
             "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem.",
             "for (int i = 0; i < n; i++) { total += values[i] * weights[i]; if (total > limit) return -1; }"]
    assert sum(model.predict(t)[3] for t in junk + other) >= 50
    assert all(model.predict(t)[3] for t in other)


def test_language_margin_of_few_texts(spark):
    """One language has no runner-up, and few texts a language reject ties only."""
    from cargoline.llm.language_id import train_language_model

    one = train_language_model(spark.createDataFrame([("only one tongue here", "aa")] * 9, "text string, lang string"))
    assert one.min_margin == 0.0 and not one.predict("only one tongue")[3]
    two = train_language_model(spark.createDataFrame([("only one tongue here", "aa"), ("sola lingua", "bb")], "text string, lang string"))
    assert two.min_margin == 0.0


def test_fingerprints_of_short_and_blankless_texts(spark):
    """Half a text that is kept, and an edit of one character, leave anchors in common."""
    import random

    from cargoline.llm import syncmers

    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 8)))
    make = {
        "chinese": lambda: "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(300)),
        "chinese lines": lambda: "\n".join("".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(12)) for _ in range(20)),
        "one token": lambda: "".join(rng.choices("0123456789abcdef", k=600)),
        "lines": lambda: "\n".join(word() for _ in range(150)),
        "tabs": lambda: "\t".join(word() for _ in range(150)),
        **{f"{n} words": (lambda n=n: " ".join(word() for _ in range(n))) for n in (4, 5, 8, 11, 16, 30, 63, 64, 90)},
    }
    kinds = [kind for kind in make for _ in range(5)]
    texts = [make[kind]() for kind in kinds]
    rows = syncmers.fingerprint_edits(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in rows:
        if r["doc_id"] % 5 < 4:  # the next one is of the same kind
            assert r["near_edited"] > 0.1 and r["near_edited"] > r["near_next"], kinds[r["doc_id"]]
    pairs = [(kind, t, t[: len(t) // 3] + "#" + t[len(t) // 3 + 1:]) for kind, t in zip(kinds, texts)]
    pairs += [(kind + ", two more", t, t + " two more") for kind, t in zip(kinds, texts) if "63" in kind or "64" in kind]
    df = spark.createDataFrame(pairs, "kind string, a string, b string")
    df = syncmers.with_anchors(syncmers.with_anchors(df, "a", "x"), "b", "y")
    for r in df.select("kind", syncmers.likeness(F.col("x"), F.col("y")).alias("like")).collect():
        assert r["like"] > 0.4, r


def test_language_excerpts_are_not_all_from_the_start(spark):
    """A banner that opens every text of a language does not fill its dictionary."""
    from cargoline.llm.language_id import train_language_model

    letters = str.maketrans("0123456789", "abcdefghij")
    texts = ["banner words " * 50 + " ".join(f"q{i * 1000 + j}".translate(letters) for j in range(200)) for i in range(1, 301)]
    found = train_language_model(spark.createDataFrame([(t, "aa") for t in texts], "text string, lang string")).dictionaries["aa"].split()
    assert len({w for w in found if w.startswith(b"q")}) > len(found) / 4


def test_rows_that_repeat_an_id_keep_their_own_links(spark):
    """One id on two texts: each text's links count, and the component has them all."""
    from cargoline.llm import jaccard_join

    a, b = (" ".join(f"{w}{i}" for i in range(60)) for w in "ab")
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (3, b + " more"), (4, "something else entirely here and there"), (4, a)]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80, 100).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(1, 1), (1, 1), (2, 1), (3, 1), (3, 1), (4, 1), (4, 4)]


def test_filter_lets_all_wanted_ids_pass(spark, monkeypatch):
    """Whatever its size, the filter of ids loses no member of a block."""
    from cargoline.llm import jaccard_join

    texts = {d: " ".join(f"t{d // 2}x{i}" for i in range(40)) + " end" * (d % 2) for d in range(-200, 200)}
    want = brute_components(texts, 5, 80, 100)
    assert len({c for _, c in want.values()}) == 200
    for bits in (64, 1 << 26):
        monkeypatch.setattr(jaccard_join, "FILTER_BITS", bits)
        df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
        rows = jaccard_join.jaccard_components(df, 5, 80, 100).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == want


def test_task_code_loads_where_the_package_is_not_installed(tmp_path):
    """Every task function, as Spark ships it, in a process without this repository."""
    import subprocess
    import sys

    import numpy as np
    import pyarrow as pa
    from pyspark import cloudpickle

    from cargoline.llm import collocations, harmonic, jaccard_join, packing, vector_codes

    books = np.zeros((2, 4, 2), np.int64)
    tasks = [jaccard_join._describe(5), jaccard_join._route(5, 80, 100, 4), jaccard_join._candidates, jaccard_join._allowed(80, 100),
             jaccard_join._join(80, 100), jaccard_join._filter_words, jaccard_join._hold(5, None), packing._cut("x", 8, 0, 1, False), packing._pack(8, 2),
             harmonic._pack("x", 8, 2, 4, 1, False), vector_codes._tally(books), vector_codes._code(books, pa.schema([("id", pa.int64())])),
             collocations._shards(3, 4, 1000), collocations._merged(10, 1000)]
    (tmp_path / "tasks").write_bytes(cloudpickle.dumps(tasks))
    code = f"""
import pickle, pyarrow as pa
tasks = pickle.load(open({str(tmp_path / 'tasks')!r}, 'rb'))
docs = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(['a b c d e f g', 'a b c d e f g h'])], names=['doc_id', 'text'])
out = list(tasks[1](iter([docs])))
assert out[0].num_rows and sum(b.num_rows for b in tasks[2](iter(out)))
"""
    env = {"PATH": "/usr/bin:/bin", "PYTHONPATH": ""}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_language_words_come_from_all_texts(spark):
    """Words of every whole text count for a dictionary, wherever they stand."""
    from cargoline.llm.language_id import train_language_model

    letters = str.maketrans("0123456789", "abcdefghij")
    filler = lambda i: " ".join(f"q{i * 1000 + j}".translate(letters) for j in range(150))
    # each of the 80 words ends 20 texts of 1,600; texts end beyond any excerpt's or sample's reach of most of them
    texts = [f"{filler(i)} {filler(i + 5000)} zz{100 + i % 80}".translate(letters) for i in range(1600)]
    model = train_language_model(spark.createDataFrame([(t, "aa") for t in texts], "text string, lang string"))
    assert {f"zz{100 + i}".translate(letters) for i in range(80)} <= set(model.dictionaries["aa"].decode().split())


def test_language_words_are_counted_whole(spark, monkeypatch):
    """Counts do not depend on how texts are cut or passed on; without blanks, pairs of code points are counted."""
    from collections import Counter

    from cargoline.llm import language_id

    texts = ["ab cd, AB\n" * 150_000, "x" * 40, "ab 日本語 12", "日本"]
    rows = spark.createDataFrame([(t, "aa") for t in texts], "text string, lang string").withColumn("place", F.xxhash64("text"))
    want = Counter({"ab": 300_001, "cd": 150_000, "xx": 39, "日本": 2, "本語": 1})
    got = language_id.frequent_words(rows, 100)
    assert got["aa", -1] == " ".join(sorted(want, key=lambda w: (want[w], [-ord(c) for c in w])))
    assert language_id.frequent_words(rows, 2, by_fold=False) == {("aa", -1): "cd ab"}
    places = {r["text"]: r["place"] % language_id.FOLDS for r in rows.collect()}
    for fold in range(language_id.FOLDS):
        there = {w.decode() for t in texts if places[t] != fold for w in language_id._units(Counter(language_id.words_of(t)))[0]}
        assert set(got.get(("aa", fold), "").split()) == there


def test_language_margin_counts_all_texts(spark):
    """The limit comes from every labelled text: of 3,000 with more or less noise, some 0.5 % fall below it."""
    import random

    from cargoline.llm.language_id import train_language_model

    draw = random.Random(9)
    word = lambda: "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=5))
    words = {lang: [word() for _ in range(300)] for lang in ("aa", "bb")}

    def text(lang, share):
        return " ".join(word() if draw.random() < share else draw.choice(words[lang]) for _ in range(60))

    rows = [(text(lang, draw.choice([0.0, 0.3, 0.5, 0.7, 0.8])), lang) for lang in words for _ in range(1500)]
    model = train_language_model(spark.createDataFrame(rows, "text string, lang string"))
    told = {lang: [p for t, x in rows if x == lang and (p := model.predict(t))[0] == lang] for lang in words}
    assert model.min_margin > 0 and all(len(p) > 1400 for p in told.values())
    assert all(sum(x[3] for x in p) <= 0.01 * len(p) for p in told.values())


def test_language_plain_text_keeps_letters_only(spark):
    """Every character alone between letters, and many odd ones together, as the expression says."""
    import re

    from cargoline.llm.language_id import plain

    slow = lambda t: re.sub(r"[\W\d_]+", " ", t.lower()).strip().encode("utf-8", "replace")
    texts = [f"A{chr(i)}b" for i in range(0x3000)] + ["".join(chr(i) for i in range(a, a + 300)) for a in range(0, 0x11000, 300)] + ["", " ", "\ud800x"]
    assert [plain(t) for t in texts] == [slow(t) for t in texts]


def test_language_predictions_do_not_depend_on_the_batch(spark):
    from cargoline.llm.language_id import LanguageModel

    model = LanguageModel({"aa": b"one two three " * 20, "bb": b"uno dos tres " * 20}, min_margin=0.01)
    texts = ["one two", None, "", "uno " * 600_000, "12 .", "dos tres one " * 3000, "x", "tres"] * 3
    assert model.predict_all(texts) == [model.predict(t) for t in texts] and model.predict_all([]) == []
