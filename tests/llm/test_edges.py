"""NULLs, empty and very long texts, ties, repeated rows, empty tables and clashing extra columns."""
from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cargoline.llm import decontaminate, jaccard_join, language_id, line_dedup, packing, sharding, suffix_dedup, syncmers, token_counts, toxicity

EXTRA = ("shard slot rid row score margin rejected lang_pred n_lines n_dropped kept doc version keep w1 w2 id a b h1 h2 n label block sub places "
         "threshold toxic n_bytes n_tokens over_limit n_removed n_spans piece sequence_id offset all passage n_words items range tail key").split()
LINE = "This line is repeated in many of these documents, word for word."
TEXTS = [
    (None, None), (None, "A text without an id, " + LINE), (1, None), (2, ""), (2, ""), (3, " \n\t "), (4, "\x00\x01 control"),
    (5, "x" * 150_000), (6, "word " * 30_000), (7, LINE + "\nown line"), (7, LINE + "\nown line"), (8, LINE), (9, " " + LINE.upper() + "\t"),
    (10, LINE + "\n" + LINE), (11, "the other line\n" + LINE), (12, "12345 !!! 67"), (13, "日本語のテキスト 😀 ÄÖÜ é"), (14, "tie tie"), (15, "tie tie"),
]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame([(d, t, "en" if i % 2 else None, None, None) for i, (d, t) in enumerate(TEXTS)],
                               "doc_id long, text string, lang string, source string, n_chars int")
    return df.withColumns({c: F.lit("clash") for c in EXTRA}).cache()


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def ids(rows, column="doc_id"):
    return Counter(r[column] for r in rows)


ALL = Counter(d for d, _ in TEXTS)


def test_language_id(odd, none):
    model = language_id.train_language_model(odd)
    rows = language_id.identify_languages(odd, model).collect()
    assert ids(rows) == ALL
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
        assert r["rejected"] or letters
    assert language_id.identify_languages(none, model).collect() == []
    empty = language_id.train_language_model(none)
    assert {r["lang_pred"] for r in language_id.identify_languages(odd, empty).collect()} == {"und"}
    assert language_id.keep_identified(odd, empty).columns == odd.columns


def test_decontamination(spark, odd, none):
    items = spark.createDataFrame([(1, LINE, "c"), (1, LINE, "c"), (None, "own line", "c"), (3, None, "c"), (4, "", "c"), (5, "!!", "c")],
                                  "item_id long, text string, words string")
    rows = decontaminate.contamination(odd, items).collect()
    assert ids(rows) == ALL
    found = {(r["doc_id"], r["n_words"]): (r["n_hit"], r["items"]) for r in rows}
    assert found[8, 12] == (12, ["1"]) and found[9, 12] == (12, ["1"]) and found[7, 14] == (14, ["", "1"])
    assert found[10, 24] == (24, ["1"]) and found[2, 0] == (0, []) and found[1, 0] == (0, [])
    assert ids(decontaminate.drop_contaminated(odd, items).collect()) == ALL - Counter({None: 1, 7: 2, 8: 1, 9: 1, 10: 1, 11: 1})
    assert decontaminate.contamination(none, items).collect() == []
    assert not any(r["contaminated"] for r in decontaminate.contamination(odd, items.where("false")).collect())


def test_token_counts(odd, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = token_counts.count_tokens(odd, path).collect()
    assert ids(rows) == ALL
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    for r in rows:
        n = len(tok.encode(r["text"] or "", add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len((r["text"] or "").encode()), n > 1024)
    assert token_counts.count_tokens(none, path).collect() == []


def test_repeats(odd, none):
    rows = suffix_dedup.remove_repeats(odd, 400).collect()
    assert ids(rows) == ALL
    got = {r["doc_id"]: r for r in rows}
    # a run of one letter, or of one word, repeats itself throughout
    assert (got[5]["n_removed"], got[5]["n_spans"], bytes(got[5]["kept"])) == (150_000, 1, b"")
    assert (got[6]["n_removed"], got[6]["n_spans"]) == (150_000, 1)
    assert got[1]["n_bytes"] == 0 and got[8]["n_removed"] == 0
    assert suffix_dedup.remove_repeats(none, 400).collect() == []


def test_packing(odd, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.token_pieces(odd, path, with_ids=True).collect()
    assert ids(r for r in pieces if r["piece"] == 0) == ALL
    assert all(len(r["ids"]) == r["length"] <= 2048 for r in pieces)
    assert all(r["ids"] == [0] for r in pieces if r["doc_id"] in (1, 2, 3))
    for open_bins in (1, 2, 4096):
        rows = packing.pack_best_fit(packing.token_pieces(odd, path), open_bins=open_bins).collect()
        assert Counter((r["doc_id"], r["piece"]) for r in rows) == Counter((r["doc_id"], r["piece"]) for r in pieces)
        bins = defaultdict(list)
        for r in rows:
            bins[r["sequence_id"]].append((r["offset"], r["length"]))
        for spans in bins.values():
            assert [a for a, _ in sorted(spans)] == [sum(n for _, n in sorted(spans)[:i]) for i in range(len(spans))]
            assert sum(n for _, n in spans) <= 2048
    assert packing.pack_best_fit(packing.token_pieces(none, path)).collect() == []


def test_best_fit_bins():
    fit = packing.BestFit(10, 2)
    assert [fit.place(n) for n in (6, 7, 3, 4, 8, 9)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0), (3, 0)]
    # with both bins open and none that fits, the fullest (9) closes: 1 then goes to the other
    assert fit.place(5) == (4, 0) and fit.place(1) == (2, 8) and fit.n_open == 2


def test_sharding(odd, none):
    rows = sharding.shard_rows(odd, 4, rows_per_partition=3).collect()
    assert ids(rows) == ALL and {type(r["shard"]) for r in rows} == {int}
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert sorted(map(len, slots.values())) == [4, 5, 5, 5] and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sharding.shard_rows(none, 4).collect() == []
    assert {r["shard"] for r in sharding.shard_rows(odd.limit(2), 40).collect()} == {0, 1}


def test_communication_matrix_is_hypergeometric():
    counts = Counter(sharding.communication_matrix([3, 2], [2, 3], seed)[0][0] for seed in range(6000))
    # of 3 rows drawn out of 5 places, k fall on the 2 places of shard 0: 1/10, 6/10, 3/10
    assert [round(counts[k] / 6000, 1) for k in range(3)] == [0.1, 0.6, 0.3]
    m = sharding.communication_matrix([10**9, 3 * 10**9], [2 * 10**9, 2 * 10**9], 1)
    assert [sum(r) for r in m] == [10**9, 3 * 10**9] and [sum(c) for c in zip(*m)] == [2 * 10**9] * 2
    assert abs(m[0][0] - 5 * 10**8) < 10**6


def test_fingerprints(odd, none):
    rows = syncmers.fingerprint_edits(odd, rows_per_range=3).collect()
    assert ids(rows) == ALL
    got = {r["doc_id"]: r for r in rows}
    assert got[14]["fingerprint"] == got[15]["fingerprint"] and got[14]["near_next"] == 1.0
    assert got[1]["fingerprint"] == got[2]["fingerprint"] == "" and got[1]["near_next"] == 1.0
    assert len(got[6]["fingerprint"]) >= 8 and got[8]["n_chars"] == len(LINE)
    assert syncmers.fingerprint_edits(none).collect() == []
    one = syncmers.fingerprint_edits(odd.where("doc_id = 8")).collect()[0]
    assert one["near_next"] == 1.0  # the only document comes after itself


def test_line_dedup(odd, none):
    rows = line_dedup.dedup_lines(odd).collect()
    assert ids(rows) == ALL
    got = {(r["doc_id"], r["n_lines"]): (r["n_dropped"], r["text"]) for r in rows}
    # ids 7 (twice), 8, 9, 10, 11 hold the line: five documents, the last one keeps it
    assert got[11, 2] == (0, "the other line\n" + LINE) and got[10, 2] == (2, "") and got[7, 2] == (1, "own line") and got[9, 1] == (1, "")
    assert got[1, 1] == (0, "") and got[2, 1] == (0, "")
    assert line_dedup.line_keep_bitmaps(odd, min_docs=6).collect() == []
    assert line_dedup.dedup_lines(none).collect() == []


def test_line_groups_cut_by_partitions(spark):
    """A line in all documents spans many partitions; the result is that of one."""
    rows = [(d, "\n".join([f"{'common line ' * 5}"] * (d % 3 + 1) + [f"{'line of some ' * 4}{d % 50}", f"{'single ' * 9}{d}"])) for d in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        got = {r["doc_id"]: (r["n_dropped"], r["text"]) for r in line_dedup.dedup_lines(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    from test_brute_force import brute_lines

    assert got == {d: (k, t) for d, (_, k, t) in brute_lines(dict(rows)).items()}


def test_jaccard(odd, none):
    rows = jaccard_join.jaccard_components(odd, 3, 90, 100).collect()
    assert ids(rows) == ALL - Counter({None: 2})
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in rows}
    # 8 and 9 are equal but for case; a text of two words is one shingle; 10 has its line twice
    assert got[9, 10] == 8 and got[15, 1] == 14 and got[3, 0] == 3 and got[2, 0] == 2
    assert jaccard_join.jaccard_components(none).collect() == []
    kept = jaccard_join.drop_near_duplicates(odd, 3, 90, 100)
    assert kept.columns == odd.columns and ids(kept.collect()) == ALL - Counter({9: 1, 15: 1})


def test_toxicity(spark, odd, none):
    labels = spark.createDataFrame([(8, 1), (8, 0), (9, None), (None, 1), (14, 0), (15, 0), (5, 0), (6, 0)], "doc_id long, toxic int")
    model = toxicity.train_toxicity(odd, labels, lang_col="lang")
    rows = toxicity.score_toxicity(odd, model, lang_col="lang").collect()
    assert ids(rows) == ALL and all(0 <= r["score"] <= 1 for r in rows)
    scores = {(r["doc_id"], r["text"]): r["score"] for r in rows}
    assert scores[1, None] == scores[2, ""] and scores[14, "tie tie"] == scores[15, "tie tie"]
    assert toxicity.score_toxicity(none, model).collect() == []
    for few in (labels.where("false"), labels.where("toxic = 0")):
        flat = toxicity.score_toxicity(odd, toxicity.train_toxicity(odd, few)).collect()
        assert {round(r["score"], 9) for r in flat} == {0.0}


def test_toxicity_learns(spark):
    """Held-out accuracy on the driver's labels, per class."""
    from cargoline.llm.queries import op10_toxicity

    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = op10_toxicity(spark, "/root/testdata/sf0.01").join(labels.withColumnRenamed("toxic", "is_toxic"), "doc_id").where("held_out").collect()
    hit = [r["score"] for r in rows if r["is_toxic"] == 1]
    miss = [r["score"] for r in rows if r["is_toxic"] == 0]
    assert len(hit) > 5 and np.mean([a > b for a in hit for b in miss]) > 0.8


def test_toxicity_trains_on_all_labelled_texts(spark):
    """Beyond a shard's size nothing is left out: every text is counted and every rare toxic word learned."""
    words = [f"vile{chr(97 + i)}zz" for i in range(12)]
    docs = spark.createDataFrame([(i, f"common plain words go here {words[i // 4 % 12] if i % 4 == 0 else 'fine'}", "en") for i in range(960)], "doc_id long, text string, lang string")
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    rows = toxicity.labelled_words(docs.unionAll(docs), labels.unionAll(labels), 100, lang_col="lang")
    assert rows.count() == 960 and rows.select("shard").distinct().count() == 10
    seen = rows.mapInArrow(toxicity._seen, "row int, n long").groupBy("row").agg(F.sum("n").alias("n"))
    assert seen.agg(F.max("n")).first()[0] == 960
    model = toxicity.train_toxicity(docs, labels, 100, lang_col="lang")
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, model).collect()}
    assert all((score >= toxicity.OPERATING_POINT) == (i % 4 == 0) for i, score in scores.items())


def test_toxicity_moves_labelled_texts_only_and_once(spark, monkeypatch):
    """Unlabelled texts pass the filter by chance at most, and those that pass are dropped by their ids, also when all pass."""
    docs = spark.createDataFrame([(i % 900 if i % 900 else None, f"text {i} " + "a b c " * (i % 3), "en") for i in range(1800)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 1200, 5)] + [(5, 1), (None, 1), (7, None)], "doc_id int, toxic int")
    want = sorted((str(i), max(i % 2, i == 5)) for i in range(5, 900, 5))
    plans = []
    real = toxicity.written
    monkeypatch.setattr(toxicity, "written", lambda df, label, **o: (plans.append(df), real(df, label, **o))[1])
    for bits in (1 << 25, 64):
        monkeypatch.setattr(toxicity, "FILTER_BITS", bits)
        rows = toxicity.labelled_words(docs, labels, 50, lang_col="lang").collect()
        assert len(rows) == len(want) and sum(r["toxic"] for r in rows) == sum(t for _, t in want)
        assert {r["shard"] for r in rows} == set(range(5)) and {r["lang"] for r in rows} == {"en"}
    plan = plans[1]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
