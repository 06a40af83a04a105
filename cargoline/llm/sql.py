"""DuckDB SQL of the training-data queries that SQL can express on whole tables.

The others are held against brute-force versions in the tests: compression, tokenizers,
packing, hashes of Spark and trained models have no SQL form, and 400-byte windows of all
texts are too many for one.
"""
from __future__ import annotations

import string

_FOLD = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def _words(table: str, key: str, parting: str) -> str:
    return f"SELECT {key}, list_filter(string_split_regex({_FOLD}, '{parting}'), lambda x: x <> '') AS w FROM {table}"


_ITEM_PARTING = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP2 = f"""
WITH d AS ({_words('documents', 'doc_id', _ITEM_PARTING)}),
i AS ({_words('benchmark', 'item_id', _ITEM_PARTING)}),
iw AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS passage
       FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS passage
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hits AS (SELECT dw.doc_id, dw.s, dw.n, iw.item_id FROM dw JOIN iw ON iw.n = dw.n AND iw.passage = dw.passage),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(f.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(f.items, '')) AS items_sha256,
       c.n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN found f ON f.doc_id = d.doc_id"""

OP8 = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM l),
h AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.doc_id, k.i, k.line, h.keeper IS NOT NULL AND h.keeper <> k.doc_id AS gone FROM k LEFT JOIN h ON h.key = k.key)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""

OP9 = f"""
WITH RECURSIVE d AS ({_words('documents', 'doc_id', r'[\x20\x09-\x0D]+')}),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(list_slice(w, i, i + 2), ' ') END AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * c >= 90 * (x.n + y.n - c)),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, CAST(least(d.doc_id, coalesce(m.low, d.doc_id)) AS BIGINT) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT a, min(b) AS low FROM r GROUP BY a) m ON m.a = d.doc_id"""

def _part(begin: str, n: str) -> str:
    return f"array_to_string(list_slice(string_split(c.phrase, ' '), {begin}, {begin} + {n} - 1), ' ')"


OP11 = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_FOLD}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT id, lang, unnest(words) AS w0, unnest(range(len(words))) AS i
      FROM (SELECT row_number() OVER () AS id, lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS words FROM p)),
t AS (SELECT lang, w0, lead(w0) OVER o AS w1, lead(w0, 2) OVER o AS w2 FROM w WINDOW o AS (PARTITION BY id ORDER BY i)),
f AS MATERIALIZED (
      SELECT lang, words, phrase, count(*) AS f
      FROM (SELECT lang, 1 AS words, w0 AS phrase FROM t UNION ALL SELECT lang, 2, w0 || ' ' || w1 FROM t WHERE w1 IS NOT NULL
            UNION ALL SELECT lang, 3, w0 || ' ' || w1 || ' ' || w2 FROM t WHERE w2 IS NOT NULL)
      GROUP BY lang, words, phrase),
n AS (SELECT lang, sum(f) AS n FROM f WHERE words = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT c.*, {_part('1', 'k')} AS first, {_part('(k + 1)', '(words - k)')} AS rest
                   FROM (SELECT *, unnest(range(1, words)) AS k FROM f WHERE words > 1 AND f >= 10) c),
x AS MATERIALIZED (SELECT c.*, f.f AS l FROM c JOIN f ON f.lang = c.lang AND f.phrase = c.first),
cuts AS MATERIALIZED (SELECT x.*, f.f AS r, CAST(1000000 AS HUGEINT) * x.f * x.f // (CAST(l AS HUGEINT) * f.f) AS score
                      FROM x JOIN f ON f.lang = x.lang AND f.phrase = x.rest),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, part, max(f) AS longer
           FROM (SELECT lang, f, unnest([{_part('1', '2')}, {_part('2', '2')}]) AS part FROM best c WHERE words = 3) GROUP BY lang, part),
kept AS (SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.part = b.phrase WHERE i.longer IS NULL OR 100 * i.longer < 50 * b.f),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, phrase) AS rank FROM kept)
SELECT ranked.lang, CAST(rank AS BIGINT) AS rank, phrase, f AS a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000"""


def _op13(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """One pair of tables a round: nearest entries, and the codebook of their floored means."""
    dot = lambda a, b: f"list_inner_product({a}, {b})"  # noqa: E731  -- whole numbers under 2^53 in doubles
    near = lambda r: f"""near{r} AS MATERIALIZED (
SELECT vec_id, label, p, x, arg_min(e, (d, e)) AS e, min(d) AS d
FROM (SELECT o.*, b.e, CAST({dot('o.x', 'o.x')} - 2 * {dot('o.x', 'b.c')} + {dot('b.c', 'b.c')} AS BIGINT) AS d FROM own o JOIN book{r} b ON b.p = o.p)
GROUP BY vec_id, label, p, x)"""  # noqa: E731
    book = lambda r: f"""book{r} AS MATERIALIZED (
SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{r - 1} b LEFT JOIN (
  SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY i) AS c
  FROM (SELECT p, e, i, sum(CAST(x AS BIGINT)) AS s, count(*) AS n
        FROM (SELECT p, e, unnest(x) AS x, unnest(range(1, len(x) + 1)) AS i FROM near{r - 1}) GROUP BY p, e, i)
  GROUP BY p, e) m ON m.p = b.p AND m.e = b.e)"""  # noqa: E731
    steps = [near(0)] + [step(r) for r in range(1, rounds + 1) for step in (book, near)]
    return f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
              WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
own AS MATERIALIZED (SELECT vec_id, label, p, list_slice(v, p * len(v) // {parts} + 1, (p + 1) * len(v) // {parts}) AS x FROM kept, range({parts}) t(p)),
book0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM own QUALIFY e < {entries}),
{(", " + chr(10)).join(steps)},
sha AS (SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS sha
        FROM (SELECT p, e, unnest(c) AS x, unnest(range(1, len(c) + 1)) AS i FROM book{rounds})),
rows AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT sha FROM sha) AS codebooks_sha256 FROM rows"""


OP13 = _op13()

ORACLE_SQL = {"op2_decontamination": OP2, "op8_line_dedup": OP8, "op9_jaccard_join": OP9, "op11_collocations": OP11, "op13_vector_codes": OP13}
