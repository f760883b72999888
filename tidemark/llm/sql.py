"""DuckDB SQL for the corpus operators that SQL can express, from the definitions and not from our plans."""

from __future__ import annotations

from .rules import CONFIDENCE, CUTOFFS, RISK, WIDE_RISK

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Components of links (a, b), both ways: the smallest node that each reaches.
_REACH = "reach(a, b) AS (SELECT id, id FROM nodes UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)"

def rules_sql(risk: float, last: str) -> str:
    """Measures, labelled counts at each cutoff, exact binomial tests and chosen cutoffs (u); then last."""
    return f"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{_WORD}') AS words, [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '{_WORD}')] AS lines FROM d),
win AS (SELECT doc_id, p, words[p] || ' ' || words[p + 1] || ' ' || words[p + 2] AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS p FROM w) x),
rep AS (SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) x WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p + j) AS n FROM rep, (VALUES (0), (1), (2)) t(j) GROUP BY doc_id),
m AS (SELECT w.doc_id, stratum, len(words) AS n_words, coalesce(length(array_to_string(words, '')), 0) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words FROM w LEFT JOIN cov ON cov.doc_id = w.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
v AS ({' UNION ALL '.join(f"SELECT doc_id, stratum, '{r}' AS rule, {x} // greatest(n_words, 1) AS value FROM m" for r, x in (("symbols", "n_symbols * 100"), ("repeats", "n_repeat_words * 100"), ("dup_lines", "n_dup_lines * 1000"), ("long_words", "word_chars * 10")))}),
cuts AS ({' UNION ALL '.join(f"SELECT '{r}' AS rule, unnest([{', '.join(map(str, c))}]) AS cutoff" for r, c in CUTOFFS.items())}),
lab AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
c AS (SELECT stratum, rule, cutoff, count(*) FILTER (quality = 1) AS n, count(*) FILTER (quality = 1 AND value > cutoff) AS k, count(*) FILTER (quality <> 1) AS bad, count(*) FILTER (quality <> 1 AND value > cutoff) AS bad_k FROM v JOIN lab USING (doc_id) JOIN cuts USING (rule) GROUP BY stratum, rule, cutoff),
t AS (SELECT *, CASE WHEN k >= n THEN 1.0 ELSE list_sum([exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({risk / len(CUTOFFS)}) + (n - i) * ln({1 - risk / len(CUTOFFS)})) FOR i IN range(k + 1)]) END <= {1 - CONFIDENCE} / ((SELECT count(DISTINCT stratum) FROM c) * {len(CUTOFFS)}) AS safe FROM c),
s AS (SELECT stratum, rule, max(cutoff) FILTER (NOT safe) AS stop FROM t GROUP BY stratum, rule),
u AS (SELECT stratum, rule, min(cutoff) AS cutoff FROM t JOIN s USING (stratum, rule) WHERE bad_k * n > k * bad AND (stop IS NULL OR cutoff > stop) GROUP BY stratum, rule)
{last}"""


RULES = rules_sql(RISK, """SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND doc_id NOT IN (SELECT v.doc_id FROM v JOIN u USING (stratum, rule) WHERE v.value > u.cutoff) AS kept FROM b""")
RULE_CUTOFFS = rules_sql(WIDE_RISK, "SELECT stratum, rule, cutoff FROM u")

EMBEDDINGS = f"""WITH RECURSIVE nodes AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
ok AS (SELECT * FROM nodes WHERE label IS NOT NULL AND v IS NOT NULL AND list_dot_product(v, v) > 0 AND isfinite(list_dot_product(v, v))),
links AS (SELECT x.id AS a, y.id AS b FROM ok x JOIN ok y ON x.label = y.label AND x.id <> y.id AND len(x.v) = len(y.v) WHERE list_cosine_similarity(x.v, y.v) >= 0.93), {_REACH}
SELECT id AS vec_id, (SELECT count(*) FROM links WHERE links.a = nodes.id) AS n_links, c AS component_id, id = c AS kept FROM nodes JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = nodes.id"""

MINHASH = f"""WITH RECURSIVE w AS (SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS words FROM documents),
sh AS (SELECT DISTINCT id, array_to_string(words[p : p + 3], ' ') AS s FROM (SELECT id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS p FROM w WHERE len(words) > 0) x),
size AS (SELECT id, count(*) AS n FROM sh GROUP BY id), nodes AS (SELECT id FROM w),
links AS (SELECT a, b FROM (SELECT x.id AS a, y.id AS b, count(*) AS k FROM sh x JOIN sh y ON x.s = y.s AND x.id <> y.id GROUP BY ALL) p JOIN size m ON m.id = a JOIN size n ON n.id = b WHERE 100 * k >= 80 * (m.n + n.n - k)), {_REACH}
SELECT nodes.id AS doc_id, coalesce(size.n, 0) AS n_shingles, c AS component_id, nodes.id = c AS kept FROM nodes JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = nodes.id LEFT JOIN size ON size.id = nodes.id"""

SUFFIXES = """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS g FROM (SELECT doc_id, h, unnest(range(0, CAST(length(h) // 2 AS BIGINT) - 49)) AS i FROM d) x),
hit AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY g) AS least FROM p) x WHERE least < doc_id),
gap AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new FROM hit),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM gap) x GROUP BY doc_id, r),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS t FROM (SELECT d.doc_id, d.h, s.a, s.b FROM d JOIN (
  SELECT doc_id, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS a, a AS b FROM runs UNION ALL SELECT doc_id, max(b), NULL FROM runs GROUP BY doc_id) s ON s.doc_id = d.doc_id) x GROUP BY doc_id)
SELECT d.doc_id AS doc_id, length(d.h) // 2 AS n_bytes, coalesce(r.n, 0) AS n_removed, coalesce(r.k, 0) AS n_spans, sha256(unhex(coalesce(kept.t, CASE WHEN r.k IS NULL THEN d.h ELSE '' END))) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, sum(b - a) AS n, count(*) AS k FROM runs GROUP BY doc_id) r ON r.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id"""
SUFFIXES = SUFFIXES.replace("substr(h, 2 * a + 1, 2 * (b - a))", "substr(h, CAST(2 * a + 1 AS BIGINT), CAST(coalesce(2 * (b - a), length(h)) AS BIGINT))")

WARC = """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), m AS (SELECT h, min(page_id) AS least FROM p GROUP BY h),
b AS (SELECT page_id, h, least, CAST(CAST(unhex(sha1(h)) AS BIT) AS VARCHAR) AS bits FROM p JOIN m USING (h))
SELECT page_id, strlen(h) AS payload_bytes, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * CAST(bits[5 * i + 1] AS INT) + 8 * CAST(bits[5 * i + 2] AS INT) + 4 * CAST(bits[5 * i + 3] AS INT) + 2 * CAST(bits[5 * i + 4] AS INT) + CAST(bits[5 * i + 5] AS INT), 1) FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> least THEN least END AS refers_to FROM b"""

PHRASES = f"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM p),
g AS (SELECT lang, m, words[i : i + m - 1] AS phrase FROM (SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) t(m)) x),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL), n AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang), often AS (SELECT * FROM f WHERE f >= 30), c AS (SELECT * FROM often WHERE m > 1),
cut AS (SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, k, CAST(CAST(2000000 AS HUGEINT) * c.f // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score FROM c JOIN (VALUES (1), (2), (3)) t(k) ON k < c.m JOIN often x ON x.lang = c.lang AND x.phrase = c.phrase[1 : k] JOIN often y ON y.lang = c.lang AND y.phrase = c.phrase[k + 1 : c.m]),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (SELECT lang, phrase, max(f) AS f FROM (SELECT lang, f, phrase[i : i + j - 1] AS phrase FROM c JOIN (VALUES (2, 1), (2, 2), (2, 3), (3, 1), (3, 2)) t(j, i) ON j < m AND i + j - 1 <= m) x GROUP BY ALL),
kept AS (SELECT b.lang, array_to_string(b.phrase, ' ') AS phrase, a, l, r, score FROM best b LEFT JOIN inner_ i ON i.lang = b.lang AND i.phrase = b.phrase WHERE i.f IS NULL OR CAST(100 AS HUGEINT) * i.f < CAST(80 AS HUGEINT) * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""

#: CRC-32 of t.s as h: the register table by rule, then a byte of all texts a step.
_CRC = """tab AS (SELECT list(v ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM (SELECT unnest(range(256)) AS i) x) y),
bytes AS (SELECT s, hex(encode(s)) AS hx FROM (SELECT DISTINCT s FROM t) x),
steps(s, hx, j, r) AS (SELECT s, hx, 0, CAST(4294967295 AS BIGINT) FROM bytes UNION ALL
  SELECT s, hx, j + 1, xor(r >> 8, tab[(xor(r, (strpos('0123456789ABCDEF', hx[2 * j + 1]) - 1) * 16 + strpos('0123456789ABCDEF', hx[2 * j + 2]) - 1) & 255) + 1]) FROM steps, tab WHERE 2 * j < length(hx)),
crc AS (SELECT s, xor(r, 4294967295) AS h FROM steps WHERE 2 * j = length(hx))"""

SPELLING = f"""WITH RECURSIVE runs AS (SELECT doc_id, run, count(*) AS c FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents) x GROUP BY ALL HAVING length(run) >= 5),
t AS (SELECT doc_id || ':' || run AS s, run, c FROM runs), {_CRC},
w AS MATERIALIZED (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 97 = 0 THEN run[: h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, c FROM t JOIN crc USING (s)) x WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
v AS MATERIALIZED (SELECT word, n, i, word[: i - 1] AS a, word[i + 1 :] AS b FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM w) x),
pairs AS (SELECT x.word AS p, y.word AS q FROM v x JOIN v y ON x.a = y.a AND x.b = y.b AND x.word < y.word UNION SELECT v.word, w.word FROM v JOIN w ON w.word = v.a || v.b),
near AS (SELECT p.a AS word, p.b AS other, w.n AS other_n FROM (SELECT p AS a, q AS b FROM pairs UNION SELECT q, p FROM pairs) p JOIN w ON w.word = p.b),
best AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS k, count(*) OVER (PARTITION BY word) AS n_near FROM near),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * w.n THEN other END AS form, CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n FROM w LEFT JOIN (SELECT * FROM best WHERE k = 1) b ON b.word = w.word),
up(word, top) AS (SELECT word, word FROM f UNION ALL SELECT up.word, f.form FROM up JOIN f ON f.word = up.top WHERE f.form IS NOT NULL)
SELECT f.word AS word, form, r.root AS root, n, n_near, form_n FROM f JOIN (SELECT up.word, up.top AS root FROM up JOIN f ON f.word = up.top WHERE f.form IS NULL) r ON r.word = f.word"""

ORACLE_SQL = {"op2_quality_rules": RULES, "rule_cutoffs": RULE_CUTOFFS, "op3_embedding_near_dedup": EMBEDDINGS, "op5_suffix_dedup": SUFFIXES, "op6_minhash": MINHASH, "op8_warc": WARC, "op11_phrases": PHRASES, "op12_spelling_variants": SPELLING}
