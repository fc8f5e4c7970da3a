"""DuckDB SQL for the registered queries that SQL can express.

Language, toxicity and packing are fitted or greedy, BPE needs the merges, and
the randomness battery of the secret scan would be a second copy of its formulas;
these are tested against brute-force versions instead.
"""

from __future__ import annotations

from duetto.llm.centroids import CLUSTERS, DIM, ROUNDS, SCALE
from duetto.llm.decontam import WINDOW
from duetto.llm.licenses import K, MAX_SHIFT, MIN_COVER, PHRASES, TEMPLATES
from duetto.llm.prefixtrie import GROUP, SHARED
from duetto.llm.quality import (MAX_DUP_LINE_SHARE, MAX_HOST_RATE, MAX_REPEAT_PERCENT,
                                MAX_SYMBOLS_PER_WORD, MEAN_WORD_CHARS, MIN_WORDS)
from duetto.llm.urls import RULES

_BLANK = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"


def _lower(x: str) -> str:
    """A-Z in lower case."""
    return f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


NEARDUP = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{_WORD}') AS ws FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                ELSE list_sort(list_distinct(list_transform(range(1, len(ws) - 3),
                       lambda i: array_to_string(ws[i:i + 4], ' ')))) END AS s FROM w),
classes AS (SELECT min(doc_id) AS rep, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
items AS (SELECT rep, n, unnest(s) AS x FROM classes),
pairs AS (SELECT a.rep AS u, b.rep AS v FROM items a JOIN items b ON a.x = b.x AND a.rep < b.rep
          GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
links AS (SELECT u, v FROM pairs UNION SELECT v, u FROM pairs),
reach(a, b) AS (SELECT u, v FROM links UNION SELECT r.a, l.v FROM reach r JOIN links l ON r.b = l.u),
comp AS (SELECT a AS rep, least(a, min(b)) AS component FROM reach GROUP BY a)
SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles,
       coalesce(p.component, c.rep, d.doc_id) AS component_id,
       d.doc_id = coalesce(p.component, c.rep, d.doc_id) AS kept
FROM sets d LEFT JOIN classes c ON c.s = d.s LEFT JOIN comp p ON p.rep = c.rep"""


def _rule(host: str, path: str, value: str) -> str:
    whens = " ".join(
        f"WHEN ({host} = '{r.host}' OR ends_with({host}, '.{r.host}')) AND starts_with({path}, '{r.path}') "
        f"THEN '{getattr(r, value)}'" for r in sorted(RULES, key=lambda r: -len(r.name)))
    return f"CASE {whens} END"


def _host(x: str) -> str:
    return _lower(f"regexp_extract(coalesce({x}, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1)")


def _path(x: str) -> str:
    return f"regexp_extract(coalesce({x}, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2)"


def _resource(x: str) -> str:
    bare = f"regexp_replace({x}, '(?s)#.*$', '')"
    head = f"regexp_extract({bare}, '(?s)^(.*?://[^/?]*)', 1)"
    return (f"CASE WHEN contains({x}, '://') THEN {_lower(head)} || "
            f"substr({bare}, length({head}) + 1) END")


URLS = f"""
WITH RECURSIVE tags AS (
  SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\\b[^>]*>')) AS tag FROM pages
  WHERE url IS NOT NULL AND html IS NOT NULL),
named AS (SELECT url, CASE
    WHEN regexp_matches(tag, '(?is)^<link\\b[^>]*\\brel\\s*=\\s*["'']?canonical\\b')
      THEN regexp_extract(tag, '(?is)\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1)
    WHEN regexp_matches(tag, '(?is)^<meta\\b[^>]*\\bhttp-equiv\\s*=\\s*["'']?refresh\\b')
      THEN regexp_extract(tag, '(?is)\\bcontent\\s*=\\s*["'']?[^"''>]*?\\burl\\s*=\\s*["'']?([^"''\\s>]+)', 1)
    END AS h FROM tags),
base AS (SELECT url, replace(h, '&amp;', '&') AS h, regexp_replace(url, '(?s)[?#].*$', '') AS bare,
                regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) AS root,
                regexp_extract(url, '(?s)^(.*?):', 1) AS scheme FROM named WHERE h <> ''),
fold AS (SELECT *, regexp_extract(bare, '(?s)^(.*?://[^/]*(?:/.*)?)/[^/]*$', 1) AS f FROM base),
target AS (SELECT url, CASE
    WHEN contains(h, '://') THEN h WHEN starts_with(h, '//') THEN scheme || ':' || h
    WHEN starts_with(h, '/') THEN root || h WHEN starts_with(h, '#') THEN url
    WHEN starts_with(h, '?') THEN bare || h
    ELSE CASE WHEN contains(f, '://') THEN f ELSE root END || '/' || h END AS t FROM fold),
pairs AS (SELECT DISTINCT src, dst FROM (
            SELECT {_resource("url")} AS src, {_resource("t")} AS dst FROM target)
          WHERE src IS NOT NULL AND dst IS NOT NULL AND src <> dst),
links AS (SELECT src AS u, dst AS v FROM pairs UNION SELECT dst, src FROM pairs),
reach(a, b) AS (SELECT u, u FROM links UNION SELECT r.a, l.v FROM reach r JOIN links l ON r.b = l.u),
acts AS (SELECT a, b, {_rule(_host("b"), _path("b"), "action")} AS act FROM reach),
bad AS (SELECT a AS resource FROM acts GROUP BY a
        HAVING bool_or(act = 'block') AND NOT coalesce(bool_or(act = 'allow'), false)),
own AS (SELECT page_id, {_host("url")} AS host, {_path("url")} AS path, {_resource("url")} AS resource
        FROM pages)
SELECT page_id, host, path, {_rule("host", "path", "name")} AS rule,
       coalesce({_rule("host", "path", "action")},
                CASE WHEN b.resource IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM own LEFT JOIN bad b ON b.resource = own.resource"""

QUALITY = f"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
windows AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i,
                   unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i:i + 2])) AS t FROM w
            WHERE len(ws) >= 3),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, t) > 1),
repeated AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice)
             GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
          FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
          WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id),
stats AS (SELECT doc_id, source, len(ws)::BIGINT AS n_words,
                 length(regexp_replace(text, '{_BLANK}', '', 'g'))::BIGINT AS word_chars,
                 len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
                 coalesce(l.n, 0) AS n_lines, coalesce(l.dup, 0)::BIGINT AS n_dup_lines,
                 coalesce(r.n, 0)::BIGINT AS n_repeat_words
          FROM w LEFT JOIN lines l USING (doc_id) LEFT JOIN repeated r USING (doc_id)),
ruled AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
          FROM stats),
judged AS (SELECT *, base_failed OR n_symbols > {MAX_SYMBOLS_PER_WORD}::DOUBLE * greatest(n_words, 1)
             OR n_dup_lines > {MAX_DUP_LINE_SHARE}::DOUBLE * n_lines
             OR word_chars / greatest(n_words, 1) < {MEAN_WORD_CHARS[0]}::DOUBLE
             OR word_chars / greatest(n_words, 1) > {MEAN_WORD_CHARS[1]}::DOUBLE AS failed FROM ruled),
hosts AS (SELECT source, count(*) AS docs, sum(failed::INTEGER) AS failures FROM judged GROUP BY source),
prior AS (SELECT sum(failures) / sum(docs) AS m,
                 coalesce(var_samp(failures / docs), 0) - (sum(failures) / sum(docs))
                   * (1 - sum(failures) / sum(docs)) * avg(1.0::DOUBLE / docs) AS v FROM hosts),
beta AS (SELECT m, CASE WHEN v > 1e-6 THEN greatest(m * (1 - m) / v - 1, 1.0) ELSE 1e6 END AS s FROM prior),
verdicts AS (SELECT source, (failures + s * m) / (docs + s) <= {MAX_HOST_RATE} AS host_kept FROM hosts, beta)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT failed AND host_kept AS kept
FROM judged j JOIN verdicts v ON j.source IS NOT DISTINCT FROM v.source"""

TOPK = """
WITH x AS (SELECT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::HUGEINT) AS x FROM embeddings
           WHERE len(embedding) > 0 AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, p.vec_id,
             list_sum(list_transform(range(1, least(len(q.x), len(p.x)) + 1), lambda i: q.x[i] * p.x[i])) AS score
      FROM x q JOIN x p ON q.vec_id <> p.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, (row_number() OVER best)::INTEGER AS rank, vec_id, try_cast(score AS BIGINT) AS score FROM s
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER best <= 5"""


def _licenses() -> str:
    rows = []
    for exact, (label, text) in ([(True, x) for x in PHRASES.items()] + [(False, x) for x in TEMPLATES]):
        words = text.split(" ")
        first = len(rows)
        rows += [f"({first}, '{label}', {str(exact).lower()}, {t}, {len(words) - K + 1}, "
                 f"'{' '.join(words[t:t + K])}')" for t in range(len(words) - K + 1)]
    return f"""
WITH grams(template, label, exact, t, grams, gram) AS (VALUES {", ".join(rows)}),
w AS (SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")},
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
each AS (SELECT doc_id, unnest(range(0, len(ws) - {K - 1})) AS d,
                unnest(list_transform(range(1, len(ws) - {K - 2}), lambda i: array_to_string(ws[i:i + {K - 1}], ' ')))
                  AS gram FROM w WHERE len(ws) >= {K}),
hits AS (SELECT doc_id, template, label, exact, grams, t, d FROM each JOIN grams USING (gram)),
diag AS (SELECT doc_id, template, label, exact, grams, d - t AS diag, list(DISTINCT t) AS ts,
                min(d) AS lo, max(d) AS hi FROM hits GROUP BY ALL),
steps AS (SELECT *, CASE WHEN NOT exact AND abs(diag - lag(diag) OVER o) <= {MAX_SHIFT}
                          AND lo - lag(lo) OVER o <= grams + {MAX_SHIFT} THEN 0 ELSE 1 END AS new
          FROM diag WINDOW o AS (PARTITION BY doc_id, template ORDER BY lo, diag)),
runs AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY lo, diag
                                  ROWS UNBOUNDED PRECEDING) AS run FROM steps),
spans AS (SELECT doc_id, template, label, exact, grams, len(list_distinct(flatten(list(ts)))) AS n,
                 min(lo) AS start, max(hi) + {K} AS stop FROM runs
          GROUP BY doc_id, template, label, exact, grams, run),
good AS (SELECT *, n / grams AS cover FROM spans
         WHERE CASE WHEN exact THEN n = grams ELSE n / grams >= {MIN_COVER} END),
isles AS (SELECT *, sum(CASE WHEN start < before THEN 0 ELSE 1 END) OVER (
                      PARTITION BY doc_id, exact ORDER BY start, stop, template ROWS UNBOUNDED PRECEDING) AS isle
          FROM (SELECT *, max(stop) OVER (PARTITION BY doc_id, exact ORDER BY start, stop, template
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM good)),
final AS (SELECT * FROM isles
          QUALIFY exact OR cover = max(cover) OVER (PARTITION BY doc_id, exact, isle))
SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, count(*) FILTER (f.exact)::BIGINT AS n_base,
       min(f.start) FILTER (f.exact)::BIGINT AS first_word, max(f.start) FILTER (f.exact)::BIGINT AS last_word,
       coalesce(string_agg(DISTINCT f.label, ',' ORDER BY f.label) FILTER (f.exact), '') AS base_labels,
       coalesce(string_agg(DISTINCT f.label, ',' ORDER BY f.label), '') AS labels,
       coalesce(max(f.cover), 0.0)::DOUBLE AS score
FROM w LEFT JOIN final f USING (doc_id) GROUP BY w.doc_id, len(w.ws)"""


_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

LEAKS = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all({_lower("coalesce(text, '')")}, '{_LETTERS}') AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{_LETTERS}') AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, n, array_to_string(ws[s + 1:s + n], ' ') AS w
        FROM (SELECT item_id, ws, n, unnest(range(0, len(ws) - n + 1)) AS s
              FROM (SELECT *, least({WINDOW}, len(ws)) AS n FROM i WHERE len(ws) > 0))),
own AS (SELECT r, s, n, array_to_string(ws[s + 1:s + n], ' ') AS w
        FROM (SELECT r, ws, n, unnest(range(0, len(ws) - n + 1)) AS s
              FROM d JOIN (SELECT DISTINCT n FROM win) ON len(ws) >= n)),
hit AS (SELECT * FROM own WHERE w IN (SELECT w FROM win)),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r),
ids AS (SELECT r, count(item_id) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT r, item_id, item_id::VARCHAR AS id FROM hit JOIN win USING (w)) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN ids USING (r)"""


def _centroids() -> str:
    """All rounds, unrolled.  Scalar products of whole numbers are exact in floating
    point below 2^53, which holds for components up to some 30,000."""
    dot = "list_inner_product"
    parts = [f"""k AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, embedding,
         list_transform(embedding, lambda v: floor({SCALE} * v::DOUBLE)) AS x FROM embeddings
  WHERE len(embedding) = {DIM}
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v::DOUBLE))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR), embedding, r) - 1 AS c, x
  FROM k WHERE vec_id IS NOT NULL QUALIFY c < {CLUSTERS})"""]
    for i in range(ROUNDS + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, b[1]::BIGINT AS d, b[2]::INTEGER AS c
  FROM (SELECT k.r, min([{dot}(k.x, k.x) + {dot}(c.x, c.x) - 2 * {dot}(k.x, c.x), c.c::DOUBLE]) AS b
        FROM k, c{i} c GROUP BY k.r))""")
        if i < ROUNDS:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN (
    SELECT c, list(floor(s / n) ORDER BY j) AS x
    FROM (SELECT a.c, j, sum(k.x[j]) AS s, count(*) AS n
          FROM a{i} a JOIN k USING (r), range(1, {DIM} + 1) t(j) GROUP BY a.c, j) GROUP BY c) m ON m.c = c.c)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT k.vec_id, a.c AS cluster, a.d AS distance, sum(a.d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia,
       sum(a.d) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(list_transform(m.x, lambda v: v::BIGINT::VARCHAR), ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN k USING (r) JOIN c{ROUNDS} m ON m.c = a.c"""


#: The CRC-32 of the decimal ``conv_id``, byte by byte and bit by bit.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
    list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)), lambda c, b:
    list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i:
      xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))))"""

TRIE = f"""
WITH t AS (SELECT conv_id, coalesce(text, '') AS x, md5(coalesce(role, '')) || md5(coalesce(text, '')) AS m,
                  row_number() OVER (PARTITION BY conv_id
                                     ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
           FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, {_CRC} % {SHARED} AS h, conv_id - conv_id % {GROUP} AS base
        FROM (SELECT DISTINCT conv_id FROM t)),
turns AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, p) AS d, m, len(x) AS chars FROM (
            SELECT ids.conv_id AS c, 0 AS part, p, m, x FROM ids JOIN t ON t.conv_id = base AND p <= h
            UNION ALL SELECT ids.conv_id, 1, p, m, x FROM ids JOIN t USING (conv_id) WHERE p > h)),
paths AS (SELECT c, d, chars, string_agg(m, ',') OVER (PARTITION BY c ORDER BY d) AS k FROM turns
          UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
nodes AS (SELECT k, any_value(d) AS d, any_value(chars) AS chars, min(c) AS conv_id, count(*) AS n FROM paths GROUP BY k),
up AS (SELECT DISTINCT b.k, a.k AS parent FROM paths a JOIN paths b ON a.c = b.c AND b.d = a.d + 1),
below AS (SELECT DISTINCT a.k, b.k AS lower FROM paths a JOIN paths b ON a.c = b.c AND b.d >= a.d),
kids AS (SELECT parent AS k, count(*) AS n FROM up GROUP BY parent),
sums AS (SELECT b.k, count(*) FILTER (WHERE kids.n IS NULL) AS leaves, sum((nodes.n - 1) * nodes.chars) AS saved
         FROM below b JOIN nodes ON nodes.k = b.lower LEFT JOIN kids ON kids.k = b.lower GROUP BY b.k),
ends AS (SELECT k, string_agg(c::VARCHAR, ',' ORDER BY c) AS list
         FROM (SELECT * FROM paths QUALIFY d = max(d) OVER (PARTITION BY c)) GROUP BY k)
SELECT nodes.conv_id, nodes.d::BIGINT AS depth, p.conv_id AS parent_conv_id, nodes.n::BIGINT AS n_convs,
       coalesce(kids.n, 0)::BIGINT AS n_children, sums.leaves::BIGINT AS n_leaves,
       sums.saved::BIGINT AS saved_tokens, sha256(coalesce(ends.list, '')) AS ends_sha256
FROM nodes LEFT JOIN up USING (k) LEFT JOIN nodes p ON p.k = up.parent LEFT JOIN kids ON kids.k = nodes.k
JOIN sums ON sums.k = nodes.k LEFT JOIN ends ON ends.k = nodes.k"""


SQL: dict[str, str] = {
    "op3_neardup": NEARDUP,
    "op5_urls": URLS,
    "op7_quality": QUALITY,
    "op8_topk": TOPK,
    "op9_licenses": _licenses(),
    "op11_prefix_trie": TRIE,
    "op12_centroids": _centroids(),
    "op13_decontamination": LEAKS,
}
