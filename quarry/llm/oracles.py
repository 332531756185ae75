r"""DuckDB SQL for the operators that SQL can say: line dedup, quality rules, decontamination, substring dedup, URL filters, phrases.

Fingerprints by XXH64, suffix order over bytes, spans with positions, trained models and token ids are beyond it; tests
hold those operators against brute-force versions.
"""

import string

from quarry.llm import phrases, quality, urls

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

LINE_DEDUP = rf"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, k, ls[k] AS line, list_sort(list_distinct(regexp_extract_all(ls[k], '[^\x20\x09-\x0D]+'))) AS s
          FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS k FROM split)),
sets AS (SELECT s, len(s) AS n, min((doc_id, k)) AS f, row_number() OVER () AS x FROM lines WHERE len(s) > 0 GROUP BY s),
words AS (SELECT x, n, f, unnest(s) AS w FROM sets),
ranked AS (SELECT x, n, f, w, row_number() OVER (PARTITION BY x ORDER BY c, w) AS r
           FROM words JOIN (SELECT w, count(*) AS c FROM words GROUP BY w) USING (w)),
prefix AS (SELECT * FROM ranked WHERE r <= n - (4 * n + 4) // 5 + 1),
pairs AS (SELECT DISTINCT a.x, b.x AS y FROM prefix a JOIN prefix b ON a.w = b.w AND b.f < a.f AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
matched AS (SELECT DISTINCT p.x FROM pairs p JOIN sets a ON a.x = p.x JOIN sets b ON b.x = p.y
            WHERE 9 * len(list_intersect(a.s, b.s)) >= 4 * (a.n + b.n)),
judged AS (SELECT l.doc_id, l.k, l.line, len(l.s) > 0 AS has_word,
                  coalesce(m.x IS NOT NULL OR (l.doc_id, l.k) <> t.f, false) AS gone
           FROM lines l LEFT JOIN sets t ON t.s = l.s LEFT JOIN matched m ON m.x = t.x)
SELECT doc_id, count(*) FILTER (has_word) AS n_lines, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


def _quality() -> str:
    rates = " UNION ALL ".join(
        f"SELECT doc_id, lang, source, '{name}' AS rate, {k} AS nth, {slack} AS slack, {str(both).lower()} AS both_sides, ({part} * 1000) // greatest({whole}, 1) AS v FROM counts"
        for k, (name, (part, whole, slack, both)) in enumerate(quality.RATES.items())
    )
    levels = []
    for level, keys in (("a", ["lang", "source"]), ("b", ["lang"]), ("c", [])):
        by = ", ".join([*keys, "rate"])
        levels.append(
            f"""{level} AS (SELECT {by}, max(total) AS total, min(edge) FILTER (4 * upto >= total) AS q25, min(edge) FILTER (4 * upto >= 3 * total) AS q75
    FROM (SELECT *, sum(n) OVER (PARTITION BY {by} ORDER BY edge) AS upto, sum(n) OVER (PARTITION BY {by}) AS total
          FROM (SELECT {by}, edge, count(*) AS n FROM edges GROUP BY {by}, edge)) GROUP BY {by})"""
        )
    return rf"""
WITH base AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
grams AS (SELECT doc_id, i, ws[i : i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM base)),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams), range(0, 3) r(k)
            WHERE c > 1 GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT l) AS dup FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM base)
          WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
counts AS (SELECT doc_id, lang, source, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
                  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(lines.dup, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
                  coalesce(lines.n, 0) AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals
           FROM base LEFT JOIN repeats USING (doc_id) LEFT JOIN lines USING (doc_id)),
rates AS ({rates}),
edges AS (SELECT r.lang, r.source, r.rate, (v >> greatest(0, length(bin(v)) - 8)::BIGINT) << greatest(0, length(bin(v)) - 8)::BIGINT AS edge
          FROM rates r JOIN counts USING (doc_id) WHERE n_words > 0),
{", ".join(levels)},
used AS (SELECT a.lang, a.source, a.rate, CASE WHEN a.total >= {quality.MIN_ROWS} THEN a.q25 WHEN b.total >= {quality.MIN_ROWS} THEN b.q25 ELSE c.q25 END AS q25,
                CASE WHEN a.total >= {quality.MIN_ROWS} THEN a.q75 WHEN b.total >= {quality.MIN_ROWS} THEN b.q75 ELSE c.q75 END AS q75
         FROM a JOIN b ON a.lang IS NOT DISTINCT FROM b.lang AND a.rate = b.rate JOIN c ON a.rate = c.rate),
failed AS (SELECT r.doc_id, string_agg(r.rate, ',' ORDER BY nth) AS rules FROM rates r
           JOIN used u ON r.lang IS NOT DISTINCT FROM u.lang AND r.source IS NOT DISTINCT FROM u.source AND r.rate = u.rate
           WHERE v > q75 + {quality.FENCE} * greatest(q75 - q25, slack) OR (both_sides AND v < q25 - {quality.FENCE} * greatest(q75 - q25, slack)) GROUP BY r.doc_id),
judged AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rules IS NULL AS kept, coalesce(rules, '') AS failed_rules
FROM judged LEFT JOIN failed USING (doc_id)"""


QUALITY = _quality()

DECONTAMINATE = r"""
WITH items AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS ws FROM benchmark),
docs AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS ws FROM documents),
item_grams AS (SELECT item_id, n, g, count(*) AS c FROM (SELECT item_id, len(ws) AS n, ws[i : i + 4] AS g FROM (SELECT item_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM items)) GROUP BY ALL),
doc_grams AS (SELECT doc_id, len(ws) AS m, i, ws[i : i + 4] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM docs)),
hits AS (SELECT doc_id, item_id, m, n, i, g, c FROM doc_grams JOIN item_grams USING (g)),
starts AS (SELECT DISTINCT doc_id, item_id, m, n, start FROM (SELECT doc_id, item_id, m, n, unnest(range(greatest(1, i - n + 5), least(i, greatest(m - n + 1, 1)) + 1)) AS start FROM hits)),
common AS (SELECT doc_id, item_id, m, n, start, sum(least(k, c)) AS shared FROM
           (SELECT s.doc_id, s.item_id, s.m, s.n, s.start, h.g, h.c, count(*) AS k FROM starts s
            JOIN hits h ON h.doc_id = s.doc_id AND h.item_id = s.item_id AND h.i BETWEEN s.start AND s.start + s.n - 5 GROUP BY ALL) GROUP BY ALL),
scored AS (SELECT doc_id, item_id, start - 1 AS start, n AS n_words, shared / ((n - 4) + (least(m, n) - 4) - shared) AS similarity FROM common)
SELECT doc_id, item_id, round(similarity, 6) AS similarity, start, n_words FROM scored WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1"""

SUBSTRING = rf"""
WITH docs AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
windows AS (SELECT doc_id, i, ws[i : i + 12] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM docs)),
least AS (SELECT g, min(doc_id) AS least FROM windows GROUP BY g),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM windows JOIN least USING (g), range(0, 13) r(k) WHERE doc_id > least),
words AS (SELECT doc_id, ws[p] AS w, p FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM docs)),
cut AS (SELECT doc_id, count(gone.p) AS n_removed, string_agg(w, ' ' ORDER BY words.p) FILTER (gone.p IS NULL) AS kept FROM words LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM docs LEFT JOIN cut USING (doc_id)"""


def _urls() -> str:
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    by_length = sorted(urls.RULES, key=lambda r: (-len(r[1]), -r[1].index("/")))
    fits = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}') THEN '{h}/{p}'" for h, p in (r.split("/", 1) for _, r in by_length))
    verdicts = " ".join(f"WHEN '{r}' THEN '{v}'" for v, r in by_length)
    link = urls.LINK.replace("'", "''")
    return rf"""
WITH RECURSIVE split AS (SELECT page_id, html, translate(coalesce(regexp_extract(url, '{urls.URL}', 1), ''), '{upper}', '{lower}') AS host, coalesce(regexp_extract(url, '{urls.URL}', 2), '') AS path FROM pages),
ruled AS (SELECT *, CASE rule {verdicts} END AS by_rule FROM (SELECT *, CASE {fits} END AS rule FROM split)),
hosts AS (SELECT *, CASE WHEN 2 * allowed > pages THEN 0 WHEN 2 * blocked > pages THEN 1 END AS side
          FROM (SELECT host, count(*) AS pages, count(*) FILTER (by_rule = 'allow') AS allowed, count(*) FILTER (by_rule = 'block') AS blocked FROM ruled WHERE host <> '' GROUP BY host)),
seeds AS (SELECT side, host, {urls.UNITS} // count(*) OVER (PARTITION BY side) AS amount FROM hosts WHERE side IS NOT NULL),
targets AS (SELECT DISTINCT page, src, translate(regexp_extract(a, '{urls.LINK_HOST}', 1), '{upper}', '{lower}') AS dst
            FROM (SELECT row_number() OVER () AS page, host AS src, unnest(regexp_extract_all(regexp_replace(html, '{urls.NO_LINKS}', ' ', 'g'), '{link}', 1)) AS a FROM split)),
edges AS (SELECT src, dst, count(*) AS pages FROM targets WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
arcs AS (SELECT *, sum(pages) OVER (PARTITION BY side, a)::BIGINT AS total FROM (SELECT 0 AS side, src AS a, dst AS b, pages FROM edges UNION ALL SELECT 1, dst, src, pages FROM edges)),
spread AS (SELECT 0 AS k, side, host, amount::BIGINT AS amount FROM seeds
           UNION ALL
           SELECT k, side, host, amount FROM (
             SELECT s.k + 1 AS k, s.side, b AS host, sum((amount * {urls.DAMPING} // 100 // total) * pages + (amount * {urls.DAMPING} // 100 % total) * pages // total)::BIGINT AS amount
             FROM spread s JOIN arcs ON s.side = arcs.side AND s.host = arcs.a WHERE s.k < {urls.ROUNDS} GROUP BY s.k + 1, s.side, b) WHERE amount > 0),
scores AS (SELECT host, coalesce(sum(amount) FILTER (side = 0), 0) AS trust, coalesce(sum(amount) FILTER (side = 1), 0) AS distrust FROM spread GROUP BY host),
totals AS (SELECT greatest(1, coalesce(sum(trust), 0)) AS all_trust, greatest(1, coalesce(sum(distrust), 0)) AS all_distrust, (SELECT count(*) FROM hosts) AS n FROM scores)
SELECT page_id, host, path, rule,
       coalesce(by_rule, CASE WHEN distrust * n >= {urls.LIFT} * all_distrust AND distrust * all_trust > trust * all_distrust THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(trust, 0)::BIGINT AS trust, coalesce(distrust, 0)::BIGINT AS distrust
FROM ruled LEFT JOIN scores USING (host), totals"""


URLS = _urls()

PHRASES = rf"""
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS t FROM documents),
pieces AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM docs)),
grams AS (SELECT lang, g, count(*) AS f FROM (SELECT lang, ws[i : i + m - 1] AS g FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM pieces, range(1, {phrases.WORDS + 1}) r(m)))
          GROUP BY lang, g HAVING count(*) >= {phrases.MIN_COUNT}),
totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM pieces GROUP BY lang),
inner_ AS (SELECT lang, g[i : j] AS g, max(f) AS longer FROM (SELECT lang, g, f, i, unnest(range(i, len(g) + 1)) AS j FROM (SELECT lang, g, f, unnest(range(1, len(g) + 1)) AS i FROM grams))
           WHERE j - i + 1 < len(g) GROUP BY ALL),
own AS (SELECT grams.* FROM grams LEFT JOIN inner_ USING (lang, g) WHERE len(g) > 1 AND (longer IS NULL OR 100 * longer < 100 * f)),
cuts AS (SELECT c.lang, c.g, c.f AS a, k, x.f AS l, y.f AS r, n, ((1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
         FROM (SELECT *, unnest(range(1, len(g))) AS k FROM own) c JOIN grams x ON x.lang = c.lang AND x.g = c.g[1 : k] JOIN grams y ON y.lang = c.lang AND y.g = c.g[k + 1 :] JOIN totals t ON t.lang = c.lang),
least AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank, array_to_string(g, ' ') AS phrase, a, l, r, n, score
FROM least QUALIFY rank <= {phrases.TOP}"""

ORACLES = {"op1_line_dedup": LINE_DEDUP, "op3_quality_rules": QUALITY, "op4_decontaminate": DECONTAMINATE, "op9_substring_dedup": SUBSTRING, "op11_url_filter": URLS, "op12_phrases": PHRASES}
