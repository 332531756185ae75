"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly against the driver views, without any of the Spark code paths. Column names
and types match the Spark results (``BIGINT`` counts and ranks, ``INTEGER`` for int fields).
"""

from __future__ import annotations

# Regex pieces (RE2 syntax; SQL literals keep backslashes as they are).
_WS = r"[ \t\n\x0B\f\r]"
_WORD = r"^[^\n\r\x{85}\x{2028}\x{2029}]*[a-zA-Z][^\n\r\x{85}\x{2028}\x{2029}]*\z"


def _java_split(v: str, pat: str) -> str:
    body = f"regexp_replace({v}, '({pat})+\\z', '')"
    return (f"(CASE WHEN {v} = '' THEN [''] WHEN {body} = '' THEN []::VARCHAR[] "
            f"ELSE regexp_split_to_array({body}, '{pat}') END)")


def _lines(t: str) -> str:
    return (f"(CASE WHEN {t} = '' THEN []::VARCHAR[] ELSE regexp_split_to_array("
            f"regexp_replace({t}, '(\\r\\n|\\r|\\n)\\z', ''), '\\r\\n|\\r|\\n') END)")


def _classify(t: str) -> str:
    return (f"(CASE WHEN regexp_matches(lower({t}), '{_WORD}') "
            f"THEN regexp_replace(lower({t}), '[^a-zA-Z0-9]', '', 'g') "
            f"WHEN right(lower({t}), 1) IN ('.', '?', '!') THEN '|' END)")


def _strict_int(v: str, typ: str) -> str:
    return f"(CASE WHEN regexp_full_match({v}, '[+-]?[0-9]+') THEN TRY_CAST({v} AS {typ}) END)"


def _trim_ip(v: str) -> str:
    return f"(CASE WHEN strpos({v}, '.') > 0 THEN regexp_replace({v}, '\\.[^.]*\\z', '') END)"


DOC_LINES = f"doc_lines AS (SELECT doc_id, unnest({_lines('text')}) AS line FROM documents)"

TRACE_LINE = """concat_ws(' ',
    concat(lpad(CAST(((event_id * 7919) % 86400) // 3600 AS VARCHAR), 2, '0'), ':',
           lpad(CAST((((event_id * 7919) % 86400) // 60) % 60 AS VARCHAR), 2, '0'), ':',
           lpad(CAST(((event_id * 7919) % 86400) % 60 AS VARCHAR), 2, '0')),
    CAST(event_id AS VARCHAR),
    CASE WHEN event_type = 'error' AND user_id < 3 THEN concat('host', CAST(user_id AS VARCHAR))
         ELSE concat_ws('.', '10', CAST(user_id // 256 AS VARCHAR), CAST(user_id % 256 AS VARCHAR),
                        CAST(event_id % 4 AS VARCHAR), CAST(1024 + (event_id * 13) % 977 AS VARCHAR)) END,
    '>',
    concat_ws('.', '172', '16', CAST((event_id * 31) % 50 AS VARCHAR), CAST((event_id * 17) % 7 AS VARCHAR),
              CAST(80 + event_id % 3 AS VARCHAR)),
    CASE event_type WHEN 'click' THEN 'tcp' WHEN 'view' THEN 'TCP' WHEN 'purchase' THEN 'Tcp'
                    WHEN 'signup' THEN 'udp' ELSE 'tcp' END)"""

TRACE_FIELDS = f"""trace AS (SELECT string_split({TRACE_LINE}, ' ') AS p FROM events),
net AS (SELECT p[3] AS source_ip, p[5] AS destination_ip, p[6] AS protocol FROM trace)"""

FIREWALL = f"""trace AS (SELECT string_split({TRACE_LINE}, ' ') AS p FROM events),
t AS (SELECT p[1] AS time, CAST(p[2] AS INTEGER) AS connection_id, p[3] AS source_ip, p[5] AS destination_ip
      FROM trace),
vl AS (SELECT string_split(concat(CAST(o_orderkey AS VARCHAR), ' ',
        CASE o_orderstatus WHEN 'F' THEN 'Blocked' WHEN 'P' THEN 'blocked' ELSE 'Allowed' END, ' '), ' ') AS p
       FROM orders),
v AS (SELECT CAST(p[1] AS INTEGER) AS connection_id, p[2] AS action FROM vl)"""

KV = """kvl AS (SELECT o_orderkey AS line_id, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority
        ELSE concat_ws(chr(9), o_orderpriority, CAST(o_orderkey AS VARCHAR), o_orderstatus) END AS line FROM orders),
kv AS (SELECT line_id,
        CASE WHEN strpos(line, chr(9)) > 0 THEN substr(line, 1, strpos(line, chr(9)) - 1) ELSE line END AS key,
        CASE WHEN strpos(line, chr(9)) > 0 THEN substr(line, strpos(line, chr(9)) + 1) ELSE '' END AS value
       FROM kvl)"""

TSV = f"""tl AS (SELECT string_split(CASE WHEN l_linenumber = 7
          THEN concat_ws(chr(9), CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR))
          ELSE concat_ws(chr(9), CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
                         CAST(l_linenumber AS VARCHAR),
                         CASE WHEN l_linenumber = 4 THEN 'n/a' ELSE CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) END,
                         l_returnflag, l_linestatus) END, chr(9)) AS p FROM lineitem),
typed AS (SELECT {_strict_int('p[1]', 'BIGINT')} AS l_orderkey, {_strict_int('p[2]', 'BIGINT')} AS l_partkey,
                 {_strict_int('p[3]', 'BIGINT')} AS l_suppkey, {_strict_int('p[4]', 'INTEGER')} AS l_linenumber,
                 {_strict_int('p[5]', 'BIGINT')} AS l_quantity, p[6] AS l_returnflag, p[7] AS l_linestatus FROM tl)"""

EDGES = """e AS (SELECT DISTINCT least(l_partkey, l_suppkey) AS u, greatest(l_partkey, l_suppkey) AS v
      FROM lineitem WHERE l_partkey <> l_suppkey)"""

SYM = """sym AS (SELECT l_partkey AS src, l_suppkey AS dst FROM lineitem
        UNION SELECT l_suppkey AS src, l_partkey AS dst FROM lineitem)"""

TRIANGLES = f"""{EDGES},
tri AS (SELECT x.u AS a, x.v AS b, y.v AS c FROM e x JOIN e y ON x.v = y.u JOIN e z ON z.u = x.u AND z.v = y.v)"""

BUCKET = """CAST(floor(CAST(CASE WHEN key = '' OR ascii(key) < 48 THEN 0
                            WHEN ascii(key) <= 57 THEN ascii(key) - 48
                            WHEN ascii(key) < 65 THEN 9
                            WHEN ascii(key) <= 90 THEN ascii(key) - 55
                            WHEN ascii(key) < 97 THEN 35
                            WHEN ascii(key) <= 122 THEN ascii(key) - 61
                            ELSE 61 END AS DOUBLE) / 62.0 * 10) AS INTEGER)"""

ORACLES: dict[str, str] = {
    "word_count_sorted": f"""WITH {DOC_LINES},
words AS (SELECT unnest({_java_split('line', _WS)}) AS word FROM doc_lines)
SELECT word, count(*) AS n FROM words GROUP BY word""",

    "bigram_count": f"""WITH {DOC_LINES},
toks AS (SELECT list_filter(regexp_split_to_array(lower(line), '[ \\t\\n\\r\\f]+'), lambda x: x <> '') AS ts
         FROM doc_lines),
cls AS (SELECT list_filter(list_transform(ts, lambda t: {_classify('t')}), lambda x: x IS NOT NULL) AS a FROM toks),
pairs AS (SELECT unnest(list_transform(range(1, len(a)), lambda i: {{'w1': a[i], 'w2': a[i + 1]}})) AS p FROM cls)
SELECT p.w1 AS w1, p.w2 AS w2, count(*) AS n FROM pairs WHERE p.w1 <> '|' AND p.w2 <> '|' GROUP BY ALL""",

    "word_window_topk": """WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\\W+'), lambda x: x <> '')
                   AS ws FROM documents),
t AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM d),
o AS (SELECT word, row_number() OVER (ORDER BY doc_id, pos) - 1 AS ord, count(*) OVER () AS total FROM t),
c AS (SELECT ord // 1000 AS window_id, word, count(*) AS n FROM o WHERE ord // 1000 < total // 1000 GROUP BY ALL)
SELECT window_id, row_number() OVER (PARTITION BY window_id ORDER BY n DESC, word) AS rank, word, n
FROM c QUALIFY rank <= 10""",

    "stream_word_window_topk": """WITH w AS (SELECT event_id // 1000 AS window_id,
                   lower(concat(event_type, '_', CAST(user_id AS VARCHAR))) AS word FROM events),
f AS (SELECT window_id FROM w GROUP BY window_id HAVING count(*) = 1000),
c AS (SELECT window_id, word, count(*) AS n FROM w WHERE window_id IN (SELECT window_id FROM f) GROUP BY ALL)
SELECT window_id, row_number() OVER (PARTITION BY window_id ORDER BY n DESC, word) AS rank, word, n
FROM c QUALIFY rank <= 10""",

    "kv_parse": f"WITH {KV} SELECT line_id, key, value FROM kv",

    "delimited_typed_scan": f"WITH {TSV} SELECT * FROM typed",

    "positional_project": f"WITH {TRACE_FIELDS} SELECT source_ip, destination_ip, protocol FROM net",

    "total_order_sort": f"""WITH {KV}
SELECT key, value, row_number() OVER (ORDER BY key, value) AS rank FROM kv""",

    "first_char_bucket_sort": f"""WITH k AS (SELECT conv_id, turn, text AS key FROM conversations),
b AS (SELECT conv_id, turn, key, {BUCKET} AS bucket FROM k)
SELECT conv_id, turn, bucket, row_number() OVER (PARTITION BY bucket ORDER BY key, conv_id, turn) AS rank_in_bucket
FROM b""",

    "sum_by_key_topk": f"""WITH {TSV},
s AS (SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS total_quantity FROM typed GROUP BY l_partkey)
SELECT l_partkey, total_quantity,
       row_number() OVER (ORDER BY total_quantity DESC NULLS LAST, l_partkey ASC NULLS LAST) AS rank
FROM s QUALIFY rank <= 10""",

    "tcp_filter": f"""WITH {TRACE_FIELDS}
SELECT source_ip, destination_ip, protocol FROM net WHERE protocol IN ('tcp', 'TCP')""",

    "ip_prefix_trim": f"""WITH {TRACE_FIELDS}
SELECT {_trim_ip('source_ip')} AS source_subnet, {_trim_ip('destination_ip')} AS destination_subnet
FROM net WHERE protocol IN ('tcp', 'TCP')""",

    "distinct_count_topk": f"""WITH {TRACE_FIELDS},
s AS (SELECT {_trim_ip('source_ip')} AS source_subnet, {_trim_ip('destination_ip')} AS destination_subnet
      FROM net WHERE protocol IN ('tcp', 'TCP')),
c AS (SELECT source_subnet, count(DISTINCT destination_subnet) AS n_destinations FROM s GROUP BY source_subnet)
SELECT source_subnet, n_destinations,
       row_number() OVER (ORDER BY n_destinations DESC, source_subnet ASC NULLS LAST) AS rank
FROM c QUALIFY rank <= 10""",

    "firewall_log": f"""WITH {FIREWALL}
SELECT t.time, t.connection_id, t.source_ip, t.destination_ip, v.action
FROM t JOIN v ON t.connection_id = v.connection_id WHERE lower(v.action) = 'blocked'""",

    "firewall_log_case_sensitive": f"""WITH {FIREWALL}
SELECT t.time, t.connection_id, t.source_ip, t.destination_ip, v.action
FROM t JOIN v ON t.connection_id = v.connection_id WHERE v.action = 'Blocked'""",

    "blocked_count_by_source": f"""WITH {FIREWALL}
SELECT t.source_ip, count(t.source_ip) AS num_blocks
FROM t JOIN v ON t.connection_id = v.connection_id WHERE lower(v.action) = 'blocked' GROUP BY t.source_ip""",

    "top_item_per_group": """WITH rl AS (SELECT string_split(concat_ws(',', p_name, p_type, p_brand, CAST(p_partkey AS VARCHAR),
          'f4', 'f5', 'f6', 'f7', 'f8', 'f9', 'f10', 'f11', CAST(p_size AS VARCHAR)), ',') AS p FROM part),
r AS (SELECT p[1] AS name, p[2] AS language, CAST(p[13] AS INTEGER) AS stars FROM rl),
c AS (SELECT language, count(*) AS n_repos, max(stars) AS top_stars FROM r GROUP BY language),
b AS (SELECT language, name AS top_repo FROM r
      QUALIFY row_number() OVER (PARTITION BY language ORDER BY stars DESC, name) = 1)
SELECT c.language, c.n_repos, b.top_repo, c.top_stars FROM c JOIN b ON c.language = b.language""",

    "edge_parse": f"""WITH el AS (SELECT CASE l_linenumber
          WHEN 2 THEN concat(CAST(l_partkey AS VARCHAR), chr(9), CAST(l_suppkey AS VARCHAR), chr(9))
          WHEN 3 THEN concat(' ', CAST(l_partkey AS VARCHAR), chr(9), CAST(l_suppkey AS VARCHAR))
          WHEN 5 THEN concat(CAST(l_partkey AS VARCHAR), chr(9), CAST(l_suppkey AS VARCHAR), chr(9),
                             CAST(l_orderkey AS VARCHAR))
          WHEN 6 THEN concat('x', CAST(l_partkey AS VARCHAR), chr(9), CAST(l_suppkey AS VARCHAR))
          ELSE concat(CAST(l_partkey AS VARCHAR), chr(9), CAST(l_suppkey AS VARCHAR)) END AS line FROM lineitem),
sp AS (SELECT {_java_split('line', chr(92) + 't')} AS p FROM el)
SELECT {_strict_int('p[1]', 'BIGINT')} AS src, {_strict_int('p[2]', 'BIGINT')} AS dst FROM sp
WHERE len(p) = 2 AND src IS NOT NULL AND dst IS NOT NULL""",

    "edge_symmetrize_distinct": f"WITH {SYM} SELECT src, dst FROM sym",

    "adjacency_list": f"""WITH {SYM}
SELECT src AS vertex, dst // 1024 AS chunk, array_to_string(list_sort(list(dst)), ',') AS neighbors
FROM sym GROUP BY src, dst // 1024""",

    "ordered_wedges": f"""WITH {EDGES},
s AS (SELECT v AS vertex, 1 AS lower, 0 AS higher FROM e UNION ALL SELECT u, 0, 1 FROM e),
g AS (SELECT vertex, sum(lower) AS lo, sum(higher) AS hi FROM s GROUP BY vertex)
SELECT vertex AS center, CAST(lo * hi AS BIGINT) AS n_wedges FROM g WHERE lo * hi > 0""",

    "triangles_per_vertex": f"""WITH {TRIANGLES}
SELECT a AS vertex, count(*) AS n_triangles FROM tri GROUP BY a""",

    "triangle_count": f"WITH {TRIANGLES} SELECT count(*) AS n_triangles FROM tri",
}

# Bigrams over count windows of raw tokens (T2 tokens of every line, in document order).
ORACLES["bigram_window_topk"] = f"""WITH d AS (SELECT doc_id, {_lines('text')} AS ls FROM documents),
dl AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS ln FROM d),
tk AS (SELECT doc_id, ln, {_java_split('line', ' ')} AS ts FROM dl),
t AS (SELECT doc_id, ln, unnest(ts) AS tok, unnest(range(len(ts))) AS pos FROM tk),
o AS (SELECT tok, row_number() OVER (ORDER BY doc_id, ln, pos) - 1 AS ord, count(*) OVER () AS total FROM t),
k AS (SELECT ord // 1000 AS window_id, ord, {_classify('tok')} AS c FROM o WHERE ord // 1000 < total // 1000),
p AS (SELECT window_id, lag(c) OVER (PARTITION BY window_id ORDER BY ord) AS w1, c AS w2 FROM k WHERE c IS NOT NULL),
cnt AS (SELECT window_id, w1, w2, count(*) AS n FROM p WHERE w1 IS NOT NULL AND w1 <> '|' AND w2 <> '|' GROUP BY ALL)
SELECT window_id, row_number() OVER (PARTITION BY window_id ORDER BY n DESC, w1, w2) AS rank, w1, w2, n
FROM cnt QUALIFY rank <= 10"""

ORACLES["stream_bigram_window_topk"] = f"""WITH t AS (SELECT event_id // 1000 AS window_id, event_id AS ord,
                   CASE WHEN event_type = 'error' THEN '!' ELSE event_type END AS tok FROM events),
f AS (SELECT window_id FROM t GROUP BY window_id HAVING count(*) = 1000),
k AS (SELECT window_id, ord, {_classify('tok')} AS c FROM t WHERE window_id IN (SELECT window_id FROM f)),
p AS (SELECT window_id, lag(c) OVER (PARTITION BY window_id ORDER BY ord) AS w1, c AS w2 FROM k WHERE c IS NOT NULL),
cnt AS (SELECT window_id, w1, w2, count(*) AS n FROM p WHERE w1 IS NOT NULL AND w1 <> '|' AND w2 <> '|' GROUP BY ALL)
SELECT window_id, row_number() OVER (PARTITION BY window_id ORDER BY n DESC, w1, w2) AS rank, w1, w2, n
FROM cnt QUALIFY rank <= 10"""

# A stream of the documents' lines as text files reports the windows of the batch.
ORACLES["stream_text_word_window_topk"] = ORACLES["word_window_topk"]
ORACLES["stream_text_bigram_window_topk"] = ORACLES["bigram_window_topk"]
ORACLES["stream_firewall_log"] = ORACLES["firewall_log"]
ORACLES["stream_blocked_count_by_source"] = ORACLES["blocked_count_by_source"]

_BIGRAM_PREFIX, _BIGRAM_LAST = ORACLES["bigram_count"].rsplit("\nSELECT ", 1)
ORACLES["bigram_topk"] = f"""{_BIGRAM_PREFIX},
c AS (SELECT {_BIGRAM_LAST})
SELECT row_number() OVER (ORDER BY n DESC, w1, w2) AS rank, w1, w2, n FROM c QUALIFY rank <= 10"""
ORACLES["kept_bigram_count"] = ORACLES["bigram_count"]
ORACLES["arriving_triangle_count"] = ORACLES["triangle_count"]
ORACLES["distinct_count_topk_from_days"] = ORACLES["distinct_count_topk"]

_EDGE_LINES, _ = ORACLES["edge_parse"].split("\nSELECT ", 1)
_WHOLE_PAIR = "regexp_full_match(p[1], '[+-]?[0-9]+') AND regexp_full_match(p[2], '[+-]?[0-9]+')"
ORACLES["edge_parse_with_rejects"] = _EDGE_LINES.replace("AS p FROM el", "AS p, line FROM el") + f""",
r AS (SELECT line, p, CASE WHEN len(p) <> 2 THEN 'number of fields' WHEN NOT ({_WHOLE_PAIR}) THEN 'no whole number'
                           WHEN TRY_CAST(p[1] AS BIGINT) IS NULL OR TRY_CAST(p[2] AS BIGINT) IS NULL THEN 'beyond the range' END AS reason FROM sp)
SELECT CASE WHEN reason IS NULL THEN CAST(p[1] AS BIGINT) END AS src, CASE WHEN reason IS NULL THEN CAST(p[2] AS BIGINT) END AS dst,
       CASE WHEN reason IS NOT NULL THEN line END AS line, reason FROM r"""
ORACLES["sampled_two_paths"] = f"""WITH {SYM},
s AS (SELECT DISTINCT src, dst FROM sym WHERE src <> dst),
adj AS (SELECT src AS center, list_sort(list(dst)) AS nbrs, count(*) AS d FROM s GROUP BY src HAVING count(*) > 1),
cum AS (SELECT *, d * (d - 1) // 2 AS w, sum(d * (d - 1) // 2) OVER (ORDER BY center) AS upto FROM adj),
tot AS (SELECT max(upto)::BIGINT AS n_paths FROM cum),
dr AS (SELECT i AS draw, n_paths, ('0x' || substr(md5('0:' || i), 1, 15))::BIGINT % n_paths AS pos FROM range(5000) t(i), tot),
hit AS (SELECT draw, n_paths, center, nbrs, (pos - (upto - w))::BIGINT AS r FROM dr ASOF JOIN cum ON dr.pos < cum.upto),
ij AS (SELECT *, list_filter(range(greatest(1, floor(sqrt(2.0 * r))::BIGINT - 2), floor(sqrt(2.0 * r))::BIGINT + 4), lambda j: j * (j - 1) // 2 <= r AND r < j * (j + 1) // 2)[1] AS j FROM hit),
ab AS (SELECT draw, center, n_paths, nbrs[r - j * (j - 1) // 2 + 1] AS a, nbrs[j + 1] AS b FROM ij)
SELECT draw, center, a, b, EXISTS (SELECT 1 FROM s WHERE s.src = ab.a AND s.dst = ab.b) AS closed, n_paths FROM ab"""
ORACLES["bigram_topk_by_summaries"] = ORACLES["bigram_topk"]


_LENIENT_ID = "nullif(p[2], '')"
_LENIENT_NUMBER = (f"(CASE WHEN regexp_full_match({_LENIENT_ID}, '[\\x00-\\x20]*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?[\\x00-\\x20]*') "
                   f"THEN TRY_CAST(trim({_LENIENT_ID}, chr(9) || ' ') AS DOUBLE) END)")
ORACLES["lenient_trace_scan"] = f"""WITH lines AS (SELECT event_id, CASE event_id % 7
    WHEN 0 THEN concat('10:00:00  10.0.0.1 > ', CAST(event_id AS VARCHAR))
    WHEN 1 THEN concat('10:00:01 ', CAST(event_id AS VARCHAR), '.7 10.0.0.1 > 10.0.0.2')
    WHEN 2 THEN concat('10:00:02 ', chr(9), CAST(event_id AS VARCHAR), ' 10.0.0.1 >  tcp')
    WHEN 3 THEN concat('10:00:03 -', CAST(event_id AS VARCHAR), '.5e0')
    WHEN 4 THEN concat(' ', CAST(3000000000 + event_id AS VARCHAR), ' 10.0.0.1 > 10.0.0.2 ')
    WHEN 5 THEN 'x y 10.0.0.1'
    ELSE concat('10:00:06 ', CAST(event_id AS VARCHAR), ' 10.0.0.1 > 10.0.0.2 tcp') END AS line FROM events),
parts AS (SELECT event_id, string_split(line, ' ') AS p FROM lines)
SELECT event_id, nullif(p[1], '') AS time,
       CASE WHEN regexp_full_match({_LENIENT_ID}, '[+-]?[0-9]+') AND TRY_CAST({_LENIENT_ID} AS INTEGER) IS NOT NULL THEN CAST({_LENIENT_ID} AS INTEGER)
            WHEN {_LENIENT_NUMBER} >= 2147483648 THEN NULL ELSE CAST(trunc({_LENIENT_NUMBER}) AS INTEGER) END AS connection_id,
       nullif(p[3], '') AS source_ip, nullif(p[5], '') AS destination_ip
FROM parts"""
