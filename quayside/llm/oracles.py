"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

from quayside.llm.rules import STOP_WORDS
from quayside.llm.secret_scan import RULES as SECRET_RULES
from quayside.llm.secret_scan import SecretRule

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

OP1 = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
sized AS (SELECT item, w, least(len(w), 13) AS size FROM items WHERE len(w) > 0),
spans AS (
  SELECT DISTINCT item, size, unnest(list_transform(range(1, len(w) - size + 2),
         lambda s: array_to_string(w[s:s + size - 1], ' '))) AS span FROM sized),
sizes AS (SELECT DISTINCT size FROM spans),
windows AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS s,
         unnest(list_transform(range(1, len(w) - size + 2),
                lambda s: array_to_string(w[s:s + size - 1], ' '))) AS span
  FROM words, sizes WHERE len(w) >= size),
hits AS (SELECT doc_id, s, size, item FROM windows JOIN spans USING (size, span)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

BLANK = "[ \\t\\n\\x0B\\f\\r]"
STOPS = ", ".join(f"'{w}'" for w in sorted({*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)}))

OP3 = f"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '{BLANK}+'), lambda x: x <> '') AS w
  FROM documents),
grams AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS s,
         unnest(list_transform(range(1, len(w) - 1), lambda s: w[s:s + 2])) AS g
  FROM base WHERE len(w) >= 3),
repeated AS (
  SELECT doc_id, s FROM (
    SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([s, s + 1, s + 2]) AS p FROM repeated) GROUP BY doc_id),
lines AS (
  SELECT doc_id, list_filter(string_split(t, chr(10)),
         lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]')) AS l FROM base),
counts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT)
           AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         len(list_filter(w, lambda x: x IN ({STOPS}))) AS n_stop_words, len(l) AS n_lines
  FROM base JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars BETWEEN 2 * n_words AND 18 * n_words
       AND 5 * n_symbols <= n_words AND 50 * n_stop_words >= n_words
       AND 2 * n_dup_lines <= n_lines AS kept
FROM judged
"""


def _spans(rank: int, rule: SecretRule) -> str:
    p = rule.pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, unnest(list_filter(list_transform(
      range(1, len(m) + 1), lambda i: {{'least': length(g[i]),
          'start': list_sum(list_transform(b[1:i], lambda x: length(x)))
                   + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0),
          'size': length(m[i])}}), lambda x: x.least >= {rule.least})) AS x
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{p}') AS m,
               regexp_extract_all(coalesce(text, ''), '{p}', {rule.group}) AS g,
               string_split_regex(coalesce(text, ''), '{p}') AS b FROM documents)"""


OP6 = f"""
WITH found AS ({" UNION ALL ".join(_spans(k, r) for k, r in enumerate(SECRET_RULES))}),
placed AS (
  SELECT doc_id, rank, CAST(x.start AS BIGINT) AS s,
         concat(kind, ':', CAST(x.start AS BIGINT), ':', CAST(x.start + x.size AS BIGINT)) AS span
  FROM found),
listed AS (
  SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
         count(*) FILTER (rank = 2) AS n_hex,
         string_agg(span, ',' ORDER BY s, rank) FILTER (rank < 3) AS base,
         string_agg(span, ',' ORDER BY s, rank) AS spans
  FROM placed GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM documents LEFT JOIN listed USING (doc_id)
"""

OP10 = f"""
WITH docs AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '{BLANK}+'),
                             lambda x: x <> '') AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS s,
         unnest(list_transform(range(1, len(w) - 18),
                               lambda s: array_to_string(w[s:s + 19], ' '))) AS win
  FROM docs WHERE len(w) >= 20),
later AS (
  SELECT doc_id, s FROM windows
  QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, s) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM later),
words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM docs),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p)
  GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id) LEFT JOIN counts USING (doc_id)
"""

OP12 = """
WITH own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST) AS w
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
lent AS (
  SELECT *, xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                                           lambda d: CAST(ord(d) AS BIGINT)),
    lambda crc, b: list_reduce(range(8),
      lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(crc, b)),
    4294967295), 4294967295) % 9 AS h
  FROM own),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.w[1:a.h], []), a.w[a.h + 1:]) AS w
  FROM lent a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5),
prefixes AS (
  SELECT conv_id, depth, len(w) = depth AS ends, sha256(to_json(w[1:depth])) AS node,
         CASE WHEN depth > 0 THEN sha256(to_json(w[1:depth - 1])) END AS parent,
         CASE WHEN depth > 0 THEN octet_length(encode(w[depth].t)) ELSE 0 END AS size
  FROM (SELECT conv_id, w, unnest(range(len(w) + 1)) AS depth FROM rebuilt)),
nodes AS (
  SELECT node, any_value(depth) AS depth, any_value(parent) AS parent, any_value(size) AS size,
         min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                         FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefixes GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes GROUP BY parent),
subtrees AS (
  SELECT p.node, sum((n.n_convs - 1) * n.size) AS saved_tokens,
         count(*) FILTER (WHERE n.node NOT IN (SELECT node FROM kids WHERE node IS NOT NULL))
           AS n_leaves
  FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, n.n_convs,
       coalesce(k.n_children, 0) AS n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN subtrees s ON s.node = n.node LEFT JOIN kids k ON k.node = n.node
     LEFT JOIN nodes up ON up.node = n.parent
"""

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

OP13 = f"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages),
firsts AS (SELECT payload, min(page_id) AS first FROM payloads GROUP BY payload),
digits AS (
  SELECT page_id, first, octet_length(encode(payload)) AS size, sha1(payload) AS hex
  FROM payloads JOIN firsts USING (payload))
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('{BASE32}', 1 + CAST(
         (('0x' || substr(hex, 1 + 5 * (k // 4), 5))::INTEGER >> (15 - 5 * (k % 4))) & 31
         AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM digits
"""

SQL = {"op1_winnow_decontamination": OP1, "op3_quality_rules": OP3, "op6_secret_scan": OP6,
       "op10_repeated_substrings": OP10, "op12_conversation_trie": OP12, "op13_warc": OP13}
