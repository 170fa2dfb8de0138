"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from shoplens.llm.licenses import TEMPLATES, bigrams_of

WARC = """
WITH rows AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), groups AS (
  SELECT *, sha256(payload) AS digest, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY sha256(payload)) END AS first
  FROM rows
)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM groups"""

QUALITY_RULES = r"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), spots AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM words
), windows AS (
  SELECT doc_id, i, (w[i], w[i + 1], w[i + 2]) AS gram FROM spots
), twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT word_no) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS word_no FROM twice) GROUP BY doc_id
), lines AS (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM words
), full_lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), counts AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(full_lines.dup, 0)::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words,
         coalesce(full_lines.n, 0) AS n_lines, (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) AS upper
  FROM words LEFT JOIN repeated USING (doc_id) LEFT JOIN full_lines USING (doc_id)
), base AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 10 * n_symbols <= n_words AND 10 * n_dup_lines <= 7 * n_lines
         AND word_chars BETWEEN 2 * n_words AND 15 * n_words AND 2 * upper <= word_chars AS kept
FROM base"""

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), frequent AS (
  SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(frequent.k)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN frequent.k IS NULL THEN line END, chr(10) ORDER BY i), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent USING (k) GROUP BY doc_id"""

DECONTAMINATION = r"""
WITH doc_words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), item_words AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS span
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
), doc_windows AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS span
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM doc_words, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
), hits AS (
  SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, span)
), hit_words AS (
  SELECT doc_id, count(DISTINCT word_no)::BIGINT AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS word_no FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""

CHAT_FORMATTING = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
  SELECT *, length(text) + 4 * (length(text) - length(replace(text, '&', '')))
            + 3 * (length(text) - length(regexp_replace(text, '[<>\[]', '', 'g'))) AS coded,
         length(role) + 4 * (length(role) - length(replace(role, '&', '')))
            + 3 * (length(role) - length(regexp_replace(role, '[<>\[]', '', 'g'))) AS coded_role,
         lag(role) OVER w IS DISTINCT FROM role OR row_number() OVER w = 1 AS opens
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (3 + sum(coded + CASE WHEN NOT opens THEN 3 WHEN role = 'system' THEN 15 WHEN role = 'user' THEN 13
                WHEN role = 'assistant' THEN 7 ELSE 14 + coded_role END))::BIGINT AS formatted_chars,
       count(*) FILTER (opens)::BIGINT AS n_blocks
FROM escaped GROUP BY conv_id"""


def _license_scan() -> str:
    templates = ", ".join(f"('{name}', {sorted(bigrams_of(text))}::VARCHAR[])" for name, text in TEMPLATES)
    return rf"""
WITH templates(name, bigrams) AS (VALUES {templates}), split_lines AS (
  SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), units AS (
  SELECT doc_id, unnest(ls) AS unit, generate_subscripts(ls, 1) - 1 AS line FROM split_lines
  UNION ALL SELECT doc_id, t, -1 FROM split_lines WHERE len(ls) > 1
), words AS (
  SELECT doc_id, line, regexp_extract_all(lower(unit), '[a-z0-9]+') AS ws FROM units
), pairs AS (
  SELECT doc_id, line, list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS bg
  FROM words WHERE len(ws) > 1
), scored AS (
  SELECT doc_id, line, name, 2.0::DOUBLE * len(list_intersect(pairs.bg, bigrams)) / (len(pairs.bg) + len(bigrams)) AS dice
  FROM pairs, templates
), best AS (
  SELECT * FROM scored WHERE dice >= 0.8
  QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY dice DESC, name) = 1
)
SELECT d.doc_id, count(line)::BIGINT AS n_matches,
       coalesce(string_agg(DISTINCT name, ',' ORDER BY name), '') AS licenses,
       coalesce(string_agg(line || ':' || name, ',' ORDER BY line), '') AS places, coalesce(max(dice), 0) AS best_dice
FROM documents d LEFT JOIN best ON best.doc_id = d.doc_id GROUP BY d.doc_id"""


def _vector_codes() -> str:
    """Two rounds over the parts of all vectors, one joined row per part and entry."""
    def assigned(n: int) -> str:
        return f"""assigned{n} AS (
  SELECT r, x.p, min({{'d': list_sum(list_transform(list_zip(x.x, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'e': c.e}}) AS best
  FROM parts x JOIN book{n} c ON c.p = x.p GROUP BY r, x.p)"""

    def book(n: int) -> str:
        return f"""sums{n} AS (
  SELECT a.p, a.best.e AS e, place, sum(v)::BIGINT AS s, count(*) AS n
  FROM assigned{n} a JOIN components v ON v.r = a.r AND v.p = a.p GROUP BY a.p, a.best.e, place
), moved{n} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY place) AS c FROM sums{n} GROUP BY p, e
), book{n + 1} AS (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{n} b LEFT JOIN moved{n} m ON m.p = b.p AND m.e = b.e)"""

    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, embedding FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), shape AS (SELECT (len(embedding) + 15) // 16 AS d FROM kept WHERE r = 1
), components AS (
  SELECT r, vec_id, i // d AS p, i % d AS place, v
  FROM (SELECT r, vec_id, unnest(range(len(embedding))) AS i, floor(256 * unnest(embedding)::DOUBLE)::BIGINT AS v FROM kept) u, shape
), parts AS (SELECT r, vec_id, p, list(v ORDER BY place) AS x FROM components GROUP BY r, vec_id, p
), book0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c
  FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64)
), {assigned(0)}, {book(0)}, {assigned(1)}, {book(1)}, {assigned(2)},
coded AS (
  SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM assigned2 GROUP BY r
), digest AS (
  SELECT sha256(string_agg(v, ',' ORDER BY p, e, place)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(c)::VARCHAR AS v, unnest(range(len(c))) AS place FROM book2) b
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (r), digest"""


def sql() -> dict[str, str]:
    return {"op1_warc_index_merge": WARC, "op3_quality_rules": QUALITY_RULES, "op4_line_dedup": LINE_DEDUP, "op6_decontamination": DECONTAMINATION,
            "op8_license_scan": _license_scan(), "op10_chat_formatting": CHAT_FORMATTING, "op13_vector_codes": _vector_codes()}
