"""DuckDB statements of the queries that SQL can express."""

from __future__ import annotations

CHAT = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), shown AS (
  SELECT *, 12 + length(replace(replace(role, '<|', '<||'), chr(10), '<|nl|>')) + 1
    + length(replace(text, '<|', '<||')) + 11 AS chars FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM shown GROUP BY conv_id
"""

EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

_TAGS = "p|div|li|ul|ol|h[1-6]|br|hr|tr|td|th|table|article|section|nav|header|footer|title|head|body|html|blockquote|pre|main|aside|form"

LINE_DEDUP = rf"""
WITH bare AS (
  SELECT page_id, regexp_extract(lower(coalesce(url, '')), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1) AS host,
    regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
      '(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>|<!--.*?-->', chr(10), 'g'),
      '(?i)</?({_TAGS})\b[^>]*>', chr(10), 'g'), '<[^>]*>', '', 'g') AS text
  FROM pages
), plain AS (
  SELECT page_id, host, replace(replace(replace(replace(replace(replace(replace(replace(text,
    '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') AS text
  FROM bare
), listed AS (
  SELECT row_number() OVER () AS row_no, page_id, host, list_filter(list_transform(string_split(text, chr(10)),
    lambda x: trim(x, ' ' || chr(9) || chr(13) || chr(12))), lambda x: x <> '') AS lines FROM plain
), sizes AS (SELECT host, count(*) AS pages FROM listed GROUP BY host),
seen AS (
  SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM listed) GROUP BY ALL
), common AS (
  SELECT host, list(line) AS lines FROM seen JOIN sizes USING (host) WHERE n / pages > 0.1 AND n >= 3 GROUP BY host
), kept AS (
  SELECT l.page_id, l.host, l.lines, list_filter(l.lines, lambda x: NOT list_contains(coalesce(c.lines, []), x)) AS kept
  FROM listed l LEFT JOIN common c USING (host)
)
SELECT page_id, host, len(lines)::BIGINT AS n_lines, (len(lines) - len(kept))::BIGINT AS n_dropped,
  array_to_string(kept, chr(10)) AS text FROM kept
"""


def decontamination(documents: str = "documents") -> str:
    """CTEs that end in ``matches`` (row_no, doc_id, item_id, similarity), from naive windows."""
    return rf"""
src AS (SELECT row_number() OVER () AS row_no, * FROM {documents}),
doc_words AS (
  SELECT row_no, doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \t\n\v\f\r]+'), lambda w: w <> '') AS w FROM src
), item_words AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \t\n\v\f\r]+'), lambda w: w <> '') AS w FROM benchmark
), item_sh AS (
  SELECT item_id, least(len(w), 5) AS width, len(w) - least(len(w), 5) + 1 AS n,
    unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda i: array_to_string(w[i:i + least(len(w), 5) - 1], ' '))) AS s
  FROM item_words WHERE len(w) > 0
), item_bag AS (SELECT item_id, width, n, s, count(*) AS c FROM item_sh GROUP BY ALL),
widths AS (SELECT DISTINCT width FROM item_bag),
doc_sh AS (
  SELECT row_no, doc_id, width, len(w) - width + 1 AS total,
    unnest(range(0, len(w) - width + 1)) AS p,
    unnest(list_transform(range(1, len(w) - width + 2), lambda i: array_to_string(w[i:i + width - 1], ' '))) AS s
  FROM doc_words, widths WHERE len(w) >= width
), hits AS (
  SELECT d.row_no, d.doc_id, d.total, d.p, d.s, i.item_id, i.n, i.c FROM doc_sh d JOIN item_bag i ON d.width = i.width AND d.s = i.s
), bags AS (
  SELECT a.row_no, a.doc_id, a.item_id, a.p AS start, b.s, least(count(*), any_value(b.c)) AS shared,
    any_value(a.n) AS n, least(any_value(a.n), any_value(a.total) - a.p) AS m
  FROM hits a JOIN hits b ON a.row_no = b.row_no AND a.item_id = b.item_id AND b.p >= a.p AND b.p < a.p + a.n
  GROUP BY a.row_no, a.doc_id, a.item_id, a.p, b.s
), windows AS (
  SELECT row_no, doc_id, item_id, start, sum(shared)::BIGINT AS o, any_value(n) + any_value(m) - sum(shared)::BIGINT AS u
  FROM bags GROUP BY row_no, doc_id, item_id, start
), matches AS (
  SELECT row_no, doc_id, item_id, max(o / u) AS similarity FROM windows WHERE 100 * o >= 75 * u GROUP BY row_no, doc_id, item_id
)"""


DECONTAMINATION = f"WITH {decontamination()} SELECT doc_id, item_id, max(similarity) AS similarity FROM matches GROUP BY doc_id, item_id"


def _leaf(text: str) -> str:
    parts = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def merkle_manifest(documents: str = "documents") -> str:
    """Levels by recursion over groups of eight, and a climb of every leaf through both trees."""
    grown = "SELECT g, level + 1, pos // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM {0} WHERE n > 1 GROUP BY g, level, pos // 8"
    step = (
        "SELECT c.rn, c.g, c.level + 1, c.pos // 8, (c.n + 7) // 8, "
        "sha256(string_agg(CASE WHEN u.pos = c.pos THEN c.folded ELSE u.digest END, '' ORDER BY u.pos)), "
        "c.proof || coalesce(string_agg(u.digest, '' ORDER BY u.pos) FILTER (u.pos <> c.pos), '') "
        "FROM {0} c JOIN {1} u ON u.g = c.g AND u.level = c.level AND u.pos // 8 = c.pos // 8 "
        "WHERE c.n > 1 GROUP BY c.rn, c.g, c.level, c.pos, c.n, c.folded, c.proof"
    )
    return rf"""
WITH RECURSIVE tab AS (
  SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v FROM range(256) r(i))
), src AS (
  SELECT row_number() OVER () AS rn, doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS g, {_leaf("text")} AS leaf,
    {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} AS other,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 3 = 0 AS hit
  FROM {documents}, tab
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM src
), up AS (
  SELECT g, 0::BIGINT AS level, pos, n, leaf AS digest FROM ranked UNION ALL {grown.format("up")}
), subroots AS (SELECT g, digest FROM up WHERE n = 1),
high AS (
  SELECT 0::BIGINT AS g, 0::BIGINT AS level, g - 1 AS pos, count(*) OVER () AS n, digest FROM subroots UNION ALL {grown.format("high")}
), climb AS (
  SELECT rn, g, 0::BIGINT AS level, pos, n, CASE WHEN hit THEN other ELSE leaf END AS folded, '' AS proof FROM ranked UNION ALL {step.format("climb", "up")}
), rise AS (
  SELECT rn, 0::BIGINT AS g, 0::BIGINT AS level, g - 1 AS pos, (SELECT count(*) FROM subroots) AS n, folded, proof FROM climb WHERE n = 1
  UNION ALL {step.format("rise", "high")}
)
SELECT doc_id, leaf, s.digest AS subroot, h.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = h.digest AS verified
FROM ranked JOIN subroots s USING (g) JOIN (SELECT rn, folded, proof FROM rise WHERE n = 1) r USING (rn) JOIN (SELECT digest FROM high WHERE n = 1) h ON true
"""


MERKLE_MANIFEST = merkle_manifest()


def source_mixing(documents: str = "documents") -> str:
    """Targets by filling up sources in the order of their caps; queues and mix by windows."""
    return rf"""
WITH src AS (
  SELECT row_number() OVER () AS rn, doc_id, source, coalesce(text, '') AS text,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\v\f\r]+'), lambda w: w <> ''))::BIGINT AS size
  FROM {documents}
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight FROM src GROUP BY source
), filled AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER below, 0) AS left_over,
    sum(weight) OVER () - coalesce(sum(weight) OVER below, 0) AS weights
  FROM totals
  WINDOW below AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT left_over / weights AS a FROM filled WHERE weight * (left_over / weights) <= 2.0 * source_size ORDER BY weights DESC LIMIT 1
), targets AS (
  SELECT source, source_size, CASE WHEN weight * a > 2.0 * source_size THEN 2.0::DOUBLE * source_size ELSE weight * a END AS target FROM totals, level
), queued AS (
  SELECT s.*, copy, source_size, target, sha256('7:' || copy || ':' || coalesce(doc_id::VARCHAR, '-') || ':' || sha256(text)) AS place
  FROM src s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source, (VALUES (1), (2)) c(copy)
), timed AS (
  SELECT *, CASE WHEN target > 0 THEN sum(size) OVER (PARTITION BY source ORDER BY copy, place, rn ROWS UNBOUNDED PRECEDING)::DOUBLE / target ELSE 0.0 END AS finish
  FROM queued
), ordered AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, copy, place, rn ROWS UNBOUNDED PRECEDING) AS until, sum(size) OVER () AS everything FROM timed
)
SELECT doc_id, size, source_size, target, (coalesce(sum(size) FILTER (until <= floor(everything / 2 * 1.5)), 0))::BIGINT AS taken
FROM ordered GROUP BY rn, doc_id, size, source_size, target
"""


SOURCE_MIXING = source_mixing()


def source_divergence(documents: str = "documents", min_df: int = 10) -> str:
    """All pairs of sources times all kept terms, in big integers."""
    share = "1 + (1000000000::HUGEINT * ({c} + 2)) // ({n} + 2 * v)"
    return rf"""
WITH src AS (
  SELECT row_number() OVER () AS rn, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS text FROM {documents}
), words AS (
  SELECT rn, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM src
), kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT rn) >= {min_df}),
counts AS (SELECT lang, source, term, count(*) AS c FROM words JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
sources AS (
  SELECT g.lang, g.source, coalesce(n, 0) AS n, coalesce(v, 0) AS v FROM (SELECT DISTINCT lang, source FROM src) g
  LEFT JOIN (SELECT lang, source, sum(c) AS n FROM counts GROUP BY ALL) USING (lang, source) LEFT JOIN sizes USING (lang)
), shares AS (
  SELECT s.lang, s.source, k.term, coalesce(c, 0) AS c, ({share.format(c="coalesce(c, 0)", n="n")})::BIGINT AS p
  FROM sources s JOIN kept k USING (lang) LEFT JOIN counts x ON x.lang = s.lang AND x.source = s.source AND x.term = k.term
), whole AS (
  SELECT lang, term, ({share.format(c="sum(c)", n="any_value(n)")})::BIGINT AS q
  FROM counts JOIN (SELECT lang, sum(n) AS n, any_value(v) AS v FROM sources GROUP BY lang) USING (lang) GROUP BY lang, term, v
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
    coalesce(sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)), 0)::BIGINT AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
  UNION ALL SELECT a.lang, a.source, 'pair', b.source, 0 FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source WHERE a.v = 0
), typical AS (
  SELECT s.lang, s.source, 'term' AS part, s.term AS item, ((p - q) * (p - q)) // (p + q) AS value
  FROM shares s JOIN whole w ON s.lang = w.lang AND s.term = w.term WHERE c > 0 AND p > q
)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM typical) QUALIFY part = 'pair' OR rank <= 10
"""


SOURCE_DIVERGENCE = source_divergence()
