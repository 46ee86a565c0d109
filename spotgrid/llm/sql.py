"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from spotgrid.llm import mixing, url_filter

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _mix() -> str:
    weights = ", ".join(str(w) for w in mixing.WEIGHTS)
    return rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS point
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, [{weights}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS weight,
         {mixing.MOST_REPEATS} * source_size AS cap
  FROM totals
), ordered AS (  -- sources that reach their cap come first; what is left is shared by the weights that are left
  SELECT *, {mixing.SHARE_PERCENT} * sum(source_size) OVER () - 100 * coalesce(sum(cap) OVER before, 0) AS words,
         100 * (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS free
  FROM weighed
  WINDOW before AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), judged AS (
  SELECT *, cap::HUGEINT * free <= weight::HUGEINT * words AS is_over FROM ordered
), level AS (
  SELECT {mixing.SHARE_PERCENT} * sum(source_size) - 100 * coalesce(sum(cap) FILTER (is_over), 0) AS words, 100 * coalesce(sum(weight) FILTER (NOT is_over), 0) AS free
  FROM judged
), aims AS (
  SELECT source, source_size,
         CASE WHEN is_over THEN cap::DOUBLE ELSE (l.words::DOUBLE * weight) / l.free::DOUBLE END AS target
  FROM judged, level AS l
), plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM aims
), budgets AS (
  SELECT *, floor(target)::BIGINT - whole * source_size AS budget FROM plan
), placed AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.whole, b.budget,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.point RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.point) AS edge
  FROM sized d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (whole * size + CASE WHEN upto <= budget THEN size WHEN upto - edge < budget THEN (budget - upto + edge) * size // edge ELSE 0 END)::BIGINT AS taken
FROM placed"""


_CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked AS (
  SELECT *, coalesce(role <> lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text), true) AS starts,
         length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) AS role_chars,
         length(regexp_replace(regexp_replace(text, '&((?:amp;)*lt;/?turn)', '&amp;\1', 'g'), '<(/?turn)', '&lt;\1', 'g')) AS text_chars
  FROM rows
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(text_chars + CASE WHEN starts THEN 16 + role_chars ELSE 7 END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id"""


def _urls() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in url_filter.RULES)
    term = lambda t: f"regexp_matches({_LOWER.format('u')}, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')::BIGINT"
    return f"""
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS u, {_LOWER.format("regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)")} AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS rn
  FROM pages
), rules(rule_host, rule_path, rule_verdict) AS (VALUES {rules}
), fitted AS (
  SELECT rn, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY rn
), counted AS (
  SELECT *, {" + ".join(map(term, url_filter.STRICT))} AS strict_terms, {" + ".join(map(term, url_filter.SOFT))} AS soft_terms FROM parts
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN strict_terms > 0 OR soft_terms >= {url_filter.LEAST_SOFT} THEN 'block' ELSE 'allow' END) AS verdict,
       strict_terms, soft_terms
FROM counted LEFT JOIN fitted USING (rn)"""


def _jaccard(k: int, percent: int) -> str:
    run = " || ' ' || ".join(f"w[i + {j}]" for j in range(k))
    return rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
         ELSE [{run} for i in range(1, len(w) - {k - 2})] END)) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * shared >= {percent} * (p.n + q.n - shared)
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT l.y, r.other FROM reached r JOIN links l ON l.x = r.doc_id
)
SELECT r.doc_id, coalesce(max(z.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id, coalesce(max(c.n_links), 0)::BIGINT AS n_links
FROM reached r LEFT JOIN sizes z ON z.doc_id = r.doc_id LEFT JOIN (SELECT x, count(*) AS n_links FROM links GROUP BY 1) c ON c.x = r.doc_id
GROUP BY r.doc_id"""


_TRIE = r"""
WITH slim AS (
  SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS name, length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL
), lists AS (
  SELECT conv_id, list(name ORDER BY turn NULLS FIRST, name) AS names, list(chars ORDER BY turn NULLS FIRST, name) AS chars FROM slim GROUP BY conv_id
), counted AS (  -- crc32 of the decimal id, bit by bit
  SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, _: xor(x >> 1, 3988292384 * (x & 1))))) % 6 AS h
  FROM lists
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.names, [])[1:c.h], c.names[c.h + 1:]) AS names, list_concat(coalesce(b.chars, [])[1:c.h], c.chars[c.h + 1:]) AS chars
  FROM counted c LEFT JOIN lists b ON b.conv_id = c.conv_id - c.conv_id % 100
), paths AS (
  SELECT conv_id, d AS depth, array_to_string(names[1:d], ',') AS node, array_to_string(names[1:d - 1], ',') AS above, coalesce(chars[d], 0) AS chars, d = len(names) AS ends
  FROM (SELECT *, unnest(range(len(names) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT depth, node, min(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars, bool_and(ends) AS is_leaf,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM paths GROUP BY depth, node
), below AS (  -- a node lies in the subtrees of all prefixes of its smallest member
  SELECT p.depth, p.node, count(*) FILTER (WHERE b.is_leaf) AS n_leaves, sum((b.n_convs - 1) * b.chars) AS saved_tokens
  FROM nodes b JOIN paths p ON p.conv_id = b.conv_id AND p.depth <= b.depth GROUP BY p.depth, p.node
), children AS (
  SELECT depth - 1 AS depth, above AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY depth, above
)
SELECT n.conv_id::BIGINT AS conv_id, n.depth::BIGINT AS depth, up.conv_id::BIGINT AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(k.n_children, 0)::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b USING (depth, node) LEFT JOIN children k USING (depth, node)
LEFT JOIN nodes up ON up.depth = n.depth - 1 AND up.node = n.above"""


_NEGATIVES = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, id, score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id, (row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id))::INTEGER AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10"""


def oracle_sql() -> dict[str, str]:
    return {"op2_mix_sources": _mix(), "op6_chat_format": _CHAT, "op7_jaccard_join": _jaccard(3, 90), "op10_url_filter": _urls(), "op11_prefix_trie": _TRIE,
            "op12_hard_negatives": _NEGATIVES}
