"""DuckDB SQL of the registered queries that SQL can express.

The others need a tokenizer, a seeded 64-bit hash, a fitted model, byte windows or an approximate search; the
tests hold them against brute force, a library or exact round trips.
"""

from __future__ import annotations

_WORD = {"password": "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]", "passwd": "[Pp][Aa][Ss][Ss][Ww][Dd]", "secret": "[Ss][Ee][Cc][Rr][Ee][Tt]",
         "token": "[Tt][Oo][Kk][Ee][Nn]", "api_key": "[Aa][Pp][Ii]_?[Kk][Ee][Yy]"}
_KINDS = (
    ("assign", "(" + "|".join(_WORD.values()) + r")[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    ("access", "(AKIA[A-Z0-9]+)", 1, 16),
    ("hex", "([0-9a-f]+)", 1, 32),
    ("private_key", "(-----BEGIN [A-Z ]*PRIVATE KEY-----)", 1, 1),
    ("github", "(gh[pousr]_[A-Za-z0-9]{36})", 1, 1),
)


def _kind(k: int, pattern: str, group: int, least: int) -> str:
    return f"""
SELECT doc_id, unnest(list_filter(list_transform(range(1, len(whole) + 1), lambda i: {{
    'start': list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(whole[1:i - 1], lambda g: length(g))), 0),
    'kind': {k}, 'n': length(whole[i]), 'size': length(part[i])}}), lambda s: s.size >= {least})) AS s
FROM (SELECT doc_id, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}', 0) AS whole,
             regexp_extract_all(t, '{pattern}', {group}) AS part FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))"""


_NAMES = "[" + ", ".join(f"'{k[0]}'" for k in _KINDS) + "]"
OP1 = f"""
WITH spans AS ({' UNION ALL '.join(_kind(k, *x[1:]) for k, x in enumerate(_KINDS))}),
lines AS (SELECT doc_id, s.start AS start, s.kind AS kind,
                 concat({_NAMES}[s.kind + 1], ':', CAST(s.start AS BIGINT), ':', CAST(s.start + s.n AS BIGINT)) AS line FROM spans)
SELECT d.doc_id, count(line) FILTER (kind = 0) AS n_assign, count(line) FILTER (kind = 1) AS n_access, count(line) FILTER (kind = 2) AS n_hex,
       sha256(coalesce(string_agg(line, ',' ORDER BY start, kind) FILTER (kind < 3), '')) AS base_sha256,
       coalesce(string_agg(line, ',' ORDER BY start, kind), '') AS spans
FROM documents d LEFT JOIN lines l ON d.doc_id = l.doc_id GROUP BY d.doc_id"""

OP3 = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
          AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT low.a AS vec_id, coalesce(n.n, 0) AS n_links, component_id, low.a = component_id AS kept
FROM low LEFT JOIN n ON n.a = low.a"""


def _level(name: str, above: str, keys: list[str], weight: str) -> str:
    """A level of the tree: capacity per child, then its share of the parent's budget by water level."""
    own, up = ", ".join(keys), ", ".join(keys[:-1])
    part = f"PARTITION BY {up} " if up else ""
    join = f"JOIN {above} USING ({up})" if up else f"CROSS JOIN {above}"
    return f"""
{name}_n AS (SELECT {own}, CAST(sum(leaf_tokens) * 2 AS DOUBLE) AS capacity, {weight} AS weight FROM leaf GROUP BY {own}),
{name}_w AS (SELECT *, (given - (sum(capacity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - capacity))
        / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv
    FROM {name}_n {join} WINDOW w AS ({part}ORDER BY capacity / weight, {keys[-1]})),
{name} AS (SELECT {own}, least(capacity, weight * max(lv) OVER ({part})) AS given FROM {name}_w)"""


OP8 = f"""
WITH slim AS (SELECT doc_id, 'd' || CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) = '' THEN 0
                 ELSE CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS INT) % 4 END AS domain,
        coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens FROM documents),
leaf AS (SELECT domain, lang, source, sum(tokens) AS leaf_tokens FROM slim WHERE tokens > 0 GROUP BY ALL),
top AS (SELECT CAST(sum(leaf_tokens) * 0.75::DOUBLE AS DOUBLE) AS given FROM leaf),
{_level('l1', 'top', ['domain'], "CASE domain WHEN 'd0' THEN 0.4::DOUBLE WHEN 'd1' THEN 0.3 WHEN 'd2' THEN 0.2 WHEN 'd3' THEN 0.1 ELSE 1.0 END")},
{_level('l2', 'l1', ['domain', 'lang'], "CASE lang WHEN 'en' THEN 0.5::DOUBLE WHEN 'de' THEN 0.2 WHEN 'fr' THEN 0.2 WHEN 'es' THEN 0.1 ELSE 1.0 END")},
{_level('l3', 'l2', ['domain', 'lang', 'source'], '1.0::DOUBLE')},
budget AS (SELECT domain, lang, source, CAST(leaf_tokens AS BIGINT) AS leaf_tokens, CAST(floor(given + 1e-6) AS BIGINT) AS budget FROM l3 JOIN leaf USING (domain, lang, source)),
placed AS (SELECT s.*, budget // leaf_tokens AS whole, budget - (budget // leaf_tokens) * leaf_tokens AS rest
           FROM slim s JOIN budget USING (domain, lang, source) WHERE tokens > 0),
summed AS (SELECT *, rest - (sum(tokens) OVER (PARTITION BY domain, lang, source
        ORDER BY md5('7:' || whole || ':' || doc_id), doc_id ROWS UNBOUNDED PRECEDING) - tokens) AS room FROM placed)
SELECT doc_id, domain, lang, source, CAST(e.epoch AS INTEGER) AS epoch, CAST(tokens AS BIGINT) AS tokens,
       CAST(CASE WHEN e.epoch < whole THEN tokens ELSE least(tokens, room) END AS BIGINT) AS taken
FROM summed, unnest(range(0, whole + CASE WHEN room > 0 THEN 1 ELSE 0 END)) AS e(epoch)"""

OP12 = """
WITH r AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor, r.vec_id AS other, a.label = r.label AS same,
         CAST(list_inner_product(a.c, r.c) AS BIGINT) AS score
  FROM r AS a JOIN r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor, other, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5)
SELECT p.anchor AS anchor_id, p.other AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank,
       s.other AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 100 * s.score BETWEEN 30 * p.score AND 90 * p.score
WINDOW w AS (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other)
QUALIFY row_number() OVER w <= 10
"""

SQL: dict[str, str] = {"op1_secret_scan": OP1, "op3_cover_tree": OP3, "op8_mix": OP8, "op12_hard_negatives": OP12}
