"""DuckDB SQL of the queries on repeated lines, secrets, conversations and centroids."""

from __future__ import annotations

import re

from boreal.llm import secret_links as links

#: Unsigned crc32 of the decimal ``c``: a bitwise loop over its bytes (reflected polynomial 0xEDB88320).
CRC32 = """xor(list_reduce([4294967295] || flatten([[ascii(ch)] || [-1, -1, -1, -1, -1, -1, -1, -1] FOR ch IN string_split(c::VARCHAR, '')]),
    lambda crc, step: CASE WHEN step >= 0 THEN xor(crc, step) WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END), 4294967295)"""

OP5_SQL = r"""
WITH texts AS (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST) AS id, doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
lines AS (SELECT id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM texts WHERE text IS NOT NULL),
pairs AS (
  SELECT id, pos, row_number() OVER (PARTITION BY trim(a), trim(b) ORDER BY id, pos) AS place
  FROM (SELECT id, pos, line AS a, lead(line) OVER (PARTITION BY id ORDER BY pos) AS b FROM lines)
  WHERE b IS NOT NULL AND (regexp_matches(a, '\w') OR regexp_matches(b, '\w'))),
gone AS (SELECT id, pos FROM pairs WHERE place > 1 UNION SELECT id, pos + 1 FROM pairs WHERE place > 1),
cleaned AS (
  SELECT l.id, coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (g.id IS NULL), '') AS text, count(g.id) AS n_deleted
  FROM lines l LEFT JOIN gone g ON g.id = l.id AND g.pos = l.pos GROUP BY l.id)
SELECT t.doc_id, coalesce(len(t.lines), 0)::BIGINT AS n_lines, coalesce(c.n_deleted, 0) AS n_deleted, length(c.text) AS n_chars,
  sha256(c.text) AS text_sha256
FROM texts t LEFT JOIN cleaned c ON c.id = t.id
"""

OP12_SQL = rf"""
WITH keyed AS (
  SELECT conv_id AS c, turn, coalesce(text, '') AS text,
    substr(sha256(concat_ws(':', length(coalesce(role, '')), coalesce(role, ''), coalesce(text, ''))), 1, 32) AS key
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT c, key, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
    row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, key) AS pos FROM keyed),
convs AS (SELECT c, {CRC32} % 4 AS h, c - c % 20 AS host FROM (SELECT DISTINCT c FROM turns)),
rebuilt AS (
  SELECT v.c, t.pos, t.key, t.words FROM convs v JOIN turns t ON t.c = v.host AND t.pos <= v.h
  UNION ALL SELECT v.c, t.pos + 3, t.key, t.words FROM convs v JOIN turns t ON t.c = v.c AND t.pos > v.h),
lists AS (
  SELECT v.c, coalesce(list(r.key ORDER BY r.pos) FILTER (r.pos IS NOT NULL), []) AS keys,
    coalesce(list(r.words ORDER BY r.pos) FILTER (r.pos IS NOT NULL), []) AS words
  FROM convs v LEFT JOIN rebuilt r ON v.c = r.c GROUP BY v.c),
paths AS (
  SELECT c, d, len(keys) AS n, array_to_string(keys[:d], ',') AS node,
    CASE WHEN d > 0 THEN array_to_string(keys[:d - 1], ',') END AS parent,
    CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words
  FROM (SELECT c, keys, words, unnest(range(0, len(keys) + 1)) AS d FROM lists)),
nodes AS (
  SELECT node, any_value(parent) AS parent, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256
  FROM paths GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
subtree AS (
  SELECT p.node, sum((u.n_convs - 1) * u.words)::BIGINT AS saved_tokens, count(*) FILTER (k.node IS NULL) AS n_leaves
  FROM nodes u JOIN paths p ON p.c = u.conv_id AND p.d <= u.depth LEFT JOIN kids k ON k.node = u.node GROUP BY p.node)
SELECT n.conv_id, n.depth, m.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves,
  s.saved_tokens, n.ends_sha256
FROM nodes n JOIN subtree s ON s.node = n.node LEFT JOIN kids k ON k.node = n.node LEFT JOIN nodes m ON m.node = n.parent
"""


def _centroids_sql(k: int = 16, dims: int = 64, scale: int = 64, rounds: int = 3) -> str:
    """Rounds of assignment (a) and means (c) as a chain of tables; ``id`` numbers the kept rows."""
    out = f"""
WITH kept AS (
  SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {dims} AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
vectors AS MATERIALIZED (SELECT * FROM kept),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR) NULLS LAST, v) - 1)::INTEGER AS cluster, v AS c FROM vectors
  QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR) NULLS LAST, v) <= {k})"""
    for r in range(rounds + 1):
        out += f""",
a{r} AS MATERIALIZED (
  SELECT id, arg_min(cluster, [distance, cluster]) AS cluster, min(distance) AS distance FROM (
    SELECT id, cluster, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance
    FROM vectors CROSS JOIN c{r}) GROUP BY id)"""
        if r < rounds:
            out += f""",
s{r} AS (
  SELECT cluster, dim, sum(x) AS s, count(*) AS n
  FROM (SELECT cluster, unnest(v) AS x, unnest(range({dims})) AS dim FROM vectors JOIN a{r} USING (id)) GROUP BY cluster, dim),
m{r} AS (SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY dim) AS c FROM s{r} GROUP BY cluster),
c{r + 1} AS MATERIALIZED (SELECT o.cluster, coalesce(m.c, o.c) AS c FROM c{r} o LEFT JOIN m{r} m ON m.cluster = o.cluster)"""
    return out + f"""
SELECT v.vec_id, a.cluster, a.distance, sum(a.distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia,
  sum(a.distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM vectors v JOIN a{rounds} a USING (id) JOIN c{rounds} c ON c.cluster = a.cluster
"""


OP13_SQL = _centroids_sql()


def _either_case(pattern: str) -> str:
    """Letters outside classes in either case, within ASCII (the ``(?i)`` of a pattern would also fold other letters)."""
    return "".join(p if p.startswith("[") or p.startswith("\\") else re.sub(
        "[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", p) for p in re.split(r"(\[[^]]*\]|\\x[0-9A-F]{2}|\\.)", pattern))


def _matches(kind: int, group: int) -> str:
    """(id, start, end, value) of all matches: the pieces between matches and the matches add up to places."""
    pattern = links.PATTERNS[kind]
    pattern = (_either_case(pattern) if kind in links.EITHER_CASE else pattern).replace("'", "''")
    return f"""(
  SELECT id, {kind} AS kind, at_end - length(m) AS start, at_end AS end, value FROM (
    SELECT id, m, value, sum(length(piece) + length(m)) OVER (PARTITION BY id ORDER BY n) AS at_end FROM (
      SELECT id, unnest(regexp_extract_all(text, '{pattern}')) AS m, unnest(regexp_extract_all(text, '{pattern}', {group})) AS value,
        unnest(string_split_regex(text, '{pattern}')) AS piece, unnest(range(len(string_split_regex(text, '{pattern}')))) AS n
      FROM texts) WHERE m IS NOT NULL))"""


def _overlaps(*tables: str) -> str:
    return " AND ".join(
        f"NOT EXISTS (SELECT 1 FROM {t} o WHERE o.id = x.id AND o.start < x.end AND x.start < o.end)" for t in tables)


def _secrets_sql(reach: int = 200) -> str:
    ranks = "[" + ", ".join(f"'{k}'" for k in links.KINDS) + "]"
    identifiers, secrets = f"({links.ACCESS}, {links.IDENTIFIER})", f"({links.ASSIGN}, {links.SECRET})"
    mixed = " AND ".join(f"regexp_matches(value, '{p}')" for p in links.MIXED)

    def near(kinds: str) -> str:
        return f"""EXISTS (SELECT 1 FROM parts o WHERE o.id = x.id AND o.scope = x.scope AND o.kind IN {kinds}
    AND (o.start, o.kind) <> (x.start, x.kind) AND o.start - x.end <= {reach} AND x.start - o.end <= {reach})"""

    return f"""
WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
assigned AS MATERIALIZED {_matches(links.ASSIGN, 2)},
base AS MATERIALIZED (
  SELECT id, kind, start, "end" FROM assigned WHERE length(value) >= {links.LEAST_VALUE}
  UNION ALL SELECT id, kind, start, "end" FROM {_matches(links.ACCESS, 0)} WHERE length(value) >= {links.LEAST_ACCESS}
  UNION ALL SELECT id, kind, start, "end" FROM {_matches(links.HEX, 0)} WHERE length(value) >= {links.LEAST_HEX}),
short AS (
  SELECT id, {links.SECRET} AS kind, start, "end" FROM assigned WHERE length(value) BETWEEN {links.LEAST_WEAK} AND {links.LEAST_VALUE - 1}),
names AS MATERIALIZED (
  SELECT id, kind, start, "end" FROM {_matches(links.IDENTIFIER, 2)} x WHERE length(value) >= {links.LEAST_NAME} AND {_overlaps('base')}),
places AS MATERIALIZED (SELECT id, kind, start, "end" FROM {_matches(links.ENDPOINT, 0)}),
runs AS MATERIALIZED (SELECT id, kind, start, "end" FROM {_matches(links.SECRET, 0)} WHERE length(value) >= {links.LEAST_RUN} AND {mixed}),
found AS (
  SELECT * FROM base WHERE kind <> {links.HEX} UNION ALL SELECT * FROM names UNION ALL SELECT * FROM places
  UNION ALL SELECT * FROM short x WHERE {_overlaps('base')}
  UNION ALL SELECT * FROM runs x WHERE {_overlaps('base', 'short', 'names', 'places')}),
parts AS MATERIALIZED (
  SELECT f.*, len(string_split_regex(left(t.text, f.start::BIGINT), '{links.BLANK}'))
    - CASE WHEN regexp_matches(left(t.text, f.start::BIGINT + 1), '{links.BLANK}$') THEN 1 ELSE 0 END AS scope
  FROM found f JOIN texts t USING (id)),
linked AS (
  SELECT id, kind, start, "end" FROM parts x
  WHERE kind = {links.IDENTIFIER} AND {near(secrets)} OR kind = {links.SECRET} AND {near(identifiers)}
    OR kind = {links.ENDPOINT} AND {near(secrets)} AND {near(identifiers)}),
spans AS (
  SELECT id, kind, start, {ranks}[kind + 1] || ':' || start || ':' || "end" AS span
  FROM (SELECT * FROM base UNION ALL SELECT * FROM linked))
SELECT t.doc_id, count(*) FILTER (kind = {links.ASSIGN}) AS n_assign, count(*) FILTER (kind = {links.ACCESS}) AS n_access,
  count(*) FILTER (kind = {links.HEX}) AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY start, kind) FILTER (kind <= {links.HEX}), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY start, kind), '') AS spans
FROM texts t LEFT JOIN spans s USING (id) GROUP BY t.id, t.doc_id
"""


OP11_SQL = _secrets_sql()
