"""Portable SQL that states the results of those queries here that SQL can express, over the same tables."""

from __future__ import annotations

from requestlens.llm.jaccard import PERCENT, SHINGLE
from requestlens.llm.substrings import WINDOW

_SPLIT = r"'[\x20\x09-\x0D]+'"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, {_SPLIT}), lambda x: x <> '')"


REPEATS = f"""
WITH d AS (SELECT doc_id, {_words("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT doc_id, i, list_slice(w, i, i + {WINDOW - 1}) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d)),
firsts AS (SELECT k, min(doc_id) AS least FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM win JOIN firsts USING (k) WHERE doc_id > least),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.p) FILTER (WHERE g.p IS NULL) AS text, count(g.p) AS n_removed
  FROM each e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.p = e.p GROUP BY e.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

LINKS = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [w]
    ELSE list_distinct(list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: list_slice(w, i, i + {SHINGLE - 1}))) END AS s FROM d),
each AS (SELECT doc_id, unnest(s) AS k FROM sets),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles FROM sets),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_have FROM each x JOIN each y ON y.k = x.k AND y.doc_id <> x.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * both_have >= {PERCENT} * (p.n_shingles + q.n_shingles - both_have)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT s.doc_id, s.n_shingles, c.component_id, coalesce(n.n_links, 0) AS n_links
FROM sizes s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = s.doc_id
LEFT JOIN (SELECT a, count(*) AS n_links FROM links GROUP BY a) n ON n.a = s.doc_id"""


# Patterns of the contract, in its order, then those of the weak parts.
_ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ACCESS_NAME = (
    "[Aa][Cc][Cc][Ee][Ss][Ss]_?[Kk][Ee][Yy]_?[Ii][Dd]|[Cc][Ll][Ii][Ee][Nn][Tt]_?[Ii][Dd]|[Uu][Ss][Ee][Rr]_?[Nn][Aa][Mm][Ee]|[Uu][Ss][Ee][Rr]_?[Ii][Dd]|[Ll][Oo][Gg][Ii][Nn]"
)
_PARTS = [
    ("assign", _ASSIGN, "length(regexp_extract(m, '^' || pattern, 1)) >= 6"),
    ("access", "AKIA[A-Z0-9]+", "length(m) >= 20"),
    ("hex", "[0-9a-f]+", "length(m) >= 24"),
    ("weak_access", rf"""(?:{_ACCESS_NAME})["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@=-]{{3,}}""", "true"),
    ("weak_secret", "[A-Za-z0-9+/=]{40,}", "length(m) = 40"),
    ("endpoint", r"""(?:https?|ftp|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|redis|mongodb|amqp)://[^\x20\x09-\x0D"'<>]+""", "true"),
]


def _found(number: int, pattern: str, keep: str) -> str:
    """Matches of one kind with the lengths of the pieces before them."""
    literal = "'" + pattern.replace("'", "''") + "'"
    return f"""
  SELECT doc_id, kind, start, start + length(m) AS "end" FROM (
    SELECT doc_id, {number} AS kind, m, sum(length(gap)) OVER o + sum(length(m)) OVER o - length(m) AS start FROM (
      SELECT doc_id, unnest(ms) AS m, unnest(list_slice(regexp_split_to_array(text, {literal}), 1, len(ms))) AS gap, unnest(range(len(ms))) AS i
      FROM (SELECT doc_id, text, regexp_extract_all(text, {literal}) AS ms FROM t))
    WINDOW o AS (PARTITION BY doc_id ORDER BY i))
  WHERE {keep.replace("'^' || pattern", "'^" + literal[1:])}"""


def _beside(kinds: str) -> str:
    """A part of these kinds starts at most 400 code points before or after p."""
    return f"EXISTS (SELECT 1 FROM parts q WHERE q.doc_id IS NOT DISTINCT FROM p.doc_id AND q.kind IN ({kinds}) AND q.start BETWEEN p.start - 400 AND p.start + 400)"


_ACCESS_BESIDE, _SECRET_BESIDE = _beside("1, 3"), _beside("0, 2, 4")
_NAMES = "[" + ", ".join(f"'{kind}'" for kind, _, _ in _PARTS) + "]"
_LISTED = f"string_agg({_NAMES}[kind + 1] || ':' || CAST(start AS BIGINT) || ':' || CAST(\"end\" AS BIGINT), ',' ORDER BY start, kind)"
SECRETS = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join(_found(number, pattern, keep) for number, (_, pattern, keep) in enumerate(_PARTS))}),
parts AS (
  SELECT doc_id, kind, start, "end" FROM (SELECT *, max(CASE WHEN kind < 3 THEN "end" END) OVER (PARTITION BY doc_id ORDER BY start, kind) AS covered FROM found)
  WHERE kind < 3 OR covered IS NULL OR covered < "end"),
spans AS (
  SELECT doc_id, kind, start, "end" FROM parts p
  WHERE kind < 3 OR (kind = 3 AND {_SECRET_BESIDE}) OR (kind = 4 AND {_ACCESS_BESIDE}) OR (kind = 5 AND {_ACCESS_BESIDE} AND {_SECRET_BESIDE}))
SELECT t.doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
  sha256(coalesce({_LISTED} FILTER (WHERE kind < 3), '')) AS base_sha256, coalesce({_LISTED}, '') AS spans, count(*) FILTER (WHERE kind >= 3) AS n_weak
FROM t LEFT JOIN spans USING (doc_id) GROUP BY t.doc_id"""


def _codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    nearest = """a{n} AS MATERIALIZED (
  SELECT vec, p, min([CAST(list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), e]) AS best
  FROM points JOIN c{n} USING (p) GROUP BY vec, p
)"""
    moved = """c{next} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(m.y, c.y) AS y FROM c{n} c LEFT JOIN (
    SELECT p, e, list(v ORDER BY i) AS y FROM (
      SELECT p, e, i, CAST((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS v FROM (
        SELECT p, best[2] AS e, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM a{n} JOIN points USING (vec, p)
      ) GROUP BY p, e, i
    ) GROUP BY p, e
  ) m ON m.p = c.p AND m.e = c.e
)"""
    steps = ",\n".join(nearest.format(n=n) + ",\n" + moved.format(n=n, next=n + 1) for n in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS vec, vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
points AS MATERIALIZED (
  SELECT vec, vec_id, CAST(p AS BIGINT) AS p, x[p * len(x) // {parts} + 1: (p + 1) * len(x) // {parts}] AS x FROM kept, range({parts}) AS r(p)
),
c0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, min(x) AS y
  FROM points WHERE vec_id IN (SELECT DISTINCT vec_id FROM kept WHERE vec_id IS NOT NULL ORDER BY vec_id LIMIT {entries}) GROUP BY p, vec_id
),
{steps},
{nearest.format(n=rounds)},
coded AS (
  SELECT vec, string_agg(lpad(lower(to_hex(best[2])), 2, '0'), '' ORDER BY p) AS code, CAST(sum(best[1]) AS BIGINT) AS error FROM a{rounds} GROUP BY vec
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) FROM c{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (vec)"""


CODES = _codes()

NEAREST = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (
    SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.x, c.x) AS score FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
  )
) WHERE rank <= 5"""
