"""DuckDB SQL of the operators that SQL can express, on the same tables."""

from __future__ import annotations

from . import licenses


def licenses_sql() -> str:
    """The scan stated on word lists: bigrams joined to templates, places
    counted per diagonal, neighbouring diagonals of a notice merged."""
    rows, k = [], 0
    for group, exact in ((licenses.PHRASES, "true"), (licenses.NOTICES, "false")):
        for text, label in group:
            w = text.split()
            rows += [f"({k}, {p}, '{a}', '{b}', {len(w) - 1}, {exact}, '{label}')"
                     for p, (a, b) in enumerate(zip(w, w[1:], strict=False))]
            k += 1
    return r"""
WITH template(id, place, a, b, places, exact, label) AS (VALUES """ + ", ".join(rows) + r"""),
doc AS (
  SELECT doc_id, list_filter(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM documents
),
gram AS (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM doc),
vote AS (
  SELECT doc_id, id, i - 1 AS pos, i - 1 - place AS diagonal, place, places, exact, label
  FROM gram JOIN template ON w[i] = a AND w[i + 1] = b
),
drawn AS (
  SELECT *, sum(apart) OVER (PARTITION BY doc_id, id ORDER BY diagonal) AS span
  FROM (SELECT *, CASE WHEN exact AND diagonal = lag(diagonal) OVER v THEN 0
                       WHEN NOT exact AND diagonal - lag(diagonal) OVER v <= """ + str(licenses.DRIFT) + r""" THEN 0
                       ELSE 1 END AS apart
        FROM vote WINDOW v AS (PARTITION BY doc_id, id ORDER BY diagonal, pos))
),
found AS (
  SELECT doc_id, id, span, any_value(exact) AS exact, any_value(label) AS label, min(pos) AS start,
         count(DISTINCT place) / any_value(places) AS share,
         CASE WHEN any_value(exact) THEN count(DISTINCT place) = any_value(places)
              ELSE count(DISTINCT place) / any_value(places) >= """ + str(licenses.COVER) + r"""
                   AND max(pos) + 1 - min(pos) <= any_value(places) + 1 + """ + str(2 * licenses.DRIFT) + r""" END AS ok
  FROM drawn GROUP BY doc_id, id, span
)
SELECT doc_id, any_value(len(w)) AS n_words, count(*) FILTER (WHERE ok AND exact) AS n_base,
       min(start) FILTER (WHERE ok AND exact) AS first_word, max(start) FILTER (WHERE ok AND exact) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE ok AND exact), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE ok), '') AS labels,
       coalesce(max(CASE WHEN exact AND NOT ok THEN 0.0 ELSE least(coalesce(share, 0.0), 1.0) END), 0.0)::DOUBLE AS score
FROM doc LEFT JOIN found USING (doc_id)
GROUP BY doc_id"""


EMBEDDINGS = """
WITH RECURSIVE link AS (
  SELECT a.vec_id AS v, b.vec_id AS u
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.9
),
reach(v, u) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.v, l.u FROM reach r JOIN link l ON l.v = r.u
)
SELECT e.vec_id, (SELECT count(*) FROM link l WHERE l.v = e.vec_id) AS n_links, c.component_id,
       e.vec_id = c.component_id AS kept
FROM embeddings e JOIN (SELECT v, min(u) AS component_id FROM reach GROUP BY v) c ON c.v = e.vec_id"""


def _ascii_words(table: str, name: str, id_col: str) -> str:
    return rf"""{name} AS (
  SELECT {id_col}, list_filter(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM {table}
)"""


#: Windows of items joined to windows of documents; every word of a hit once.
DECONTAMINATION = "WITH " + _ascii_words("documents", "doc", "doc_id") + ", " + _ascii_words(
    "benchmark", "item", "item_id") + """,
phrase AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i
        FROM (SELECT *, least(10, len(w)) AS size FROM item WHERE len(w) > 0))
),
place AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM doc, (SELECT DISTINCT size FROM phrase))
),
hit AS (SELECT doc_id, i, size, item_id FROM place JOIN phrase USING (size, phrase)),
covered AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) FROM hit) GROUP BY doc_id
),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""


#: Anchors scored against all rows.
HARD_NEGATIVES = """
WITH row AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_inner_product(a.x, b.x)::BIGINT AS score
  FROM row a JOIN row b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0
),
positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score
  FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id))::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""
