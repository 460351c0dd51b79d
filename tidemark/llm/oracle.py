"""SQL that gives the same rows as a query, where SQL can express it."""

from __future__ import annotations

from tidemark.llm.licenses import TEMPLATES

FILL_IN_MIDDLE = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), drawn AS (
  SELECT *, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS a,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 50 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM units
), parts AS (
  SELECT doc_id, n, form, t, array_to_string(u[1:least(a, b)], '') AS prefix,
         array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS middle,
         array_to_string(u[greatest(a, b) + 1:], '') AS suffix
  FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

_VALUES = ", ".join(
    "({}, '{}', '{}')".format(i, label, text.replace("'", "''")) for i, (label, text) in enumerate(TEMPLATES)
)

# Every block against every template that shares a token with it.
LICENSE_SCAN = (
    r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), words AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM docs
), places AS (
  SELECT *, list_filter(range(1, len(w) + 1), lambda i: w[i] = 'cc' AND w[i + 1] = 'by') AS a,
         list_filter(range(1, len(w) + 1),
                     lambda i: w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license') AS b,
         list_filter(range(1, len(w) + 1),
                     lambda i: w[i] = 'all' AND w[i + 1] = 'rights' AND w[i + 2] = 'reserved') AS c
  FROM words
), template AS (
  SELECT k, label, regexp_extract_all(lower(x), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (VALUES """
    + _VALUES
    + r""") AS given(k, label, x)
), wanted AS (
  SELECT k, label, unnest(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS token
  FROM template
), sizes AS (
  SELECT k, count(*) AS size FROM wanted GROUP BY k
), cut AS (
  SELECT r, unnest(regexp_split_to_array(t, '\n[\x00-\x2F\x3A-\x60\x7B-\x7F]*\n')) AS x FROM docs
), blocks AS (
  SELECT row_number() OVER () AS n, r, regexp_extract_all(x, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM cut
), held AS (
  SELECT n, r, unnest(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS token
  FROM blocks
), shared AS (
  SELECT held.n, held.r, k, label, count(*) AS shared
  FROM held JOIN wanted USING (token) GROUP BY held.n, held.r, k, label
), best AS (
  SELECT r, list(DISTINCT label) AS labels, max(shared / CAST(size AS DOUBLE)) AS containment
  FROM shared JOIN sizes USING (k) WHERE 5 * shared >= 4 * size GROUP BY r
), base AS (
  SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_words, list_concat(list_concat(a, b), c) AS spots,
         list_concat(list_concat(CASE WHEN len(a) > 0 THEN ['cc-by'] ELSE [] END,
                                 CASE WHEN len(b) > 0 THEN ['gpl'] ELSE [] END),
                     CASE WHEN len(c) > 0 THEN ['reserved'] ELSE [] END) AS labels
  FROM places
)
SELECT doc_id, n_words, CAST(len(spots) AS BIGINT) AS n_base, CAST(list_min(spots) - 1 AS BIGINT) AS first_word,
       CAST(list_max(spots) - 1 AS BIGINT) AS last_word, array_to_string(base.labels, ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(base.labels, coalesce(best.labels, [])))), ',') AS labels,
       CASE WHEN len(spots) > 0 THEN 1.0::DOUBLE ELSE coalesce(containment, 0.0::DOUBLE) END AS score
FROM base LEFT JOIN best USING (r)
"""
)


def statements() -> dict[str, str]:
    """Vocabularies, permutations, MinHash, eigenvectors and learned models are beyond SQL; for
    those brute force is in tests/llm."""
    return {"op11_license_scan": LICENSE_SCAN, "op13_fill_in_middle": FILL_IN_MIDDLE}
