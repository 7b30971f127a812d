"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

import re

from carelake.llm.license_scan import CONTAINMENT, NOTICES, WIDTH


def _quoted(text: str) -> str:
    return "'" + " ".join(text.split()).replace("'", "''") + "'"


#: Exact containment of every template in every window of its grid; the best template of each place.
LICENSES = f"""
WITH notices(template_id, text) AS (VALUES {', '.join(f"({_quoted(n)}, {_quoted(t)})" for n, t in NOTICES)}),
texts AS (SELECT doc_id AS id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents WHERE text IS NOT NULL),
placed AS (
  SELECT id, len(w) AS n, p - 1 AS pos, array_to_string(w[p:p + {WIDTH - 1}], ' ') AS shingle
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - {WIDTH - 1}, 1) + 1)) AS p FROM texts WHERE len(w) > 0)),
named AS (SELECT template_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM notices),
of AS (
  SELECT DISTINCT template_id, array_to_string(w[p:p + {WIDTH - 1}], ' ') AS shingle
  FROM (SELECT template_id, w, unnest(range(1, greatest(len(w) - {WIDTH - 1}, 1) + 1)) AS p FROM named)),
sized AS (
  SELECT template_id, m, CASE WHEN m = 1 THEN 1 ELSE CAST(pow(2, ceil(log2(m))) AS BIGINT) // 2 END AS stride,
         CASE WHEN m = 1 THEN 1 ELSE 3 END AS k
  FROM (SELECT template_id, count(*) AS m FROM of GROUP BY 1)),
hits AS (SELECT p.id, p.n, p.pos, p.shingle, s.* FROM placed p JOIN of USING (shingle) JOIN sized s USING (template_id)),
windows AS (
  SELECT id, template_id, m, n, win, count(DISTINCT shingle) AS found, min(pos) AS first, max(pos) AS last
  FROM (SELECT *, pos // stride - unnest(range(0, k)) AS win FROM hits) WHERE win >= 0 GROUP BY ALL),
good AS (SELECT * FROM windows WHERE found >= {CONTAINMENT} * m - 1e-9),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id, template_id ORDER BY found DESC, win) AS r,
                  count(*) OVER (PARTITION BY id, template_id) AS n_windows FROM good),
rows_ AS (
  SELECT id AS doc_id, template_id, CAST(found AS DOUBLE) / m AS containment, found AS n_found, m AS n_shingles, first AS first_word,
         least(last - first + {WIDTH}, n) AS n_words, n_windows
  FROM ranked WHERE r = 1)
SELECT * FROM rows_ r WHERE NOT EXISTS (
  SELECT 1 FROM rows_ q WHERE q.doc_id = r.doc_id
    AND (q.containment > r.containment OR (q.containment = r.containment AND q.n_shingles > r.n_shingles))
    AND q.first_word < r.first_word + r.n_words AND r.first_word < q.first_word + q.n_words)
"""

#: Hashed unigrams of both tables, gains per bucket, scores and places; crc32 byte by byte over distinct words.
IMPORTANCE = r"""
WITH polynomial AS (
  SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY n) AS t FROM (SELECT unnest(range(256)) AS n)),
texts AS (SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
numbered AS (SELECT row_number() OVER () AS r, * FROM texts),
split AS (
  SELECT r, kind, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM numbered),
counted AS (SELECT r, kind, w, count(*) AS n FROM split GROUP BY ALL),
hashed AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295, [('0x' || h[2 * i + 1:2 * i + 2])::BIGINT for i in range(len(h) // 2)]),
                            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM counted)), polynomial),
buckets AS (
  SELECT bucket, sum(CASE WHEN kind = 0 THEN n ELSE 0 END)::DOUBLE AS s, sum(CASE WHEN kind = 1 THEN n ELSE 0 END)::DOUBLE AS t
  FROM counted JOIN hashed USING (w) GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM buckets),
gain AS (
  SELECT bucket, floor(1000.0::DOUBLE * ln(((b.t + 1) * (a.s + 10000)) / ((b.s + 1) * (a.t + 10000))))::BIGINT AS g
  FROM buckets b, totals a),
weighed AS (
  SELECT r, sum(n)::BIGINT AS n_features, sum(n * g)::BIGINT AS weight
  FROM counted JOIN hashed USING (w) JOIN gain USING (bucket) WHERE kind = 0 GROUP BY r),
scored AS (
  SELECT id AS doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000.0::DOUBLE * ln(-ln((('0x' || sha256('2024:' || coalesce(id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE)
                                                              / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM numbered LEFT JOIN weighed USING (r) WHERE kind = 0),
placed AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM scored WHERE n_features >= 20)
SELECT s.doc_id, s.n_features, s.weight, s.score,
       CASE WHEN place <= 10 * (SELECT count(*) FROM placed) // 100 THEN place END AS rank
FROM scored s LEFT JOIN placed USING (doc_id)
"""

#: Integer inner products of every query with every other row.
TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256.0::DOUBLE * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored) WHERE r <= 5
"""

ORACLE: dict[str, str] = {
    "op1_license_scan": re.sub(r"\n\s*", "\n", LICENSES).strip(),
    "op7_topk": TOP_K.strip(),
    "op13_importance": IMPORTANCE.strip(),
}
