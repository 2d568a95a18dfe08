"""DuckDB SQL of the training-data queries that SQL can express at test size.

Written from the contracts: every 50-word window is spelled out, shingle sets
are joined on every shared shingle.  The same for every 50-byte string runs
out of memory on whole tables, and the other queries rest on seeded hashes,
fitted models or a tokenizer; ``tests/llm`` checks those against plain Python.
"""

from kpiloom.llm.oracle_more import MANIFEST, REPAIR

WORD = r"'[^\x20\x09-\x0D]+'"

WINDOWS = f"""WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORD}) AS ws FROM documents),
  places AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS word FROM docs),
  windows AS (SELECT doc_id, p, array_to_string(ws[p:p + 49], ' ') AS s
              FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM docs WHERE len(ws) >= 50)),
  firsts AS (SELECT s, min(doc_id) AS d FROM windows GROUP BY s),
  repeated AS (SELECT doc_id, p FROM windows JOIN firsts USING (s) WHERE doc_id > d),
  covered AS (SELECT a.doc_id, a.p, a.word,
                     max(r.p) OVER (PARTITION BY a.doc_id ORDER BY a.p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
              FROM places a LEFT JOIN repeated r ON r.doc_id = a.doc_id AND r.p = a.p)
SELECT d.doc_id, count(c.p) AS n_words, count(*) FILTER (WHERE c.gone) AS n_removed,
       sha256(coalesce(string_agg(c.word, ' ' ORDER BY c.p) FILTER (WHERE NOT c.gone), '')) AS kept_sha256
FROM docs d LEFT JOIN covered c ON c.doc_id = d.doc_id GROUP BY d.doc_id"""

NEAR = f"""WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), {WORD}) AS ws FROM documents),
  shingles AS (SELECT DISTINCT doc_id, array_to_string(ws[p:p + 3], ' ') AS s
               FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS p FROM docs WHERE len(ws) > 0)),
  sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
  shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
             GROUP BY a.doc_id, b.doc_id),
  links AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
            WHERE 100 * c >= 80 * (p.n + q.n - c)),
  reach AS (SELECT doc_id, doc_id AS other FROM docs UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.other) AS component_id, min(r.other) = d.doc_id AS kept
FROM docs d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach r ON r.doc_id = d.doc_id GROUP BY d.doc_id"""

ORACLE_SQL = {
    "op5_substring_dedup": WINDOWS,
    "op8_minhash_near_dedup": NEAR,
    "op11_role_repair": REPAIR,
    "op13_merkle_manifest": MANIFEST,
}
