"""DuckDB SQL of the Merkle manifest and of the repair of conversations, by recursion level by level and row by row."""

# CRC-32 bit by bit, of ASCII text
CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({x}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
  lambda c, b: list_reduce(list_prepend(xor(c, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
    lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, CAST(3988292384 AS BIGINT)) ELSE v // 2 END)), CAST(4294967295 AS BIGINT))"""


def field(x: str) -> str:
    return f"coalesce(strlen({x}) || ':' || {x}, '-')"


def leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(field(f"CAST({c} AS VARCHAR)") for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def tree(name: str, lowest: str) -> str:
    """Levels of the trees of ``lowest`` (g, pos, h, n)."""
    return f"""{name} AS MATERIALIZED (SELECT g, 0 AS lvl, pos, h, n FROM {lowest}
    UNION ALL SELECT g, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM {name} WHERE n > 1
    GROUP BY g, lvl, pos // 2, n)"""


def walk(name: str, start: str, nodes: str) -> str:
    """Every row's way to the top of its tree: the hash so far and the siblings met."""
    return f"""{name} AS ({start}
    UNION ALL SELECT w.row, w.g, w.lvl + 1, w.pos // 2, w.leaf,
      sha256(CASE WHEN w.pos % 2 = 0 THEN w.here || coalesce(s.h, '') ELSE s.h || w.here END), w.met || coalesce(s.h, ''), (w.n + 1) // 2
    FROM {name} w LEFT JOIN {nodes} s ON s.g = w.g AND s.lvl = w.lvl AND s.pos = CASE WHEN w.pos % 2 = 0 THEN w.pos + 1 ELSE w.pos - 1 END
    WHERE w.n > 1)"""


MANIFEST = f"""WITH RECURSIVE leaves AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, coalesce('1' || lang, '0') AS g, {leaf('n_chars')} AS h,
    CASE WHEN {CRC.format(x='CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN {leaf('n_chars + 1')} END AS tampered FROM documents),
  low AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaves),
  {tree('nodes', 'low')},
  subroots AS MATERIALIZED (SELECT g AS of, h AS subroot, '' AS g, row_number() OVER (ORDER BY g) - 1 AS pos, h, count(*) OVER () AS n FROM nodes WHERE n = 1),
  {tree('crown', 'subroots')},
  {walk('up', "SELECT row, g, 0 AS lvl, pos, h AS leaf, coalesce(tampered, h) AS here, '' AS met, n FROM low", 'nodes')},
  {walk('top', "SELECT u.row, '' AS g, 0 AS lvl, s.pos, u.leaf, u.here, u.met, s.n FROM up u JOIN subroots s ON s.of = u.g WHERE u.n = 1", 'crown')}
SELECT l.doc_id, l.h AS leaf, s.subroot, r.h AS root, sha256(t.met) AS proof_sha256, t.here AS folded_root, t.here = r.h AS verified
FROM leaves l JOIN subroots s ON s.of = l.g JOIN top t ON t.row = l.row AND t.n = 1, (SELECT h FROM crown WHERE n = 1) r"""

VISIBLE = r"[^\x20\x09-\x0D]"
# phases: 0 nothing yet, 1 system, 2 user, 3 a whole pair; inserted turns before a row, and what a row then does
REPAIR = f"""WITH RECURSIVE told AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {CRC.format(x="coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS harm FROM conversations),
  harmed AS (SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
      CASE WHEN harm = 1 THEN '' WHEN harm = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
      unnest(range(CASE WHEN harm = 3 THEN 2 ELSE 1 END)) AS copy FROM told WHERE harm <> 0),
  placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 64), md5(role || ':' || text), copy) AS i FROM harmed),
  faulted AS (SELECT *, left(role, 1) AS initial, CASE WHEN NOT regexp_matches(text, '{VISIBLE}') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN regexp_extract(text, '({VISIBLE})[\\x20\\x09-\\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
      lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS prior FROM placed),
  counts AS (SELECT conv_id, count(*) AS m, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
      count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
      count(*) FILTER (WHERE fault = 'truncated') AS truncated,
      count(*) FILTER (WHERE prior IS NOT NULL AND prior || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM faulted GROUP BY conv_id),
  inserted(f, k, t, lines) AS (VALUES (0, 0, 0, NULL), (0, 1, 2, 'user:'), (0, 2, 3, 'user:' || chr(10) || 'assistant:'), (1, 0, 1, NULL),
      (1, 1, 2, 'user:'), (1, 2, 3, 'user:' || chr(10) || 'assistant:'), (2, 0, 2, NULL), (2, 1, 3, 'assistant:'), (3, 0, 3, NULL), (3, 1, 2, 'user:')),
  acts(f, act, initial, t, cost, given) AS (VALUES (0, 'D', NULL, 0, 3, NULL), (1, 'D', NULL, 1, 3, NULL), (2, 'D', NULL, 2, 3, NULL),
      (3, 'D', NULL, 3, 3, NULL), (0, 'K', 's', 1, 0, NULL), (0, 'K', 'u', 2, 0, NULL), (1, 'K', 'u', 2, 0, NULL), (3, 'K', 'u', 2, 0, NULL),
      (2, 'K', 'a', 3, 0, NULL), (0, 'R', NULL, 2, 2, 'user'), (1, 'R', NULL, 2, 2, 'user'), (3, 'R', NULL, 2, 2, 'user'), (2, 'R', NULL, 3, 2, 'assistant')),
  ways AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS phase, struct_pack(c := CAST(0 AS BIGINT), a := '', o := CAST(NULL AS VARCHAR)) AS w FROM counts
    UNION ALL
    SELECT conv_id, i, phase, min(w) FROM (
      SELECT d.conv_id, f.i, x.t AS phase, struct_pack(
          c := d.w.c + 2 * n.k + x.cost + CASE WHEN x.act <> 'D' AND f.fault = 'truncated' THEN 1 ELSE 0 END,
          a := d.w.a || repeat('I', n.k) || x.act,
          o := nullif(concat_ws(chr(10), d.w.o, n.lines, CASE WHEN x.act <> 'D' THEN coalesce(x.given, f.role) || ':' || f.text END), '')) AS w
      FROM ways d JOIN faulted f ON f.conv_id IS NOT DISTINCT FROM d.conv_id AND f.i = d.i + 1
      JOIN inserted n ON n.f = d.phase JOIN acts x ON x.f = n.t
        AND (x.act = 'D' OR f.fault NOT IN ('blank', 'duplicate')) AND (x.initial IS NULL OR x.initial = f.initial))
    GROUP BY conv_id, i, phase),
  ends AS (SELECT c.conv_id, min(struct_pack(c := d.w.c + 2 * n.k, a := d.w.a || repeat('I', n.k),
             o := nullif(concat_ws(chr(10), d.w.o, n.lines), ''))) AS w
    FROM ways d JOIN counts c ON c.conv_id IS NOT DISTINCT FROM d.conv_id AND c.m = d.i JOIN inserted n ON n.f = d.phase AND n.t IN (0, 3) GROUP BY c.conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(w.c, 0) AS cost, coalesce(w.a, '') AS audit, sha256(coalesce(w.o, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN ends z ON z.conv_id IS NOT DISTINCT FROM e.conv_id"""
