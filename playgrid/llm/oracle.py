"""DuckDB SQL of those operators whose whole result SQL can express (test oracles only)."""

from __future__ import annotations

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NGRAM_JOIN = f"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT r, array_to_string(w[k:k + 4], ' ') AS s
  FROM (SELECT r, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS k FROM texts WHERE len(w) > 0)
), sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (
  SELECT x.r AS a, y.r AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.r <> y.r GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes p ON p.r = a JOIN sizes q ON q.r = b WHERE 100 * c >= 75 * (p.n + q.n - c)
), reached(r, other) AS (
  SELECT r, r FROM texts UNION SELECT reached.r, links.b FROM reached JOIN links ON links.a = reached.other
), least AS (
  SELECT reached.r, min(t.doc_id) AS component_id FROM reached JOIN texts t ON t.r = other GROUP BY reached.r
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM texts JOIN least USING (r) LEFT JOIN sizes USING (r)
"""

_ITEM_WORDS = f"regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATE = f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, {_ITEM_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[k:k + least(13, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS k FROM items WHERE len(w) > 0)
), places AS (
  SELECT r, k, n, array_to_string(w[k:k + n - 1], ' ') AS s
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS k
        FROM texts JOIN (SELECT DISTINCT n FROM windows) ON len(w) >= n)
), hits AS (SELECT r, k, n, item_id FROM places JOIN windows USING (n, s)),
words AS (SELECT r, count(DISTINCT p) AS hit FROM (SELECT r, unnest(generate_series(k, k + n - 1)) AS p FROM hits) GROUP BY r),
found AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hits) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit, 0) > 0 AND 20 * coalesce(hit, 0) >= len(w) AS contaminated
FROM texts LEFT JOIN words USING (r) LEFT JOIN found USING (r)
"""


#: Bytes as hexadecimal digits, two each; texts are read in pieces, so that a place is found without the whole text.
SUFFIX_DEDUP = """
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
pieces AS (
  SELECT r, p, substring(x, 2000 * p + 1, 2398) AS x
  FROM (SELECT r, x, unnest(generate_series(0, (len(x) - 1) // 2000)) AS p FROM texts WHERE len(x) >= 400)
), starts AS (
  SELECT r, 1000 * p + k AS place, md5(substring(x, 2 * k + 1, 400)) AS h
  FROM (SELECT r, p, x, unnest(generate_series(0, len(x) // 2 - 200)) AS k FROM pieces WHERE len(x) >= 400)
), marked AS (
  SELECT r, place, place - lag(place) OVER (PARTITION BY r ORDER BY place) AS gap
  FROM starts SEMI JOIN (SELECT h FROM starts GROUP BY h HAVING count(*) > 1) USING (h)
), runs AS (
  SELECT r, min(place) AS since, max(place) + 200 AS upto
  FROM (SELECT r, place, count(*) FILTER (coalesce(gap, 201) > 200) OVER (PARTITION BY r ORDER BY place) AS run FROM marked)
  GROUP BY r, run
), between_runs AS (
  SELECT r, coalesce(lag(upto) OVER (PARTITION BY r ORDER BY since), 0) AS since, since AS upto FROM runs
  UNION ALL SELECT r, max(upto), max(len(x) // 2) FROM runs JOIN texts USING (r) GROUP BY r
), kept AS (
  SELECT r, string_agg(substring(x, 2 * since + 1, 2 * (upto - since)), '' ORDER BY upto) AS kept
  FROM between_runs JOIN texts USING (r) GROUP BY r
), removed AS (SELECT r, sum(upto - since)::BIGINT AS n_removed, count(*) AS n_spans FROM runs GROUP BY r)
SELECT doc_id, len(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM texts LEFT JOIN kept USING (r) LEFT JOIN removed USING (r)
"""


def _leaf(text: str) -> str:
    fields = [f"coalesce(octet_length(encode({v}))::VARCHAR || ':' || {v}, '-')"
              for v in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)]
    return f"sha256({' || '.join(fields)})"


def _tree(name: str, leaves: str, levels: int) -> list[str]:
    """Steps name_0 .. name_levels: a tree's nodes by level (g, i, h), with what stands left and right of each in its run."""
    out = []
    for k in range(levels + 1):
        nodes = leaves if not k else (
            f"SELECT g, i // 16 AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h "
            f"FROM {name}_{k - 1} GROUP BY g, i // 16")
        side = "OVER (PARTITION BY g, i // 16 ORDER BY i ROWS BETWEEN"
        out.append(f"{name}_{k} AS (SELECT g, i, h, count(*) OVER (PARTITION BY g) AS n, "
                   f"coalesce(string_agg(h, '') {side} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
                   f"coalesce(string_agg(h, '') {side} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM ({nodes}))")
    return out


def merkle(levels: int = 6, top_levels: int = 3) -> str:
    """For up to 16^levels rows a source and 16^top_levels sources, distinct doc_ids."""
    bits = "(doc_id::VARCHAR)"
    crc = ("list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split({0}, ''), lambda c: ascii(c)::UBIGINT)), "
           "lambda acc, x: xor(acc >> 8, list_reduce(list_prepend(xor(acc, x) & 255, [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), "
           "lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END)))").format(bits)
    steps = [f"""docs AS (SELECT doc_id, source AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, {_leaf('text')} AS leaf,
      CASE WHEN xor({crc}, 4294967295::UBIGINT) % 5 = 0 THEN {_leaf(_LOWERED.replace("coalesce(text, '')", 'text'))} ELSE {_leaf('text')} END AS shown
      FROM documents)"""]
    steps += _tree("s", "SELECT g, i, leaf AS h FROM docs", levels)
    steps.append(f"sub AS (SELECT g AS source, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS j, h FROM s_{levels})")
    steps += _tree("t", "SELECT 0 AS g, j AS i, h FROM sub", top_levels)
    steps.append("p_0 AS (SELECT doc_id, g, i, leaf, shown AS cur, '' AS proof FROM docs)")
    for k in range(levels):
        steps.append(f"p_{k + 1} AS (SELECT doc_id, p.g, p.i // 16 AS i, leaf, CASE WHEN n > 1 THEN sha256(l || cur || r) ELSE cur END AS cur, "
                     f"proof || l || r AS proof FROM p_{k} p JOIN s_{k} x ON x.g IS NOT DISTINCT FROM p.g AND x.i = p.i)")
    steps.append(f"q_0 AS (SELECT doc_id, leaf, h AS subroot, j AS i, cur, proof FROM p_{levels} p JOIN sub ON sub.source IS NOT DISTINCT FROM p.g)")
    for k in range(top_levels):
        steps.append(f"q_{k + 1} AS (SELECT doc_id, leaf, subroot, q.i // 16 AS i, CASE WHEN n > 1 THEN sha256(l || cur || r) ELSE cur END AS cur, "
                     f"proof || l || r AS proof FROM q_{k} q JOIN t_{k} x ON x.i = q.i)")
    return ("WITH " + ",\n".join(steps) + f"\nSELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, "
            f"cur = h AS verified FROM q_{top_levels} q JOIN t_{top_levels} x ON x.i = q.i")


ORACLE_SQL = {"op4_ngram_join": NGRAM_JOIN, "op7_decontaminate": DECONTAMINATE, "op9_suffix_dedup": SUFFIX_DEDUP,
              "op12_merkle": merkle()}
