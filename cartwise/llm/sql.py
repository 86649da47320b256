"""DuckDB forms of the queries that SQL can express, written from the contracts."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = rf"""
WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
win AS (SELECT doc_id, unnest(generate_series(1, len(ws) - 49)) AS k, ws FROM w WHERE len(ws) >= 50),
keyed AS (SELECT doc_id, k, md5(array_to_string(ws[k:k + 49], ' ')) AS h FROM win),
low AS (SELECT h, min(doc_id) AS d FROM keyed GROUP BY h),
hit AS (SELECT doc_id, k FROM keyed JOIN low USING (h) WHERE d < doc_id),
word AS (SELECT doc_id, unnest(generate_series(1, len(ws))) AS i, unnest(ws) AS x FROM w),
near AS (
  SELECT word.doc_id, i, x, max(hit.k) OVER (PARTITION BY word.doc_id ORDER BY i) AS last_hit
  FROM word LEFT JOIN hit ON hit.doc_id = word.doc_id AND hit.k = word.i),
flag AS (SELECT doc_id, i, x, coalesce(i - last_hit < 50, false) AS gone FROM near),
kept AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed,
         coalesce(string_agg(x, ' ' ORDER BY i) FILTER (WHERE NOT gone), '') AS t
  FROM flag GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

OP5 = f"""
WITH t AS (SELECT doc_id, {LOWERED} AS x FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY x) AS kept, sha256(x) AS text_sha256
FROM t
"""

OP10 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
raw AS (
  SELECT doc_id, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS k, ws FROM w WHERE len(ws) > 0),
gram AS (SELECT DISTINCT doc_id, md5(array_to_string(ws[k:k + 4], ' ')) AS g FROM raw),
size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM gram a JOIN gram b USING (g)
  JOIN size x ON x.doc_id = a.doc_id JOIN size y ON y.doc_id = b.doc_id
  WHERE a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS c FROM w
  UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.c)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(reach.c) AS component_id
FROM w LEFT JOIN size USING (doc_id) JOIN reach ON reach.a = w.doc_id
GROUP BY w.doc_id, n
"""

OP12 = (OP10.replace("100 * count(*) >= 75", "100 * count(*) >= 85")
        .replace("min(reach.c) AS component_id", "min(reach.c) AS component_id, w.doc_id = min(reach.c) AS kept"))

CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
    lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))"""


def _field(x: str) -> str:
    return f"coalesce(strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


SMALL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP13 = f"""
WITH RECURSIVE leaf AS (
  SELECT doc_id, source, {_leaf('text')} AS h,
         CASE WHEN xor({CRC}, 4294967295) % 5 = 0 THEN {_leaf(SMALL)} ELSE {_leaf('text')} END AS seen
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS r,
         count(*) OVER (PARTITION BY source) AS n FROM leaf),
node AS (
  SELECT source AS g, 0 AS lvl, r AS i, h, n FROM placed
  UNION ALL
  SELECT g, lvl + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (n + 15) // 16
  FROM node WHERE n > 1 GROUP BY g, lvl, i // 16, n),
sub AS (
  SELECT g, h, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS r, count(*) OVER () AS n FROM node WHERE n = 1),
high AS (
  SELECT 0 AS lvl, r AS i, h, n FROM sub
  UNION ALL
  SELECT lvl + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (n + 15) // 16
  FROM high WHERE n > 1 GROUP BY lvl, i // 16, n),
run AS (
  SELECT g, 0 AS tree, lvl, i // 16 AS p, list(h ORDER BY i) AS hs FROM node WHERE n > 1 GROUP BY g, lvl, i // 16
  UNION ALL
  SELECT NULL, 1, lvl, i // 16, list(h ORDER BY i) FROM high WHERE n > 1 GROUP BY lvl, i // 16),
depth AS (SELECT range AS lvl, 1::BIGINT << CAST(4 * range AS INT) AS w FROM range(15)),
step AS (
  SELECT p.source, p.doc_id, p.r, run.tree, run.lvl, run.hs, (p.r // d.w) % 16 AS k
  FROM placed p CROSS JOIN depth d JOIN run
    ON run.tree = 0 AND run.g IS NOT DISTINCT FROM p.source AND run.lvl = d.lvl AND run.p = p.r // (d.w * 16)
  UNION ALL
  SELECT p.source, p.doc_id, p.r, run.tree, run.lvl, run.hs, (sub.r // d.w) % 16
  FROM placed p JOIN sub ON sub.g IS NOT DISTINCT FROM p.source CROSS JOIN depth d JOIN run
    ON run.tree = 1 AND run.lvl = d.lvl AND run.p = sub.r // (d.w * 16)),
path AS (
  SELECT source, doc_id, r,
         list({{'l': coalesce(array_to_string(hs[1:k], ''), ''), 'r': coalesce(array_to_string(hs[k + 2:], ''), '')}}
              ORDER BY tree, lvl) AS steps
  FROM step GROUP BY source, doc_id, r),
done AS (
  SELECT p.doc_id, p.h AS leaf, sub.h AS subroot, (SELECT h FROM high WHERE n = 1) AS root,
         sha256(coalesce(array_to_string(list_transform(steps, lambda x: x.l || x.r), ''), '')) AS proof_sha256,
         list_reduce(list_prepend({{'l': '', 'r': p.seen}}, coalesce(steps, [])),
                     lambda a, x: {{'l': '', 'r': sha256(x.l || a.r || x.r)}}).r AS folded_root
  FROM placed p JOIN sub ON sub.g IS NOT DISTINCT FROM p.source
  LEFT JOIN path ON path.source IS NOT DISTINCT FROM p.source AND path.r = p.r)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM done
"""

ORACLE = {"op4_substring_dedup": OP4, "op5_exact_dedup": OP5, "op10_jaccard_join": OP10, "op12_minhash": OP12, "op13_merkle_manifest": OP13}
