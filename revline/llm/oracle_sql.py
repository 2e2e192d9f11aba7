"""DuckDB SQL for the training-data queries that SQL can express."""

ORACLES = {}

ORACLES["op8_exact_dedup"] = """
WITH t AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, coalesce(text, '') AS body FROM documents)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       text_sha256
FROM t
WINDOW same AS (PARTITION BY body)
"""

# every prefix of the 60 hash bits that a bucket may have, without any directory
ORACLES["op2_sharding"] = """
WITH r AS (SELECT doc_id, coalesce(strlen(text), 0) AS bytes,
                  ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS h FROM documents),
     n AS (SELECT doc_id, bytes, d::INTEGER AS depth, h >> (60 - d)::INTEGER AS node,
                  sum(bytes) OVER b AS shard_bytes, count(*) OVER b AS shard_rows
           FROM r, range(0, 24) AS t(d)
           WINDOW b AS (PARTITION BY d, h >> (60 - d)::INTEGER))
SELECT doc_id, bytes::BIGINT AS bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(node), depth, '0') END AS shard,
       depth, shard_bytes::BIGINT AS shard_bytes, shard_rows
FROM n WHERE shard_bytes <= 16777216
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1
"""

ORACLES["op7_lm_scoring"] = r"""
WITH d AS (SELECT doc_id, regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0b\f\r]+') AS words
           FROM documents),
     p AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM d),
     t AS (SELECT doc_id, i, w, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM p WHERE w <> ''),
     one AS (SELECT w, count(*) AS c FROM t GROUP BY w),
     one_here AS (SELECT doc_id, w, count(*) AS c FROM t GROUP BY ALL),
     two AS (SELECT b, w, count(*) AS c FROM t WHERE b IS NOT NULL GROUP BY ALL),
     two_here AS (SELECT doc_id, b, w, count(*) AS c FROM t WHERE b IS NOT NULL GROUP BY ALL),
     elsewhere AS (
       SELECT t.doc_id, t.b, one.c - one_here.c AS c_w, two.c - two_here.c AS c_bw,
              before.c - before_here.c AS c_b,
              greatest(1, (SELECT count(*) FROM t) - count(*) OVER (PARTITION BY t.doc_id)) AS n
       FROM t JOIN one ON one.w = t.w JOIN one_here ON one_here.doc_id = t.doc_id AND one_here.w = t.w
       LEFT JOIN two ON two.b = t.b AND two.w = t.w
       LEFT JOIN two_here ON two_here.doc_id = t.doc_id AND two_here.b = t.b AND two_here.w = t.w
       LEFT JOIN one AS before ON before.w = t.b
       LEFT JOIN one_here AS before_here ON before_here.doc_id = t.doc_id AND before_here.w = t.b),
     s AS (
       SELECT doc_id, count(*) AS n_words,
              sum(ln(CASE WHEN b IS NOT NULL AND c_bw > 0 THEN c_bw / c_b
                          ELSE CASE WHEN b IS NULL THEN 1.0::DOUBLE ELSE 0.4::DOUBLE END
                               * CASE WHEN c_w > 0 THEN c_w ELSE 0.4::DOUBLE END / n END)) AS total,
              sum(CASE WHEN b IS NOT NULL AND c_bw > 0 THEN 1 ELSE 0 END)::BIGINT AS full_order,
              sum(CASE WHEN c_w = 0 THEN 1 ELSE 0 END)::BIGINT AS unseen
       FROM elsewhere GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, round(coalesce(total, 0.0::DOUBLE), 4) AS log_score,
       round(total / n_words, 6) AS mean_log_score, coalesce(full_order, 0) AS full_order,
       coalesce(unseen, 0) AS unseen
FROM d LEFT JOIN s USING (doc_id)
"""

ORACLES["op12_fill_in_middle"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
     u AS (SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS units,
                  ('0x' || substr(k, 1, 8))::BIGINT AS h1, ('0x' || substr(k, 9, 8))::BIGINT AS h2,
                  ('0x' || substr(k, 17, 8))::BIGINT AS h3, ('0x' || substr(k, 25, 8))::BIGINT AS h4 FROM d),
     c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS lo,
                  greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS hi,
                  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                            OR h3 % 100 >= 90 THEN 'plain'
                       WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
     p AS (SELECT doc_id, n, form, t, array_to_string(units[1:lo], '') AS prefix,
                  array_to_string(units[lo + 1:hi], '') AS middle, array_to_string(units[hi + 1:n], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                   ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

# level by level; the checksum bit by bit, folding step by step
ORACLES["op13_merkle_manifest"] = """
WITH RECURSIVE
said AS (SELECT doc_id, lang,
                CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
                || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
                || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS before,
                CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END AS counted,
                CASE WHEN n_chars IS NULL THEN '-' ELSE strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) END AS miscounted,
                CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS after,
                xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
                      string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384)
                                      ELSE a >> 1 END), 4294967295) AS crc
         FROM documents),
hashed AS (SELECT doc_id, lang, sha256(before || counted || after) AS leaf,
                  CASE WHEN crc % 7 = 0 THEN sha256(before || miscounted || after)
                       ELSE sha256(before || counted || after) END AS offered FROM said),
leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r FROM hashed),
up(lang, lev, r, d, n) AS (
    SELECT lang, 0, r, leaf, count(*) OVER (PARTITION BY lang) FROM leaves
    UNION ALL
    SELECT lang, lev + 1, r // 2, sha256(string_agg(d, '' ORDER BY r)), (max(n) + 1) // 2
    FROM up WHERE n > 1 GROUP BY lang, lev, r // 2),
tops AS (SELECT lang, d AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS r FROM up WHERE n = 1),
over_tops(lev, r, d, n) AS (
    SELECT 0, r, subroot, count(*) OVER () FROM tops
    UNION ALL
    SELECT lev + 1, r // 2, sha256(string_agg(d, '' ORDER BY r)), (max(n) + 1) // 2
    FROM over_tops WHERE n > 1 GROUP BY lev, r // 2),
steps AS (
    SELECT l.lang, l.r, h.lev, (l.r >> h.lev) & 1 AS digit, coalesce(s.d, '') AS sibling
    FROM leaves AS l
    JOIN (SELECT DISTINCT lang, lev FROM up WHERE n > 1) AS h ON h.lang IS NOT DISTINCT FROM l.lang
    LEFT JOIN up AS s ON s.lang IS NOT DISTINCT FROM l.lang AND s.lev = h.lev AND s.r = xor(l.r >> h.lev, 1)
    UNION ALL
    SELECT l.lang, l.r, 1000 + h.lev, (t.r >> h.lev) & 1, coalesce(s.d, '')
    FROM leaves AS l JOIN tops AS t ON t.lang IS NOT DISTINCT FROM l.lang
    CROSS JOIN (SELECT DISTINCT lev FROM over_tops WHERE n > 1) AS h
    LEFT JOIN over_tops AS s ON s.lev = h.lev AND s.r = xor(t.r >> h.lev, 1)),
proofs AS (SELECT lang, r, string_agg(sibling, '' ORDER BY lev) AS proof,
                  list(digit || sibling ORDER BY lev) AS path FROM steps GROUP BY lang, r),
folded AS (SELECT l.doc_id, l.leaf, t.subroot, sha256(coalesce(p.proof, '')) AS proof_sha256,
                  (SELECT d FROM over_tops WHERE n = 1) AS root,
                  list_reduce(list_concat([l.offered], coalesce(p.path, [])),
                              lambda a, x: CASE WHEN x[1] = '1' THEN sha256(substr(x, 2) || a)
                                                ELSE sha256(a || substr(x, 2)) END) AS folded_root
           FROM leaves AS l JOIN tops AS t ON t.lang IS NOT DISTINCT FROM l.lang
           LEFT JOIN proofs AS p ON p.lang IS NOT DISTINCT FROM l.lang AND p.r = l.r)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""
