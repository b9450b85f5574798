"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_WS = "[\\x20\\x09-\\x0D]+"

ORACLE_SQL = {
    "op4_exact_dedup": f"""
        WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_WS}', ' ', 'g')) AS h FROM documents),
        g AS (SELECT h, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY h)
        SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, n.h AS text_sha256
        FROM n JOIN g ON n.h = g.h""",
    "op5_url_rules": """
        WITH u AS (
            SELECT page_id,
                   coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
                                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                   coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
            FROM pages),
        rules(rhost, rpath, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                                ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
        fits AS (
            SELECT page_id, max_by({'rule': rhost || rpath, 'verdict': verdict}, length(rhost || rpath)) AS best
            FROM u JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
            GROUP BY page_id)
        SELECT u.page_id, u.host, u.path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
        FROM u LEFT JOIN fits ON u.page_id = fits.page_id""",
    "op12_piece_table": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS h,
                          regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u FROM documents),
        d AS (SELECT *, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS a,
                     ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS b,
                     ('0x' || substr(h, 17, 8))::BIGINT % 100 AS p, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS s FROM t),
        f AS (SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                                  OR p >= 90 THEN 'plain' WHEN s < 20 THEN 'spm' ELSE 'psm' END AS form,
                     array_to_string(u[1:least(a, b)], '') AS pre,
                     array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS mid,
                     array_to_string(u[greatest(a, b) + 1:], '') AS suf FROM d)
        SELECT doc_id, CAST(n AS BIGINT) AS n, form,
               CAST(CASE WHEN form <> 'plain' THEN length(pre) END AS BIGINT) AS prefix_chars,
               CAST(CASE WHEN form <> 'plain' THEN length(mid) END AS BIGINT) AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                      ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
               sha256(text) AS restored_sha256 FROM f""",
    "op13_chunk_audit": """
        WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
        o AS (SELECT id, lang, source, unnest(terms) AS term FROM d),
        kept AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
        g AS (SELECT DISTINCT lang, source FROM d),
        c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN kept USING (lang, term) GROUP BY ALL),
        v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
        gt AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
               FROM g JOIN kept k ON k.lang = g.lang
               LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        p AS (SELECT lang, source, term, n,
                     1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang, source) + v)::HUGEINT AS p
              FROM gt JOIN v USING (lang)),
        l AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang) + v)::HUGEINT AS q
              FROM (SELECT lang, term, sum(n) AS n FROM gt GROUP BY ALL) JOIN v USING (lang)),
        pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
                  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
              FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
              UNION ALL
              SELECT p.lang, p.source, 'term', p.term, ((p.p - l.q) * (p.p - l.q)) // l.q
              FROM p JOIN l ON p.lang = l.lang AND p.term = l.term WHERE p.n > 0 AND p.p > l.q)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
               CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
        FROM r QUALIFY part = 'pair' OR row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) <= 200""",
}
