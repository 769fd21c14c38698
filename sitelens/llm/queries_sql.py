"""Longer DuckDB twins of the training-data queries."""

from .licenses import TEMPLATES

OP8_DECONTAMINATION = r"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS text FROM documents),
    dx AS (
        SELECT doc_id, list_filter(regexp_split_to_array(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws FROM d),
    bx AS (
        SELECT item_id, list_filter(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws FROM benchmark),
    win AS (
        SELECT item_id, least(10, len(ws)) AS n, ws, unnest(range(0, greatest(len(ws) - 9, 1))) AS s
        FROM bx WHERE len(ws) > 0),
    phrases AS (SELECT DISTINCT item_id, n, ws[s + 1:s + n] AS phrase FROM win),
    dw AS (
        SELECT doc_id, n, p, ws[p + 1:p + n] AS phrase
        FROM (SELECT doc_id, n, ws, unnest(range(0, len(ws) - n + 1)) AS p
              FROM dx, (SELECT DISTINCT n FROM phrases) WHERE len(ws) >= n)),
    hits AS (SELECT DISTINCT doc_id, item_id, p, n FROM dw JOIN phrases USING (n, phrase)),
    covered AS (
        SELECT doc_id, count(DISTINCT q) AS n_hit
        FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY 1),
    listed AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY 1),
    dl AS (
        SELECT doc_id, list_filter(regexp_split_to_array(lower(text),
            '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws FROM d),
    postings AS (SELECT doc_id, unnest(ws) AS term, unnest(range(0, len(ws))) AS pos FROM dl),
    bl AS (
        SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')),
            '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws FROM benchmark),
    spots AS (
        SELECT item_id, s, s + o AS off, ws[s + o + 1] AS term
        FROM (SELECT item_id, ws, s, unnest(range(0, least(10, len(ws)))) AS o
              FROM (SELECT item_id, ws, unnest(range(0, greatest(len(ws) - 9, 1))) AS s
                    FROM bl WHERE len(ws) > 0))),
    ranked AS (
        SELECT item_id, s, off, term, count(*) OVER w0 AS terms_n,
               row_number() OVER (PARTITION BY item_id, s ORDER BY coalesce(n, 0), off) AS rank
        FROM spots LEFT JOIN (SELECT term, count(*) AS n FROM postings GROUP BY 1) USING (term)
        WINDOW w0 AS (PARTITION BY item_id, s)),
    anchors AS (
        SELECT DISTINCT a.item_id, a.term AS term1, a.off AS off1, b.term AS term2, b.off AS off2
        FROM ranked a JOIN ranked b ON a.item_id = b.item_id AND a.s = b.s
        WHERE a.rank = 1 AND b.rank = least(2, b.terms_n)),
    near AS (
        SELECT DISTINCT p1.doc_id, item_id
        FROM anchors JOIN postings p1 ON p1.term = term1
        JOIN postings p2 ON p2.term = term2 AND p2.doc_id = p1.doc_id
        WHERE abs((p1.pos - off1) - (p2.pos - off2)) <= 3)
    SELECT dx.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
           coalesce(n_near, 0) AS n_near
    FROM dx LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
    LEFT JOIN (SELECT doc_id, count(*) AS n_near FROM near
               ANTI JOIN hits USING (doc_id, item_id) GROUP BY 1) USING (doc_id)"""

_KINDS = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    ("access", "(AKIA[A-Z0-9]+)", 1, 18),
    ("hex", "([0-9a-f]+)", 1, 16),
    ("github", "(gh[pousr]_[A-Za-z0-9]{30,})", 1, 34),
    ("slack", "(xox[abeprs]-[A-Za-z0-9-]{10,})", 1, 15),
    ("jwt", r"(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", 1, 29),
    ("private_key", "(-----BEGIN [A-Z ]*PRIVATE KEY-----)", 1, 0),
    ("url_login", r"://[A-Za-z0-9._-]+:([^\x20\x09-\x0D/:@]{3,})@", 1, 3),
]


def _matches(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    return f"""
        SELECT doc_id, owner, repository, {rank} AS rank, '{kind}' AS kind, begin, begin + len(found) AS stop, value
        FROM (
            SELECT doc_id, owner, repository, found, value,
                   (sum(len(gap) + len(found)) OVER (PARTITION BY doc_id ORDER BY k))::BIGINT - len(found) AS begin
            FROM (SELECT doc_id, owner, repository, unnest(range(0, len(f))) AS k, unnest(f) AS found,
                         unnest(v) AS value, unnest(g[1:len(f)]) AS gap
                  FROM (SELECT doc_id, owner, repository, regexp_extract_all(text, '{pattern}') AS f,
                               regexp_extract_all(text, '{pattern}', {group}) AS v,
                               string_split_regex(text, '{pattern}') AS g FROM d)))
        WHERE len(value) >= {least}"""


OP6_SECRETS = f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, source AS owner, concat_ws('/', source, lang) AS repository
               FROM documents),
    s AS ({" UNION ALL ".join(_matches(rank, *kind) for rank, kind in enumerate(_KINDS))}),
    held AS (SELECT value, count(DISTINCT owner) AS n_owners,
                    count(DISTINCT (owner, repository)) AS n_repositories FROM s GROUP BY 1),
    judged AS (
        SELECT s.*, n_owners, n_repositories, kind || ':' || begin || ':' || stop AS span,
               CASE WHEN n_owners >= 3 OR len(list_distinct(string_split(value, ''))) < 6
                         OR contains(lower(value), 'example') THEN 'example'
                    WHEN n_owners = 1 AND n_repositories < 3 THEN 'live' ELSE 'shared' END AS verdict
        FROM s JOIN held USING (value)),
    per_doc AS (
        SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign,
               count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
               string_agg(span, ',' ORDER BY begin, rank) FILTER (WHERE rank < 3) AS base,
               string_agg(span, ',' ORDER BY begin, rank) AS spans,
               count(*) FILTER (WHERE verdict = 'live') AS n_live,
               count(*) FILTER (WHERE verdict = 'shared') AS n_shared,
               count(*) FILTER (WHERE verdict = 'example') AS n_example,
               max(n_owners) AS most_owners, max(n_repositories) AS most_repositories
        FROM judged GROUP BY 1)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(per_doc.spans, '') AS spans,
           coalesce(n_live, 0) AS n_live, coalesce(n_shared, 0) AS n_shared, coalesce(n_example, 0) AS n_example,
           coalesce(most_owners, 0) AS most_owners, coalesce(most_repositories, 0) AS most_repositories
    FROM d LEFT JOIN per_doc USING (doc_id)"""

OP9_CHAT = r"""
    WITH c AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
        UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
    sized AS (
        SELECT *, 24 + len(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n'))
                  + len(replace(replace(text, '\', '\\'), '<|', '<\|')) AS n FROM c),
    placed AS (
        SELECT *, sum(n) OVER w AS stop, row_number() OVER w AS seq, floor(turn / 256) AS cell,
               '<|im_start|>' || replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n') || chr(10)
               || replace(replace(text, '\', '\\'), '<|', '<\|') || '<|im_end|>' || chr(10) AS segment
        FROM sized WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)),
    parts AS (
        SELECT e.conv_id, e.seq, p.cell, sha256(string_agg(p.segment, '' ORDER BY p.seq)) AS h
        FROM placed e JOIN placed p ON p.conv_id = e.conv_id AND p.seq <= e.seq
        WHERE e.role = 'assistant' GROUP BY 1, 2, 3),
    contexts AS (
        SELECT conv_id, sha256(string_agg(h, ',' ORDER BY seq)) AS h
        FROM (SELECT conv_id, seq, sha256(string_agg(h, ',' ORDER BY cell)) AS h FROM parts GROUP BY 1, 2) GROUP BY 1),
    digests AS (
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY seq)) AS turns_sha256,
               coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY seq) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               coalesce(sum(stop) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS formatted_chars
        FROM placed GROUP BY 1)
    SELECT digests.*, coalesce(contexts.h, sha256('')) AS contexts_sha256
    FROM digests LEFT JOIN contexts ON contexts.conv_id = digests.conv_id"""

OP12_DIVERGENCE = r"""
    WITH d AS (
        SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents),
    t AS (SELECT k, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    kept AS (SELECT lang, term, count(*) AS c FROM t GROUP BY 1, 2 HAVING count(DISTINCT k) >= 10),
    l AS (SELECT lang, count(*) AS v, sum(c) AS total FROM kept GROUP BY 1),
    g AS (SELECT DISTINCT lang, source FROM d),
    n AS (SELECT lang, source, term, count(*) AS c FROM t JOIN (SELECT lang, term FROM kept) USING (lang, term)
          GROUP BY 1, 2, 3),
    gt AS (SELECT lang, source, sum(c) AS total FROM n GROUP BY 1, 2),
    p AS (
        SELECT g.lang, g.source, kept.term, coalesce(n.c, 0) AS c,
               1 + (1000000000::HUGEINT * (coalesce(n.c, 0) + 2)) // (coalesce(gt.total, 0) + 2 * l.v) AS p,
               1 + (1000000000::HUGEINT * (kept.c + 2)) // (l.total + 2 * l.v) AS q
        FROM g JOIN kept ON kept.lang = g.lang JOIN l ON l.lang = g.lang
        LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = kept.term
        LEFT JOIN gt ON gt.lang = g.lang AND gt.source = g.source),
    sums AS (
        SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
    pairs AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sums.value, 0)::BIGINT AS value
        FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
    terms AS (
        SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value
        FROM p WHERE c > 0 AND p > q),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
        FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
    SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10"""

_TEMPLATES = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in TEMPLATES.items())

OP3_LICENSES = r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS unit FROM d),
    units AS (
        SELECT doc_id, text AS unit FROM d
        UNION SELECT doc_id, unnest(string_split_regex(text, '\n[\x20\x09\x0D]*\n')) FROM d
        UNION SELECT * FROM lines
        UNION SELECT doc_id, unnest(string_split_regex(unit, '[.!?][\x20\x09-\x0D]+')) FROM lines),
    uw AS (SELECT doc_id, list_filter(string_split_regex(lower(unit), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
                                      lambda w: w <> '') AS w FROM units),
    ub AS (SELECT doc_id, list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS b
           FROM uw WHERE len(w) > 1),
    tw AS (SELECT license, list_filter(string_split_regex(lower(body), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
                                       lambda w: w <> '') AS w FROM (VALUES """ + _TEMPLATES + r""") v(license, body)),
    tb AS (SELECT license, list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS b FROM tw),
    met AS (
        SELECT doc_id, license, max(2.0::DOUBLE * len(list_intersect(ub.b, tb.b)) / (len(ub.b) + len(tb.b))) AS score
        FROM ub, tb WHERE len(ub.b) BETWEEN len(tb.b) * 0.6 AND len(tb.b) * 1.6 GROUP BY 1, 2),
    per_doc AS (
        SELECT doc_id, count(*) AS n_licenses, string_agg(license, ',' ORDER BY license) AS licenses,
               max(score) AS best_score
        FROM met WHERE score >= 0.8 GROUP BY 1)
    SELECT doc_id, coalesce(n_licenses, 0) AS n_licenses, coalesce(licenses, '') AS licenses,
           coalesce(best_score, 0.0::DOUBLE) AS best_score
    FROM d LEFT JOIN per_doc USING (doc_id)"""
