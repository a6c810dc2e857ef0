"""DuckDB SQL for the queries that SQL can express, over the same tables and with the same parameters."""

from __future__ import annotations

from brandbook.llm import decontaminate, infill, mixture, resampling, url_filter

_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, 10 * (i // 8) + 1, 10))::BIGINT >> (5 * (7 - i % 8))) & 31) + 1)::BIGINT, 1)"

WARC_SQL = f"""
WITH hashed AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
named AS (
  SELECT page_id, payload, list_aggregate(list_transform(range(0, 32), lambda i: {_DIGIT}), 'string_agg', '') AS payload_digest,
    max(page_id) OVER (PARTITION BY payload) AS original FROM hashed)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to
FROM named
"""

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE_SQL = f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
patterns AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS pattern
  FROM (SELECT item_id, w, least({decontaminate.WINDOW}, len(w)) AS size FROM items WHERE len(w) > 0), LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS i)),
docs AS (SELECT row_number() OVER () AS n, doc_id, {_WORDS} AS w FROM documents),
windows AS (
  SELECT n, size, i, array_to_string(w[i:i + size - 1], ' ') AS pattern
  FROM docs, (SELECT DISTINCT size FROM patterns), LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS i)),
found AS (SELECT n, i, size, item_id FROM windows JOIN patterns USING (size, pattern)),
hits AS (SELECT n, count(DISTINCT p) AS n_hit FROM found, LATERAL (SELECT unnest(range(i, i + size)) AS p) GROUP BY n),
named AS (SELECT n, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT n, item_id::VARCHAR AS id FROM found WHERE item_id IS NOT NULL) GROUP BY n)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (n) LEFT JOIN named USING (n)
"""


def _url_sql(order: int = url_filter.ORDER) -> str:
    rules = sorted(url_filter.RULES, key=lambda r: (-len(r[1]) - len(r[2]), -len(r[1])))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, kind) for kind, h, p in rules]
    case = lambda k: "CASE " + " ".join(f"WHEN {f[0]} THEN '{f[k]}'" for f in fits) + " END"
    levels = []
    for j in range(order + 1):
        mixed = ", ".join(f"CASE WHEN n{c} = 0 THEN q{c} ELSE ({c} + t{c} * q{c}) / (n{c} + t{c}) END AS p{c}" for c in "ar")
        sums = ", ".join(f"sum({c}) OVER w AS n{c}, sum(({c} > 0)::INT) OVER w AS t{c}" for c in "ar")
        shorter = "CROSS JOIN (SELECT 1.0::DOUBLE / count(DISTINCT right(gram, 1)) AS qa, 1.0::DOUBLE / count(DISTINCT right(gram, 1)) AS qr FROM grams)" if j == 0 else f"JOIN (SELECT g AS s, pa AS qa, pr AS qr FROM l{j - 1}) ON right(g, {j}) = s"
        levels.append(f"l{j} AS (SELECT g, {mixed} FROM (SELECT g, a, r, {sums} FROM (SELECT right(gram, {j + 1}) AS g, sum(a)::DOUBLE AS a, sum(r)::DOUBLE AS r FROM grams GROUP BY 1) WINDOW w AS (PARTITION BY left(g, {j}))) {shorter})")
    newline = ",\n"
    return f"""
WITH base AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM base),
ruled AS (SELECT page_id, host, path, host || path AS text, {case(1)} AS rule, {case(2)} AS own FROM split),
urls AS (SELECT text, own, count(*) AS copies FROM ruled GROUP BY ALL),
places AS (SELECT text, own, copies, substr(repeat(chr(2), {order}) || text || chr(3), i, {order + 1}) AS gram FROM urls, LATERAL (SELECT unnest(range(1, length(text) + 2)) AS i)),
grams AS (SELECT gram, sum(CASE WHEN own = 'allow' THEN copies ELSE 0 END) AS a, sum(CASE WHEN own = 'block' THEN copies ELSE 0 END) AS r FROM places GROUP BY gram),
{newline.join(levels)},
ratios AS (SELECT g AS gram, round((ln(pa) - ln(pr)) * {url_filter.SCALE})::BIGINT AS ratio FROM l{order}),
scores AS (SELECT text, sum(ratio)::DOUBLE / count(*) AS score FROM (SELECT DISTINCT text, unnest(range(1, length(text) + 2)) AS i FROM urls) JOIN ratios ON gram = substr(repeat(chr(2), {order}) || text || chr(3), i, {order + 1}) GROUP BY text),
stats AS (SELECT own, sum(copies * score) / sum(copies) AS m, sqrt(greatest(0, sum(copies * score * score) / sum(copies) - (sum(copies * score) / sum(copies)) ** 2)) AS d FROM urls JOIN scores USING (text) WHERE own IS NOT NULL GROUP BY own),
cut AS (SELECT coalesce(round(CASE WHEN a.d + b.d > 0 THEN (a.m * b.d + b.m * a.d) / (a.d + b.d) ELSE (a.m + b.m) / 2 END, 3), 0) AS cut FROM (SELECT 1) LEFT JOIN stats a ON a.own = 'allow' LEFT JOIN stats b ON b.own = 'block')
SELECT page_id, host, path, rule, coalesce(own, CASE WHEN score >= cut THEN 'allow' ELSE 'block' END) AS verdict FROM ruled JOIN scores USING (text), cut
"""


ORACLE_SQL = {"op1_warc": WARC_SQL, "op3_decontaminate": DECONTAMINATE_SQL, "op6_mixture": mixture.MIX_SQL, "op9_url_filter": _url_sql(), "op11_infill": infill.INFILL_SQL, "op12_resampling": resampling.RESAMPLING_SQL}
