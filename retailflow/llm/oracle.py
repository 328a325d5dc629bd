"""DuckDB statements for the queries that SQL can express.

Written out by hand (constants included), so that they do not share code with
the operators that they check.
"""

#: Rules, hosts and the beta-binomial shrinkage of op7. Strengths by the method
#: of moments, bounds 1 and 1000, z = 1.64, threshold 0.5.
OP7 = r"""
WITH parsed AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/'
    END AS rule
  FROM parsed),
decided AS (
  SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
                 WHEN rule IS NOT NULL THEN 'allow' END AS verdict0 FROM ruled),
hosts AS (
  SELECT host, count(verdict0)::DOUBLE AS n, count(*) FILTER (verdict0 = 'block')::DOUBLE AS bad,
         string_split(host, '.')[-1] AS suffix,
         CASE WHEN len(string_split(host, '.')) < 2 THEN host
              ELSE string_split(host, '.')[-2] || '.' || string_split(host, '.')[-1] END AS domain
  FROM decided GROUP BY host),
domains AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL),
total AS (SELECT (coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(n), 0) + 1.0) AS prior FROM suffixes),
s0 AS (SELECT suffixes.*, prior FROM suffixes, total),
ss AS (SELECT sum(n * (bad / n - prior) * (bad / n - prior)) AS a, sum(prior * (1 - prior)) AS b,
              sum(prior * (1 - prior) * (n - 1)) AS c FROM s0 WHERE n > 0),
sk AS (SELECT CASE WHEN coalesce(c, 0.0) <= 0 THEN 1000.0
                   WHEN round((a - b) / c, 9) <= 1.0 / 1001 THEN 1000.0
                   ELSE greatest(1.0, 1 / round((a - b) / c, 9) - 1) END AS strength FROM ss),
s1 AS (SELECT suffix, (bad + strength * prior) / (n + strength) AS mean FROM s0, sk),
d0 AS (SELECT domains.*, s1.mean AS prior FROM domains JOIN s1 USING (suffix)),
ds AS (SELECT sum(n * (bad / n - prior) * (bad / n - prior)) AS a, sum(prior * (1 - prior)) AS b,
              sum(prior * (1 - prior) * (n - 1)) AS c FROM d0 WHERE n > 0),
dk AS (SELECT CASE WHEN coalesce(c, 0.0) <= 0 THEN 1000.0
                   WHEN round((a - b) / c, 9) <= 1.0 / 1001 THEN 1000.0
                   ELSE greatest(1.0, 1 / round((a - b) / c, 9) - 1) END AS strength FROM ds),
d1 AS (SELECT suffix, domain, (bad + strength * prior) / (n + strength) AS mean FROM d0, dk),
h0 AS (SELECT hosts.*, d1.mean AS prior FROM hosts JOIN d1 USING (suffix, domain)),
hs AS (SELECT sum(n * (bad / n - prior) * (bad / n - prior)) AS a, sum(prior * (1 - prior)) AS b,
              sum(prior * (1 - prior) * (n - 1)) AS c FROM h0 WHERE n > 0),
hk AS (SELECT CASE WHEN coalesce(c, 0.0) <= 0 THEN 1000.0
                   WHEN round((a - b) / c, 9) <= 1.0 / 1001 THEN 1000.0
                   ELSE greatest(1.0, 1 / round((a - b) / c, 9) - 1) END AS strength FROM hs),
h1 AS (SELECT host, n + strength AS k, (bad + strength * prior) / (n + strength) AS mean FROM h0, hk),
judged AS (SELECT host, CASE WHEN round(mean - 1.64 * sqrt(mean * (1 - mean) / (k + 1)), 9) > 0.5
                             THEN 'block' ELSE 'allow' END AS by_host FROM h1)
SELECT page_id, host, path, rule, coalesce(verdict0, by_host) AS verdict
FROM decided JOIN judged USING (host)
"""

SQL = {"op7_url_reputation": OP7}

#: Windows of 35 words as strings, counted over all documents.
OP2 = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
           FROM documents),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM t),
starts AS (SELECT r, i, word, count(*) OVER ahead AS size, string_agg(word, ' ') OVER ahead AS s
           FROM words WINDOW ahead AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
repeated AS (SELECT s FROM starts WHERE size = 35 GROUP BY s HAVING count(*) > 1),
flagged AS (SELECT r, i, word, CASE WHEN size = 35 AND s IN (SELECT s FROM repeated) THEN 1 ELSE 0 END AS hit FROM starts),
covered AS (SELECT r, i, word, max(hit) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
            FROM flagged),
kept AS (SELECT r, count(*) AS n_words, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS rest
         FROM covered GROUP BY r)
SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(rest, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (r)
"""


def _spans(kind: str, rank: int, pattern: str, keep: str) -> str:
    """Matches of one rule with their places: pieces between matches and matches before add up."""
    p = pattern.replace("'", "''")
    return f"""
  SELECT r, '{kind}' AS kind, {rank} AS rank, m.start AS start, m.start + length(m.hit) AS stop
  FROM (SELECT r, unnest(list_transform(range(1, len(hits) + 1), lambda i: {{
          'hit': hits[i],
          'start': CAST(list_sum(list_transform(gaps[1:i], lambda s: length(s)))
                   + coalesce(list_sum(list_transform(hits[1:i - 1], lambda s: length(s))), 0) AS BIGINT)}})) AS m
        FROM (SELECT r, regexp_extract_all(x, '{p}') AS hits, string_split_regex(x, '{p}') AS gaps FROM t))
  WHERE {keep}"""


_ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
OP5 = "WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x FROM documents), spans AS (" + "\n  UNION ALL".join([
    _spans("assign", 0, _ASSIGN, "length(regexp_extract(m.hit, '" + _ASSIGN.replace("'", "''") + "', 2)) >= 6"),
    _spans("access", 1, "AKIA[A-Z0-9]+", "length(m.hit) >= 20"),
    _spans("hex", 2, "[0-9a-f]{24,}", "true"),
    _spans("pem", 3, "-----BEGIN [A-Z ]*PRIVATE KEY-----", "true"),
    _spans("jwt", 4, r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", "true"),
]) + """),
lists AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans
  FROM spans GROUP BY r)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
       CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN lists USING (r)
"""

#: Containment of an item's shingles in a document; items shorter than five words are one shingle of their length.
OP10 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
items AS (
  SELECT row_number() OVER () AS it, item_id, w, least(5, len(w)) AS k
  FROM (SELECT item_id, regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL))
  WHERE len(w) > 0),
item_shingles AS (
  SELECT DISTINCT it, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT it, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM items)),
sizes AS (SELECT it, count(*) AS q FROM item_shingles GROUP BY it),
doc_shingles AS (
  SELECT DISTINCT r, k, string_agg(word, ' ') OVER (PARTITION BY r, k ORDER BY i ROWS BETWEEN CURRENT ROW AND k - 1 FOLLOWING) AS s
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs), (SELECT DISTINCT k FROM items)),
shared AS (SELECT r, it, count(*) AS n FROM doc_shingles JOIN item_shingles USING (k, s) GROUP BY r, it),
found AS (SELECT r, item_id, n / q AS share FROM shared JOIN sizes USING (it) JOIN items USING (it) WHERE n >= 0.8 * q - 1e-9),
per_doc AS (SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS item_ids,
                   max(share) AS containment FROM found GROUP BY r)
SELECT doc_id, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(item_ids, '') AS item_ids,
       CAST(coalesce(containment, 0) AS DOUBLE) AS containment, n_items IS NOT NULL AS contaminated
FROM docs LEFT JOIN per_doc USING (r)
"""

SQL |= {"op2_substring_trees": OP2, "op5_secret_scan": OP5, "op10_decontamination": OP10}


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII string, bit by bit."""
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""


#: All pairs of equal words at most a third of the text apart, chained to stretches.
OP13 = r"""
WITH hashed AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         CASE WHEN doc_id IS NULL THEN 1 ELSE """ + _crc32("CAST(doc_id AS VARCHAR)") + r""" END AS h
  FROM documents),
placed AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM hashed),
texts AS (
  SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END])
    ELSE w END AS w
  FROM placed),
words AS (SELECT r, n, unnest(w) AS word, unnest(range(0, n)) AS x FROM texts),
equal AS (SELECT i.r, i.x, j.x - i.x AS p FROM words i JOIN words j ON i.r = j.r AND i.word = j.word
          AND j.x > i.x AND 3 * (j.x - i.x) <= i.n),
chained AS (SELECT r, p, x, x - row_number() OVER (PARTITION BY r, p ORDER BY x) AS chain FROM equal),
stretches AS (SELECT r, p, min(x) AS start, count(*) + p AS length FROM chained GROUP BY r, p, chain),
runs AS (SELECT r, start, length, min(p) AS period FROM stretches WHERE length >= greatest(24, 3 * p) GROUP BY ALL),
best AS (SELECT r, start, length, period FROM runs
         QUALIFY row_number() OVER (PARTITION BY r ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) = 1),
lines AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS t
          FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS x FROM runs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY x) AS t FROM words ANTI JOIN gone USING (r, x) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(lines.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM texts LEFT JOIN best USING (r) LEFT JOIN lines USING (r) LEFT JOIN kept USING (r)
"""

SQL |= {"op13_periodic_runs": OP13}


def _edited(state: str, cost: str, letter: str) -> str:
    """A path 'nine digits of cost, then audit' with one more edit."""
    return f"lpad(CAST(CAST(left({state}, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || substr({state}, 10) || '{letter}'"


def _moved(source: list[str], initial: str) -> list[str]:
    """Keep (where the initial fits) and rerole from each of the sources; not for blank or duplicate rows."""
    more = "CASE WHEN f.fault = 3 THEN 5 ELSE 0 END"
    return [f"CASE WHEN f.fault < 1 OR f.fault > 2 THEN CASE WHEN f.initial = '{initial}' THEN {_edited(x, more, 'K')} END END" for x in source] + \
        [f"CASE WHEN f.fault < 1 OR f.fault > 2 THEN {_edited(x, '1 + ' + more, 'R')} END" for x in source if initial != "s"]


#: Least of 'cost, audit' strings for each phase, row after row. An insert costs more than deleting its neighbour in
#: the pattern and a leading s, so no cheapest audit has one, and letter i belongs to row i.
OP11 = r"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         """ + _crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')") + r""" % 20 AS h
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM src, range(2) AS copies(copy) WHERE h <> 0 AND (copy = 0 OR h = 3)),
numbered AS (
  SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM damaged),
earlier AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen FROM numbered),
faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN seen > 1 THEN 2
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault,
         left(role, 1) || lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS pair FROM earlier),
walk AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '000000000' AS b, CAST(NULL AS VARCHAR) AS s, CAST(NULL AS VARCHAR) AS u,
         CAST(NULL AS VARCHAR) AS a FROM damaged
  UNION ALL
  SELECT f.conv_id, f.i, """ + _edited("w.b", "2", "D") + r""",
         least(""" + ", ".join([_edited("w.s", "2", "D"), *_moved(["w.b"], "s")]) + r"""),
         least(""" + ", ".join([_edited("w.u", "2", "D"), *_moved(["w.b", "w.s", "w.a"], "u")]) + r"""),
         least(""" + ", ".join([_edited("w.a", "2", "D"), *_moved(["w.u"], "a")]) + r""")
  FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1),
best AS (SELECT conv_id, least(b, a) AS path FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
kept AS (
  SELECT f.conv_id, f.i, f.role, f.initial, f.text, substr(path, 9 + f.i, 1) AS edit,
         row_number() OVER (PARTITION BY f.conv_id ORDER BY f.i) AS k
  FROM faults f JOIN best ON f.conv_id IS NOT DISTINCT FROM best.conv_id WHERE substr(path, 9 + f.i, 1) <> 'D'),
lines AS (
  SELECT conv_id, i, text, CASE WHEN edit = 'K' THEN role
    WHEN (k - max(CASE WHEN k = 1 AND edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id)) % 2 = 1
    THEN 'user' ELSE 'assistant' END AS role FROM kept),
repaired AS (SELECT conv_id, string_agg(role || ':' || text, chr(10) ORDER BY i) AS t FROM lines GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
         count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(CAST(left(path, 9) AS BIGINT), 0) AS cost,
       coalesce(substr(path, 10), '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN repaired ON repaired.conv_id IS NOT DISTINCT FROM ids.conv_id
"""

SQL |= {"op11_conversation_repair": OP11}

#: All pairs that share a shingle, counted; components by following links.
OP12 = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
words AS (SELECT r, least(4, len(w)) AS k, len(w) AS n, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs),
runs AS (SELECT r, k, n, i, string_agg(word, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS s FROM words),
shingles AS (SELECT DISTINCT r, s FROM runs WHERE i <= n - k + 1),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.r <> y.r GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes sa ON sa.r = a JOIN sizes sb ON sb.r = b WHERE 100 * c >= 85 * (sa.n + sb.n - c)),
reached AS (SELECT r AS a, r AS b FROM docs UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b),
least_id AS (SELECT a, min(doc_id) AS component_id FROM reached JOIN docs ON docs.r = reached.b GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM docs JOIN least_id ON least_id.a = docs.r LEFT JOIN sizes ON sizes.r = docs.r
"""

SQL |= {"op12_jaccard_join": OP12}
