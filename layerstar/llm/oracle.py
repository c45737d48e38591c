"""DuckDB SQL for the registered queries that SQL can express."""

from layerstar.llm.url_filter import ADDRESS, SUFFIXES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


OP8 = f"""
WITH d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
b AS (SELECT item_id, {_words('text')} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size,
         array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, i, x.size, item_id FROM doc_windows x JOIN item_windows y
         ON x.win = y.win AND x.size = y.size),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT doc_id, i, size FROM hits))
            GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
           FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


def _level(name: str, parent: str) -> str:
    """Posterior means of one level, shrunk towards its parent's by the beta-binomial moments."""
    prior = "(SELECT coalesce(sum(bad) / sum(n), 0) FROM hosts)" if not parent else "p.mean"
    join = f"JOIN post_{parent} p ON g.{parent} = p.name" if parent else ""
    keys = f"{parent}, {name}" if parent else name
    return f"""
grp_{name} AS (SELECT {keys}, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
prior_{name} AS (SELECT g.{name} AS name, g.n, g.bad, {prior} AS prior FROM grp_{name} g {join}),
weight_{name} AS (
  SELECT least(greatest(CASE WHEN sum(n - 1) > 0 THEN
    (sum(CASE WHEN prior * (1 - prior) > 0 THEN n * pow(bad / n - prior, 2) / (prior * (1 - prior)) ELSE 1 END)
     - count(*)) / sum(n - 1) ELSE 0 END, 0.001), 0.5) AS rho FROM prior_{name}),
post_{name} AS (SELECT name, n + w AS size, (bad + w * prior) / (n + w) AS mean
                FROM (SELECT *, 1 / rho - 1 AS w FROM prior_{name}, weight_{name}))"""


def _unseen(level: str, between: list[str]) -> str:
    """Lower bound of the rate of a host below a group, given the levels between them."""
    left = " * ".join(["(1 - 1 / (size + 1))", *[f"(1 - (SELECT rho FROM weight_{b}))" for b in between]])
    return f"SELECT *, mean - 1.645 * sqrt(mean * (1 - mean) * (1 - {left})) AS bound FROM {level}"



OP1 = f"""
WITH urls AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
              FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM urls),
named AS (SELECT page_id, host, path,
                 regexp_replace(regexp_replace(list_last(string_split(host, '@')), ':[0-9]*\\z', ''), '\\.+\\z', '') AS name FROM parts),
labels_of AS (SELECT *, string_split(name, '.') AS l, array_to_string(string_split(name, '.')[-2:], '.') AS two,
                     starts_with(name, '[') OR regexp_matches(name, '\\A[0-9]{{1,3}}(\\.[0-9]{{1,3}}){{3}}\\z') AS numeric FROM named),
levels AS (SELECT page_id, host, path,
                  CASE WHEN numeric THEN '{ADDRESS}' WHEN two IN {SUFFIXES} THEN two ELSE list_last(l) END AS suffix,
                  CASE WHEN numeric THEN name WHEN two IN {SUFFIXES} THEN array_to_string(l[-3:], '.')
                       ELSE two END AS domain FROM labels_of),
hosts AS (SELECT host, suffix, domain, CAST(count(*) AS DOUBLE) AS n, CAST(sum(1 - quality) AS DOUBLE) AS bad
          FROM levels JOIN labels ON page_id = doc_id WHERE quality IS NOT NULL GROUP BY ALL),
{_level('suffix', '')}, {_level('domain', 'suffix')}, {_level('host', 'domain')},
overall AS (SELECT coalesce(sum(n), 0) AS size, coalesce(sum(bad) / sum(n), 0) AS mean FROM hosts),
u_host AS ({_unseen('post_host', [])}), u_domain AS ({_unseen('post_domain', ['host'])}),
u_suffix AS ({_unseen('post_suffix', ['domain', 'host'])}), u_all AS ({_unseen('overall', ['suffix', 'domain', 'host'])}),
bounds AS (SELECT p.*, coalesce(h.bound, d.bound, s.bound, (SELECT bound FROM u_all)) AS lower FROM levels p
           LEFT JOIN u_host h ON p.host = h.name LEFT JOIN u_domain d ON p.domain = d.name
           LEFT JOIN u_suffix s ON p.suffix = s.name),
ruled AS (SELECT page_id, host, path, lower, CASE
  WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
  WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
  WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM bounds)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
  WHEN rule IS NOT NULL OR lower > 0.25 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


def _crc_table() -> str:
    """The 256 values of the CRC-32 polynomial 0xEDB88320, by its rule."""
    out = []
    for n in range(256):
        for _ in range(8):
            n = (n >> 1) ^ (0xEDB88320 if n & 1 else 0)
        out.append(n)
    return "[" + ", ".join(map(str, out)) + "]"


#: CRC-32 of a text: its bytes, two hexadecimal digits each, folded from the left.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT)),
    lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)"""

OP2 = f"""
WITH sized AS (
  SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) + 8 AS BIGINT) AS size,
         CASE WHEN text IS NOT NULL THEN {_CRC} END AS text_crc32
  FROM documents, (SELECT {_crc_table()} AS crc_table)),
placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id, text_crc32, size ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total
  FROM sized),
cut AS (SELECT *, CAST(least(23, ((2 * upto - size) * 24) // (2 * total)) AS INTEGER) AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM cut
"""

OP5 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 75 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, e.b FROM reached r JOIN edges e ON r.other = e.a),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN sizes USING (doc_id) JOIN least USING (doc_id)
"""

OP6 = """
WITH RECURSIVE usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
sized AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS norm FROM usable),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sized a JOIN sized b ON a.vec_id < b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.9),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
counts AS (SELECT a AS vec_id, count(*) AS n FROM edges GROUP BY a),
reached(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.vec_id, e.b FROM reached r JOIN edges e ON r.other = e.a),
least AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN counts USING (vec_id)
"""


def _boundary_steps(n_buckets: int) -> str:
    """f1 .. fn: least padded total of the first j cells in so many buckets, and where the last one
    begins (the first such place of equal ones); t1 .. tn: the way back from the last cell."""
    steps = ["f0 AS MATERIALIZED (SELECT 0::BIGINT AS j, 0::HUGEINT AS cost, 0::BIGINT AS i)"]
    for k in range(1, n_buckets + 1):
        steps.append(f"""
f{k} AS MATERIALIZED (
  SELECT 0::BIGINT AS j, 0::HUGEINT AS cost, 0::BIGINT AS i
  UNION ALL SELECT j, best // 100000, best % 100000 FROM (
    SELECT c.j, min((p.cost + c.longest::HUGEINT * (c.upto - b.upto)) * 100000 + p.j) AS best
    FROM cells c JOIN f{k - 1} p ON p.j < c.j JOIN cells b ON b.j = p.j WHERE c.j > 0 GROUP BY c.j))""")
    steps.append(f"t{n_buckets} AS (SELECT max(j) AS j FROM cells)")
    for k in range(n_buckets, 1, -1):
        steps.append(f"t{k - 1} AS (SELECT f{k}.i AS j FROM f{k} JOIN t{k} USING (j) WHERE j > 0)")
    return ",\n".join(steps)


OP3 = f"""
WITH rows AS MATERIALIZED (
  SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n FROM documents),
grouped AS (
  SELECT max(n) AS longest, count(*) AS c FROM (
    SELECT n, CASE WHEN n <= 1024 THEN n ELSE ceil(n / (pow(2, floor(log2(n))) / 256)) * pow(2, floor(log2(n))) / 256 END AS cell
    FROM rows) GROUP BY cell),
cells AS MATERIALIZED (
  SELECT 0::BIGINT AS j, 0::BIGINT AS longest, 0::HUGEINT AS upto
  UNION ALL SELECT row_number() OVER (ORDER BY longest), longest, sum(c) OVER (ORDER BY longest) FROM grouped),
{_boundary_steps(16)},
bounds AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY bound) - 1 AS bucket, bound, greatest(1, 65536 // greatest(1, bound)) AS cap,
         coalesce(lag(bound) OVER (ORDER BY bound), -1) AS above
  FROM (SELECT DISTINCT longest AS bound FROM cells JOIN (
          {' UNION ALL '.join(f'SELECT j FROM t{k}' for k in range(1, 17))}) USING (j) WHERE j > 0)),
placed AS MATERIALIZED (
  SELECT doc_id, n, bucket, bound, cap, row_number() OVER (PARTITION BY bucket ORDER BY doc_id, n) - 1 AS rank
  FROM rows JOIN bounds ON n > above AND n <= bound),
starts AS (
  SELECT bucket, coalesce(sum(batches) OVER (ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM (SELECT bucket, (count(*) + any_value(cap) - 1) // any_value(cap) AS batches FROM placed GROUP BY bucket))
SELECT doc_id, n AS n_tokens, CAST(bucket AS INTEGER) AS bucket, bound AS bucket_len,
       CAST(start + rank // cap AS BIGINT) AS batch, CAST(rank % cap AS INTEGER) AS slot
FROM placed JOIN starts USING (bucket)
"""

#: The pages of the driver tables keep their text in one article of headings and paragraphs, so a
#: plainer rule than the operator's gives the same: its blocks without markup.
OP4 = r"""
WITH blocks AS (
  SELECT page_id, url, string_split(regexp_replace(
           regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '</?(?:h[1-6]|p)>', chr(1), 'g'), chr(1)) AS b
  FROM pages),
plain AS (
  SELECT page_id, url, list_transform(b, lambda x: trim(regexp_replace(regexp_replace(
    replace(replace(replace(replace(replace(
      regexp_replace(replace(x, '<br>', ' '), '<[^>]*>', '', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS b
  FROM blocks),
texts AS (SELECT page_id, url, array_to_string(list_filter(b, lambda x: x <> ''), chr(10)) AS text FROM plain)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM texts
"""

#: Cuts and arranges with text functions; the restored text is that of the input.
OP12 = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
cut AS (
  SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3,
         CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM drawn),
formed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM cut),
parts AS (
  SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1, n - b) AS suffix FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
