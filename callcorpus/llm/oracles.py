"""DuckDB SQL for the registered queries of this subpackage that SQL can express."""

WORD = r"[^\x20\x09-\x0D]+"

OP2 = rf"""
WITH d AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
         ('0x' || substr(md5(concat_ws('|', '20', doc_id::VARCHAR, md5(text))), 1, 15))::BIGINT AS key
  FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS ssize, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk FROM d GROUP BY source),
s1 AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][1 + rk % 3] AS w, ssize * 2.0::DOUBLE AS cap FROM s0),
s2 AS (
  SELECT *, sum(cap) OVER o AS cap_to, sum(w) OVER o AS w_to, sum(w) OVER () AS w_all, 1.5::DOUBLE * sum(ssize) OVER () AS total
  FROM s1 WINDOW o AS (ORDER BY cap / w, rk ROWS UNBOUNDED PRECEDING)),
s3 AS (SELECT *, (total - (cap_to - cap)) / (w_all - (w_to - w)) AS lvl FROM s2),
lv AS (SELECT coalesce(arg_min(lvl, cap / w) FILTER (WHERE cap > lvl * w), 1e308) AS level FROM s3),
p AS (SELECT source, ssize, least(cap, level * w) AS target FROM s3, lv),
q AS (SELECT *, CASE WHEN ssize > 0 THEN least(floor(target / ssize), 2)::BIGINT ELSE 0 END AS whole FROM p),
r AS (SELECT *, CASE WHEN whole < 2 THEN target - whole * ssize ELSE 0 END AS rest FROM q),
k AS (SELECT source, key, sum(size) AS ks FROM d GROUP BY source, key),
c AS (SELECT source, key, sum(ks) OVER (PARTITION BY source ORDER BY key) AS upto, ks FROM k),
t AS (
  SELECT r.source, c.key, abs(c.upto - r.rest) AS miss FROM c JOIN r ON c.source IS NOT DISTINCT FROM r.source WHERE r.rest > 0
  UNION ALL SELECT source, -1, rest FROM r WHERE rest > 0),
cut AS (SELECT source, min(key) AS cut FROM (SELECT *, min(miss) OVER (PARTITION BY source) AS best FROM t) WHERE miss = best GROUP BY source)
SELECT d.doc_id, d.size::BIGINT AS size, r.ssize AS source_size, r.target, (d.size * (r.whole + CASE WHEN d.key <= cut.cut THEN 1 ELSE 0 END))::BIGINT AS taken, d.source
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source LEFT JOIN cut ON r.source IS NOT DISTINCT FROM cut.source
"""

OP3 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
win AS (SELECT rid, p, array_to_string(ws[p:p + 4], ' ') AS w FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS p FROM d)),
twice AS (SELECT rid, p, count(*) OVER (PARTITION BY rid, w) AS c FROM win),
rep AS (SELECT rid, count(DISTINCT p + j) AS n FROM (SELECT rid, p, unnest(range(0, 5)) AS j FROM twice WHERE c > 1) GROUP BY rid),
lines AS (SELECT rid, l FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '{WORD}')),
ln AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT l) AS dup FROM lines GROUP BY rid),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines,
         coalesce(n_lines, 0) AS n_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
         length(regexp_replace(t, '[^A-Za-z\x{{C0}}-\x{{10FFFF}}]', '', 'g')) AS n_letters
  FROM d LEFT JOIN rep USING (rid) LEFT JOIN ln USING (rid)),
b AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END) + (CASE WHEN n_lines > 0 AND 10 * n_dup_lines > 3 * n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 12 * n_words) THEN 16 ELSE 0 END)
    + (CASE WHEN n_words > 0 AND 2 * n_letters < word_chars THEN 32 ELSE 0 END) AS fail_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & 3 != 0 AS base_failed,
       fail_bits & 23 = 0 AS kept, fail_bits::BIGINT AS fail_bits, fail_bits = 0 AS keep_v2, sole_rule,
       CASE WHEN sole_rule IS NOT NULL THEN count(*) OVER (PARTITION BY sole_rule) END AS n_sole
FROM (SELECT *, CASE fail_bits WHEN 1 THEN 'few_words' WHEN 2 THEN 'repeated_words' WHEN 4 THEN 'symbols' WHEN 8 THEN 'duplicate_lines'
                     WHEN 16 THEN 'word_length' WHEN 32 THEN 'few_letters' END AS sole_rule FROM b)
"""

_BENCH_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP7 = rf"""
WITH az AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS u, 'abcdefghijklmnopqrstuvwxyz' AS l),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), u, l), '{_BENCH_WORD}') AS ws FROM documents, az),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), u, l), '{_BENCH_WORD}') AS ws FROM benchmark, az),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[p:p + n - 1], ' ') AS win
  FROM (SELECT item_id, ws, least(len(ws), 13) AS n, unnest(range(1, len(ws) - least(len(ws), 13) + 2)) AS p FROM b WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT rid, n, p, array_to_string(ws[p:p + n - 1], ' ') AS win FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM d, lens)),
hit AS (SELECT rid, item_id, n, p FROM dw JOIN bw USING (n, win)),
nh AS (SELECT rid, count(DISTINCT p + j) AS n_hit FROM (SELECT DISTINCT rid, p, unnest(range(0, n)) AS j FROM hit) GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT rid, item_id::VARCHAR AS i FROM hit) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN nh USING (rid) LEFT JOIN it USING (rid)
"""

# Canonical links and refresh redirects to absolute urls (attributes in either order);
# components by recursion over the ties.
OP8 = r"""
WITH RECURSIVE rules(h, p, action) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
tags AS (SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM pages WHERE contains(url, '://')),
tgt AS (
  SELECT url, CASE WHEN regexp_matches(tag, '(?is)rel\s*=\s*["'']canonical') THEN regexp_extract(tag, '(?is)href\s*=\s*["'']([^"'']*)', 1)
    WHEN regexp_matches(tag, '(?is)http-equiv\s*=\s*["'']refresh') THEN regexp_extract(tag, '(?is)url\s*=\s*([^"'']*)', 1) END AS t FROM tags),
tie AS (SELECT DISTINCT regexp_replace(url, '(?s)#.*$', '') AS a, regexp_replace(t, '(?s)#.*$', '') AS b FROM tgt WHERE t <> '' AND contains(t, '://')),
sym AS (SELECT a, b FROM tie UNION SELECT b, a FROM tie),
reach AS (SELECT a, b FROM sym UNION SELECT r.a, o.b FROM reach r JOIN sym o ON r.b = o.a),
urls AS (SELECT DISTINCT url FROM pages WHERE url IS NOT NULL UNION SELECT a FROM sym),
parts AS (
  SELECT url, regexp_replace(url, '(?s)#.*$', '') AS node,
    translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM urls),
fit AS (
  SELECT url, r.h || r.p AS rule, action, row_number() OVER (PARTITION BY url ORDER BY length(r.h || r.p) DESC) AS rk
  FROM parts JOIN rules r ON (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.p)),
best AS (SELECT parts.*, rule, action FROM parts LEFT JOIN (SELECT * FROM fit WHERE rk = 1) USING (url)),
seen AS (SELECT x.url, max((y.action = 'block')::INT) AS blocks, max((y.action = 'allow')::INT) AS allows
  FROM best x JOIN reach r ON x.node = r.a JOIN best y ON y.node = r.b WHERE y.action IS NOT NULL GROUP BY x.url)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
  coalesce(action, CASE WHEN coalesce(blocks, 0) = 1 AND coalesce(allows, 0) = 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM pages LEFT JOIN best USING (url) LEFT JOIN seen USING (url)
"""

# crc32 by its table of 256 values, over the bytes of a hexadecimal text ``h``
_CRC_TABLE = """crc AS MATERIALIZED (
  SELECT list(v ORDER BY b) AS t
  FROM (SELECT b, list_reduce(list_prepend(b, range(8)), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(b)))"""


def _crc32(hexadecimal: str) -> str:
    codes = f"list_transform(regexp_extract_all({hexadecimal}, '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {codes}), lambda a, b: xor(crc.t[1 + (xor(a, b) & 255)], a >> 8)))"


_STATES = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}
_NO = "{'c': 1000000000::BIGINT, 'a': ''}"


def _label(state: int, cost: str, edit: str) -> str:
    return f"{{'c': s{state}.c + {cost}, 'a': s{state}.a || '{edit}'}}"


def _op11_step(to: int) -> str:
    """Best label of a state after one more row: the row deleted, kept or reroled."""
    ways = [_label(to, "3", "D")]
    for state, (role, onward) in _STATES.items():
        if onward == to:
            ways.append(f"CASE WHEN NOT r.forced THEN {_label(state, '2 + r.late', 'R')} ELSE {_NO} END")
            ways.append(f"CASE WHEN NOT r.forced AND r.initial = '{role}' THEN {_label(state, 'r.late', 'K')} ELSE {_NO} END")
    if to == 1:
        ways.append(f"CASE WHEN NOT r.forced AND r.initial = 's' THEN {_label(0, 'r.late', 'K')} ELSE {_NO} END")
    return f"list_min([{', '.join(ways)}])"


def _op11_inserts(t: str) -> str:
    """The four labels with up to two rows inserted."""
    def more(state: int, cost: int) -> str:
        return f"{{'c': {t}{state}.c + {cost}, 'a': {t}{state}.a || '{'I' * (cost // 2)}'}}"

    return (
        f"{t}0 AS s0, {t}1 AS s1, list_min([{t}2, {more(0, 2)}, {more(1, 2)}, {more(3, 2)}]) AS s2, "
        f"list_min([{t}3, {more(2, 2)}, {more(0, 4)}, {more(1, 4)}]) AS s3"
    )


def _op11_text() -> str:
    """The rows of an audit, folded over its letters: st is the state, at the row."""
    role = "CASE WHEN z.st = 2 THEN 'assistant' ELSE 'user' END"
    onward = "CASE WHEN z.st = 2 THEN 3 ELSE 2 END"
    return f"""list_reduce(list_prepend({{'st': 0, 'at': 1, 'e': '', 'out': []::VARCHAR[]}}, list_transform(string_split(audit, ''), lambda e: {{'st': 0, 'at': 0, 'e': e, 'out': []::VARCHAR[]}})),
      lambda z, y: {{'st': CASE WHEN y.e IN ('', 'D') THEN z.st WHEN y.e = 'K' AND z.st = 0 AND starts_with(said[z.at], 's') THEN 1 ELSE {onward} END,
                    'at': z.at + CASE WHEN y.e IN ('K', 'R', 'D') THEN 1 ELSE 0 END, 'e': '',
                    'out': CASE y.e WHEN 'K' THEN list_append(z.out, said[z.at] || ':' || wrote[z.at]) WHEN 'R' THEN list_append(z.out, {role} || ':' || wrote[z.at]) WHEN 'I' THEN list_append(z.out, {role} || ':') ELSE z.out END}})"""


_SP = r"\x20\x09-\x0D"

OP11 = rf"""
WITH RECURSIVE {_CRC_TABLE},
raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS h FROM conversations),
hit AS (SELECT raw.*, {_crc32('h')} % 20 AS k FROM raw, crc),
dam AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, c
  FROM (SELECT *, unnest(CASE WHEN k = 3 THEN [1, 2] ELSE [1] END) AS c FROM hit WHERE k != 0)),
num AS (
  SELECT *, row_number() OVER w AS i, substr(role, 1, 1) AS initial, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, c) AS nth,
         lag(substr(role, 1, 1)) OVER w AS before
  FROM dam WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), c)),
flt AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^{_SP}]') THEN 'b' WHEN nth > 1 THEN 'd' WHEN regexp_matches(text, '[^{_SP}.!?][{_SP}]*\z') THEN 't' ELSE '' END AS f FROM num),
r AS (SELECT *, f IN ('b', 'd') AS forced, CASE WHEN f = 't' THEN 1 ELSE 0 END AS late FROM flt),
agg AS (
  SELECT conv_id, CASE WHEN count(turn) > 0 THEN max(turn) - min(turn) + 1 - count(DISTINCT turn) ELSE 0 END AS gaps, sum((f = 'b')::INT) AS blank, sum((f = 'd')::INT) AS duplicate,
         sum((f = 't')::INT) AS truncated, sum((before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au'))::INT) AS illegal,
         list(role ORDER BY i) AS said, list(text ORDER BY i) AS wrote, count(*) AS n
  FROM r GROUP BY conv_id),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, {_op11_inserts('z.t')} FROM agg, (SELECT {{'c': 0::BIGINT, 'a': ''}} AS t0, {_NO} AS t1, {_NO} AS t2, {_NO} AS t3) z
  UNION ALL
  SELECT conv_id, i, {_op11_inserts('t')}
  FROM (SELECT w.conv_id, r.i, {', '.join(f'{_op11_step(s)} AS t{s}' for s in range(4))} FROM walk w JOIN r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = w.i + 1)),
won AS (SELECT agg.*, list_min([s0, s3]) AS best FROM agg JOIN walk ON agg.conv_id IS NOT DISTINCT FROM walk.conv_id AND agg.n = walk.i),
res AS (SELECT *, best.a AS audit, best.c AS cost FROM won),
txt AS (SELECT *, array_to_string(({_op11_text()}).out, chr(10)) AS t FROM res)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN txt ON o.conv_id IS NOT DISTINCT FROM txt.conv_id
"""

OP12 = f"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size, {_crc32("hex(encode(coalesce(text, '')))")} AS text_crc32, md5(coalesce(text, '')) AS th, coalesce('=' || doc_id::VARCHAR, '') AS id FROM documents, crc),
o AS (SELECT *, sum(size) OVER (ORDER BY th, id ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total, row_number() OVER (ORDER BY th, id) AS nth FROM d),
p AS (SELECT *, least((24 * (2 * upto - size)) // (2 * total), 23)::INT AS shard FROM o)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard, (nth - min(nth) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INT AS grown_shard FROM p
"""

OP13 = rf"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
g AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL),
h AS (SELECT run, n, {_crc32("hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run))")} AS h FROM g, crc),
cut AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
w AS (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
lost AS (SELECT word, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM w)),
near AS (
  SELECT a.word AS x, b.word AS y FROM lost a JOIN lost b ON a.rest = b.rest AND a.p = b.p AND a.word != b.word
  UNION SELECT w.word, lost.word FROM w JOIN lost ON w.word = lost.rest
  UNION SELECT lost.word, w.word FROM w JOIN lost ON w.word = lost.rest),
best AS (SELECT x, count(*) AS n_near, arg_min(y, (-b.n, y)) AS y, max(b.n) AS y_n FROM near JOIN w b ON near.y = b.word GROUP BY x),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN y_n >= 5 * w.n THEN y END AS form, CASE WHEN y_n >= 5 * w.n THEN y_n END AS form_n FROM w LEFT JOIN best ON w.word = best.x),
way AS (
  SELECT word, word AS at FROM f
  UNION ALL SELECT way.word, f.form FROM way JOIN f ON way.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, way.at AS root, f.n, f.n_near::BIGINT AS n_near, f.form_n
FROM f JOIN way ON f.word = way.word JOIN f last ON way.at = last.word AND last.form IS NULL
"""

ORACLES = {"op8_url_filter": OP8, "op7_decontaminate": OP7, "op2_mixing": OP2, "op3_quality_rules": OP3, "op11_repair": OP11, "op12_sharding": OP12, "op13_spelling": OP13}
