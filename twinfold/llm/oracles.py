"""The queries of this package that SQL can express, for DuckDB on the same tables."""

from __future__ import annotations

from twinfold.llm.quality_rules import BINS, CHI2_SHARE, FLOOR, IQR, P
from twinfold.llm.secret_scan import ACCESS, ASSIGN, RUN

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TOKENS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH dw AS (SELECT doc_id, {_TOKENS} AS w FROM documents),
bw AS (SELECT item_id::varchar AS item_id, {_TOKENS} AS w FROM benchmark),
bk AS (SELECT item_id, w, least(13, len(w)) AS k FROM bw WHERE len(w) > 0),
b AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS win FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM bk)),
d AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS win FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, (SELECT DISTINCT k FROM b) WHERE len(w) >= k)),
hit AS (SELECT doc_id, i, k, item_id FROM d JOIN b USING (k, win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM hit GROUP BY doc_id)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
twice AS (SELECT win FROM win GROUP BY win HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM win SEMI JOIN twice USING (win)),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS kept FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)"""

JACCARD_JOIN = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (SELECT a.doc_id AS i, b.doc_id AS j, count(*) AS shared FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT i, j FROM pair JOIN n x ON x.doc_id = i JOIN n y ON y.doc_id = j WHERE 100 * shared >= 90 * (x.n + y.n - shared)),
mirrored AS (SELECT i, j FROM link UNION SELECT j, i FROM link),
reach AS (SELECT i AS node, i AS label FROM mirrored UNION SELECT m.j, r.label FROM reach r JOIN mirrored m ON m.i = r.node WHERE r.label < m.j),
comp AS (SELECT node, min(label) AS label FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(label, d.doc_id) AS component_id FROM d LEFT JOIN n USING (doc_id) LEFT JOIN comp ON node = d.doc_id"""

# The CRC-32 of ASCII texts: the table of its 256 steps, and a fold over characters.
_CRC_TABLE = "crc AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n) ORDER BY n) AS step FROM range(256) t(n))"


def _crc(text: str) -> str:
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::bigint)"
    return f"xor(4294967295, list_reduce({codes}, lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1]), 4294967295::bigint))"


#: The least edits row by row: of all ways to a state, the cheapest and of those the one with the least letters.
CONVERSATION_REPAIR = rf"""
WITH RECURSIVE {_CRC_TABLE},
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') AS said FROM conversations),
coded AS (SELECT conv_id, turn, role, text, {_crc("said")} % 20 AS code FROM named, crc),
hit AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
               CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM coded),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k, rtrim(text, E' \t\n\x0b\f\r') AS shown FROM hit),
f AS (SELECT *, left(role, 1) AS c, CASE WHEN shown = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'd' WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '.' END AS fault FROM r),
pre(s, ins, s1, said, more) AS (VALUES (0, 0, 0, '', 0), (0, 1, 2, 'user:' || chr(10), 5), (0, 2, 3, 'user:' || chr(10) || 'assistant:' || chr(10), 10), (1, 0, 1, '', 0), (1, 1, 2, 'user:' || chr(10), 5),
  (1, 2, 3, 'user:' || chr(10) || 'assistant:' || chr(10), 10), (2, 0, 2, '', 0), (2, 1, 3, 'assistant:' || chr(10), 5), (3, 0, 3, '', 0), (3, 1, 2, 'user:' || chr(10), 5)),
op(edit, c, s1, s2, price) AS (SELECT * FROM (VALUES ('K', 's', 0, 1, 0), ('K', 'u', 0, 2, 0), ('K', 'u', 1, 2, 0), ('K', 'u', 3, 2, 0), ('K', 'a', 2, 3, 0)) UNION ALL SELECT 'R', NULL, s, CASE s WHEN 2 THEN 3 ELSE 2 END, 1 FROM range(4) t(s) UNION ALL SELECT 'D', NULL, s, s, 2 FROM range(4) t(s)),
dp AS (
  SELECT DISTINCT conv_id, 0::bigint AS k, 0 AS s, 0 AS cost, '' AS audit, '' AS said FROM f
  UNION ALL
  SELECT conv_id, k, s, cost, audit, said FROM (
    SELECT dp.conv_id, f.k, op.s2 AS s, dp.cost + pre.more + op.price + CASE WHEN op.edit <> 'D' AND f.fault = 't' THEN 5 ELSE 0 END AS cost, dp.audit || repeat('I', pre.ins) || op.edit AS audit,
           dp.said || pre.said || CASE op.edit WHEN 'K' THEN f.role || ':' || f.text || chr(10) WHEN 'R' THEN CASE pre.s1 WHEN 2 THEN 'assistant:' ELSE 'user:' END || f.text || chr(10) ELSE '' END AS said
    FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.k = dp.k + 1 JOIN pre ON pre.s = dp.s JOIN op ON op.s1 = pre.s1 AND (op.edit = 'D' OR f.fault NOT IN ('b', 'd')) AND (op.c IS NULL OR op.c = f.c))
  QUALIFY row_number() OVER (PARTITION BY conv_id, k, s ORDER BY cost, audit) = 1),
ended AS (SELECT dp.conv_id, cost + CASE s WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END AS cost, audit || CASE s WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END AS audit,
                 said || CASE s WHEN 1 THEN 'user:' || chr(10) || 'assistant:' || chr(10) WHEN 2 THEN 'assistant:' || chr(10) ELSE '' END AS said
          FROM dp JOIN (SELECT conv_id, max(k) AS k FROM f GROUP BY conv_id) n ON n.conv_id IS NOT DISTINCT FROM dp.conv_id AND n.k = dp.k),
best AS (SELECT * FROM ended QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1),
next AS (SELECT *, c || lead(c) OVER (PARTITION BY conv_id ORDER BY k) AS pair FROM f),
n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM next GROUP BY conv_id),
c AS (SELECT DISTINCT conv_id FROM conversations)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(cost, 0)::bigint AS cost, coalesce(audit, '') AS audit, sha256(left(coalesce(said, ''), greatest(length(coalesce(said, '')) - 1, 0))) AS repaired_sha256
FROM c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id"""

#: Stretches of equal five-word sequences at one distance q are runs, the least q of a stretch its period.
PERIODIC_RUNS = rf"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, {_WORDS} AS w, {_crc("doc_id::varchar")} AS h FROM documents, crc),
g AS (SELECT doc_id, w, len(w) AS n, h, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
p AS (SELECT doc_id, w, n, a, h % 10 = 0 AND n > 0 AS hit, 1 + (n - a) // (3 + g % 8) AS p FROM g),
x AS (SELECT doc_id, CASE WHEN hit THEN list_transform(range(0, n), lambda i: w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) ELSE w END AS w FROM p),
gram AS (SELECT doc_id, n, i, array_to_string(w[i + 1:i + 5], ' ') AS gram FROM (SELECT doc_id, w, len(w) AS n, unnest(range(0, len(w) - 4)) AS i FROM x WHERE len(w) >= 6)),
pair AS (SELECT a.doc_id, a.i, b.i - a.i AS q FROM gram a JOIN gram b ON a.doc_id = b.doc_id AND a.gram = b.gram AND a.i < b.i AND 4 * (b.i - a.i) <= a.n),
island AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM pair),
stretch AS (SELECT doc_id, q, min(i) AS s, max(i) - min(i) + 5 + q AS len FROM island GROUP BY doc_id, q, k),
run AS (SELECT doc_id, s, len, min(q) AS q FROM stretch WHERE len >= greatest(6, 4 * q) GROUP BY doc_id, s, len),
best AS (SELECT doc_id, s, len, q FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY len::double / q DESC, s, q) = 1),
said AS (SELECT doc_id, count(*) AS n, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS said FROM run GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM run),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(0, len(w))) AS i FROM x),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS kept FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_runs, s AS start, len::bigint AS length, q::bigint AS period, (1000 * len // q)::bigint AS exponent_milli,
       sha256(coalesce(said, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM x LEFT JOIN best USING (doc_id) LEFT JOIN said USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def _spans(rank: int, pattern: str, group: int, condition: str) -> str:
    p = "'" + pattern.replace("'", "''") + "'"
    found = f"SELECT doc_id, source, regexp_extract_all(t, {p}) AS m, regexp_extract_all(t, {p}, {group}) AS g, list_transform(string_split_regex(t, {p}), lambda x: length(x)) AS b FROM t"
    each = f"SELECT doc_id, source, g[i] AS v, list_sum(b[1:i])::bigint + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)::bigint AS s, length(m[i]) AS n FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM ({found}))"
    return f"SELECT doc_id, source, {rank} AS rank, s AS start, s + n AS stop, v FROM ({each}) WHERE {condition}"


def _said(condition: str) -> str:
    name = "CASE rank WHEN 0 THEN 'assign' WHEN 1 THEN 'access' WHEN 2 THEN 'hex' ELSE 'live' END"
    return f"coalesce(string_agg({name} || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (WHERE {condition}), '')"


SECRET_SCAN = f"""
WITH t AS (SELECT doc_id, coalesce(source, '?') AS source, coalesce(text, '') AS t FROM documents),
span AS ({_spans(0, ASSIGN, 2, "length(v) >= 6")}
UNION ALL {_spans(1, ACCESS, 0, "length(v) >= 20")}
UNION ALL {_spans(2, "[0-9a-f]+", 0, "length(v) >= 24")}
UNION ALL {_spans(3, RUN, 0, "regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')")}),
own AS (SELECT v, count(DISTINCT source) < 3 AND count(DISTINCT doc_id) < 20 AS live FROM span GROUP BY v),
kept AS (SELECT doc_id, rank, start, stop, live FROM span x JOIN own USING (v) WHERE rank < 3
UNION ALL SELECT doc_id, rank, start, stop, live FROM span x JOIN own USING (v) WHERE rank = 3 AND live AND list_unique(string_split(v, '')) >= 10
  AND NOT EXISTS (SELECT 1 FROM span y WHERE y.doc_id = x.doc_id AND y.rank < 3 AND y.start < x.stop AND x.start < y.stop))
SELECT t.doc_id, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access, count(*) FILTER (WHERE rank = 2) AS n_hex,
       sha256({_said("rank < 3")}) AS base_sha256, {_said("rank IS NOT NULL")} AS spans,
       count(*) FILTER (WHERE rank < 3 AND live) AS n_live, count(*) FILTER (WHERE rank < 3 AND NOT live) AS n_copied
FROM t LEFT JOIN kept USING (doc_id) GROUP BY t.doc_id"""


def _quality_rules(share: float = 0.75, steps: int = 4, least: int = 100, cut: float = 30.0) -> str:
    """The base rules, and the concentration steps one common table expression after the other."""
    dims, pairs = range(P), [(i, j) for i in range(P) for j in range(i + 1)]
    z = ["ln(1 + n_words)", "ln((1 + word_chars) / greatest(n_words, 1))", "sqrt(n_symbols / greatest(word_chars, 1))", "sqrt(n_dup_lines / greatest(n_lines, 1))", "sqrt(n_repeat_words / greatest(n_words, 1))"]
    out = [
        f"d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t, {_WORDS} AS w FROM documents)",
        "line AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS x FROM d)",
        "win AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8))",
        "again AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS c FROM win) WHERE c > 1) GROUP BY doc_id)",
        "s AS (SELECT doc_id, lang, source, len(w)::bigint AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::bigint AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint AS n_symbols, (len(x) - len(list_distinct(x)))::bigint AS n_dup_lines, coalesce(n, 0)::bigint AS n_repeat_words, len(x)::bigint AS n_lines FROM d JOIN line USING (doc_id) LEFT JOIN again USING (doc_id))",
        "b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s)",
        f"part AS (SELECT lang, source, CASE WHEN count(*) >= {least} THEN source ELSE 'rest of ' || lang END AS part FROM b WHERE NOT base_failed GROUP BY lang, source)",
        f"v AS (SELECT b.*, part, {', '.join(f'{e} AS z{i}' for i, e in enumerate(z))} FROM b LEFT JOIN part USING (lang, source))",
        "p AS (SELECT * FROM v WHERE NOT base_failed)",
        f"q AS (SELECT lang, part, {', '.join(f'quantile_disc(z{i}, [0.25, 0.5, 0.75]) AS q{i}' for i in dims)} FROM p GROUP BY lang, part)",
        f"e0 AS (SELECT lang, part, start, {', '.join(f'q{i}[2] AS m{i}' for i in dims)}, {', '.join(f'sqrt(CASE WHEN start = 0 THEN {FLOOR[i]!r}::double ELSE greatest(pow((q{i}[3] - q{i}[1]) / {IQR}, 2), {FLOOR[i]!r}::double) END) AS l{i}{j}' if i == j else f'0.0::double AS l{i}{j}' for i, j in pairs)} FROM q, (VALUES (0), (1)) starts (start))",
    ]
    y = [f"(z{i} - m{i}" + "".join(f" - l{i}{j} * y{j}" for j in range(i)) + f") / l{i}{i} AS y{i}" for i in dims]
    distance = f"{', '.join(y)}, {' + '.join(f'y{i} * y{i}' for i in dims)} AS dist"
    for k in range(steps + 1):
        out += [
            f"d{k} AS (SELECT *, floor(log2(dist + 1e-9) * {BINS})::int AS bin FROM (SELECT lang, part, start, {', '.join(f'z{i}' for i in dims)}, {distance} FROM p JOIN e{k} USING (lang, part)))",
            f"n{k} AS (SELECT lang, part, start, bin, sum(count(*)) OVER (PARTITION BY lang, part, start) AS total, sum(count(*)) OVER (PARTITION BY lang, part, start ORDER BY bin) - count(*) AS below FROM d{k} GROUP BY lang, part, start, bin)",
            f"t{k} AS (SELECT lang, part, start, max(bin) AS bin, max(total) AS total FROM n{k} WHERE below < ceil({share} * total) GROUP BY lang, part, start)",
        ]
        if k < steps:
            floors = ", ".join(f"greatest(avg(z{i} * z{i}) - avg(z{i}) * avg(z{i}), 0) + {FLOOR[i]} AS c{i}{i}" if i == j else f"avg(z{i} * z{j}) - avg(z{i}) * avg(z{j}) AS c{i}{j}" for i, j in pairs)
            lower = []
            for j in dims:
                lower.append(f"sqrt(greatest(c{j}{j}" + "".join(f" - l{j}{q} * l{j}{q}" for q in range(j)) + f", 1e-6)) AS l{j}{j}")
                lower += [f"(c{i}{j}" + "".join(f" - l{i}{q} * l{j}{q}" for q in range(j)) + f") / l{j}{j} AS l{i}{j}" for i in range(j + 1, P)]
            out += [
                f"c{k} AS (SELECT lang, part, start, {', '.join(f'avg(z{i}) AS m{i}' for i in dims)}, {floors} FROM d{k} JOIN t{k} USING (lang, part, start) WHERE d{k}.bin <= t{k}.bin GROUP BY lang, part, start)",
                f"e{k + 1} AS (SELECT lang, part, start, {', '.join(f'm{i}' for i in dims)}, {', '.join(lower)} FROM c{k})",
            ]
    out.append(f"best AS (SELECT * FROM e{steps} JOIN t{steps} USING (lang, part, start) QUALIFY row_number() OVER (PARTITION BY lang, part ORDER BY round({' + '.join(f'ln(l{i}{i})' for i in dims)}, 9), start) = 1)")
    out.append(f"far AS (SELECT doc_id, dist / greatest(pow(2.0, (bin + 1) / {BINS}.0) / {CHI2_SHARE}, 1) AS far FROM (SELECT doc_id, lang, part, bin, total, {distance} FROM p JOIN best USING (lang, part)) WHERE total >= {least})")
    return "WITH " + ",\n".join(out) + f"\nSELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(far, 0) <= {cut} AS kept FROM b LEFT JOIN far USING (doc_id)"


QUALITY_RULES = _quality_rules()
