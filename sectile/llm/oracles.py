"""SQL of the queries that SQL can express, for an independent engine on the same tables.

The others (byte-level BPE, the trained models, near-duplicate classes, library token counts) are held against
brute force, the libraries or held-out rows in tests/llm.
"""

from __future__ import annotations

from .quality_rules import PRIOR, ROUNDS, RULES

TOPK = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v FROM embeddings
 WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

_ESCAPED = r"regexp_replace({0}, '<(\\*)\|', '<\\\1|', 'g')"
_ROLE = _ESCAPED.format(r"replace(replace(role, '\', '\\'), chr(10), '\n')")
CHAT = f"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations UNION ALL SELECT -1, n, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) x(n, r))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256, CAST(coalesce(sum(length(t)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
sha256(coalesce(string_agg(t, '' ORDER BY turn, t) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256, CAST(sum(24 + length({_ROLE}) + length({_ESCAPED.format("t")})) AS BIGINT) AS formatted_chars FROM c GROUP BY conv_id"""

MIXING = """WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(strlen(text), 0) + 1 AS b, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS o FROM documents),
st AS (SELECT *, CAST(coalesce(sum(b) OVER (PARTITION BY source ORDER BY o, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_byte FROM d),
sz AS (SELECT source, greatest(CAST(floor(sqrt(sum(b)) * 1000) AS BIGINT), 1) AS w FROM d GROUP BY 1),
a AS (SELECT source, w, count(*) OVER () AS n, CAST(sum(w) OVER () AS BIGINT) AS total, greatest(1000, 32 * count(*) OVER ()) AS q FROM sz),
b AS (SELECT *, 1 + (w * (q - n)) // total AS whole, (w * (q - n)) % total AS rest FROM a),
c AS (SELECT source, CAST(whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, source) <= q - sum(whole) OVER () THEN 1 ELSE 0 END AS BIGINT) AS share, CAST(q AS BIGINT) AS q FROM b),
i AS (SELECT list({'s': source, 'a': share, 'j': 0::BIGINT} ORDER BY source) AS state, max(q) AS q FROM c),
e AS (SELECT -1::BIGINT AS t, q, state, {'due': 0::BIGINT, 's': ''::VARCHAR, 'k': 0::BIGINT} AS pick FROM i UNION ALL
 SELECT t, q, list_transform(state, lambda x: {'s': x.s, 'a': x.a, 'j': x.j + CASE WHEN x.s = pick.s THEN 1 ELSE 0 END}), pick FROM
 (SELECT t + 1 AS t, q, state, list_sort(list_transform(list_filter(state, lambda x: x.j * q // x.a <= t + 1), lambda x: {'due': ((x.j + 1) * q + x.a - 1) // x.a, 's': x.s, 'k': x.j}))[1] AS pick FROM e WHERE t + 1 < q)),
sl AS (SELECT t, pick.s AS source, pick.k AS k FROM e WHERE t >= 0)
SELECT doc_id, st.source AS source, b AS n_bytes, start_byte, start_byte // 65536 AS block, (start_byte // 65536) * q // share AS release, ((start_byte // 65536 + 1) * q + share - 1) // share AS due,
((start_byte // 65536) // share) * q + t AS slot, share, q AS period FROM st JOIN c ON c.source = st.source JOIN sl ON sl.source = st.source AND sl.k = (start_byte // 65536) % share"""

_SPACE = r"\x20\x09-\x0D"


def _quality() -> str:
    n = len(RULES)

    def share(weight: str, v: str) -> str:
        return f"list_sum(list_transform(z, lambda x: CASE WHEN x.v[r] = {v} THEN x.n * {weight} ELSE 0 END))"

    prior = f"{PRIOR}::DOUBLE * greatest(total, 1)"
    logs = [f"ln(({share(wt, 'v')} + {prior} * CASE WHEN v < 0 THEN {lo}::DOUBLE ELSE {hi}::DOUBLE END) / ({share(wt, '1')} + {share(wt, '-1')} + {prior}))" for wt, lo, hi in (("x.q", "0.02", "0.98"), ("(1 - x.q)", "0.3", "0.7"))]
    lift = f"list_transform(range(1, {n + 1}), lambda r: list_transform([-1, 0, 1], lambda v: CASE WHEN v = 0 THEN 0::DOUBLE ELSE {logs[0]} - {logs[1]} END))"
    sums = "list_sum(list_transform(z, lambda x: x.n)) AS total, list_sum(list_transform(z, lambda x: x.n * x.q)) AS g"
    step = f"SELECT k, p, ln((g + 1) / (total - g + 1)) AS logit, {lift} AS lift FROM (SELECT *, {sums} FROM"
    posterior = f"1 / (1 + exp(-(logit + list_sum(list_transform(range(1, {n + 1}), lambda r: lift[r][{{0}}[r] + 2])))))"
    return f"""WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), w AS (SELECT row_number() OVER () AS id, doc_id, t, regexp_extract_all(t, '[^{_SPACE}]+') AS w, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^{_SPACE}]')) AS l FROM d),
g AS (SELECT id, unnest(range(1, len(w) - 6)) AS i, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS s FROM w WHERE len(w) >= 8),
tw AS (SELECT id, i FROM (SELECT *, count(*) OVER (PARTITION BY id, s) AS c FROM g) WHERE c > 1),
rp AS (SELECT id, CAST(sum(m) AS BIGINT) AS n FROM (SELECT id, least(8, coalesce(lead(i) OVER (PARTITION BY id ORDER BY i) - i, 8)) AS m FROM tw) GROUP BY 1),
ct AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, coalesce(n, 0) AS n_repeat_words, CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
 CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(length(t) - length(regexp_replace(t, '\\p{{Lu}}', '', 'g')) AS BIGINT) AS n_capitals, CAST(length(t) - length(replace(t, '!', '')) AS BIGINT) AS n_shouts, CAST(length(t) - length(regexp_replace(t, '[.?]', '', 'g')) AS BIGINT) AS n_stops FROM w LEFT JOIN rp USING (id)),
vt AS (SELECT *, [{", ".join(RULES.values())}] AS v, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM ct),
ps AS (SELECT list({{'v': v, 'n': n}} ORDER BY v) AS p FROM (SELECT v, count(*)::DOUBLE AS n FROM vt GROUP BY 1)),
em AS ({step} (SELECT 0 AS k, p, list_transform(p, lambda x: {{'v': x.v, 'n': x.n, 'q': CASE WHEN list_min(x.v) < 0 THEN 0.1::DOUBLE ELSE 0.9::DOUBLE END}}) AS z FROM ps)) UNION ALL
 {step} (SELECT k + 1 AS k, p, list_transform(p, lambda x: {{'v': x.v, 'n': x.n, 'q': {posterior.format("x.v")}}}) AS z FROM em WHERE k < {ROUNDS}))),
fit AS (SELECT logit, lift FROM em WHERE k = {ROUNDS}), sc AS (SELECT vt.*, {posterior.format("v")} AS p_good FROM vt, fit)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND p_good >= 0.5 AS kept, round(p_good, 6) AS p_good FROM sc"""


QUALITY = _quality()

SUFFIXES = """WITH d AS (SELECT doc_id, strlen(coalesce(text, '')) AS n, lower(hex(encode(coalesce(text, '')))) AS h FROM documents), g AS (SELECT doc_id, unnest(range(n - 49)) AS i, h FROM d WHERE n >= 50),
w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 100)) AS s FROM g), f AS (SELECT s, min(doc_id) AS least FROM w GROUP BY 1 HAVING count(*) > 1),
r AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM w JOIN f USING (s) WHERE doc_id > least),
q AS (SELECT doc_id, i, sum(CASE WHEN p IS NULL OR i - p > 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS k FROM r),
sp AS (SELECT doc_id, k, min(i) AS a, max(i) + 50 AS b FROM q GROUP BY 1, 2), o AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS from_ FROM sp),
k AS (SELECT doc_id, string_agg(substr(h, 2 * from_ + 1, 2 * (a - from_)), '' ORDER BY a) AS head, max(b) AS tail, CAST(sum(b - a) AS BIGINT) AS removed, count(*) AS spans FROM o JOIN d USING (doc_id) GROUP BY 1)
SELECT doc_id, n AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)"""

#: The pages of the tables mark their article; there it is the text of its blocks.
PAGES = r"""WITH a AS (SELECT page_id, url, regexp_split_to_array(regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's'), '</?(?:p|h1)>') AS h, row_number() OVER () AS k FROM pages),
b AS (SELECT k, unnest(h) AS t, generate_subscripts(h, 1) AS i FROM a),
c AS (SELECT k, i, replace(replace(replace(regexp_replace(replace(t, '<br>', ' '), '<[^>]*>', '', 'g'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>') AS t FROM b),
d AS (SELECT k, i, trim(regexp_replace(regexp_replace(replace(t, '&#39;', chr(39)), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS t FROM c),
e AS (SELECT k, string_agg(t, chr(10) ORDER BY i) AS t FROM d WHERE t <> '' GROUP BY k)
SELECT page_id, url, coalesce(t, '') AS text, CAST(length(coalesce(t, '')) AS BIGINT) AS n_chars FROM a LEFT JOIN e USING (k)"""

_BYTES = "list_transform(range(strlen(k)), lambda i: ord(substr(k, i + 1, 1))::BIGINT)"  # digits, colon, space: a byte each
_CRC = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {_BYTES}), lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::BIGINT)"

_INSERTED = ", ".join("{'q': CASE WHEN q = 2 THEN %s ELSE %s END, 'n': %d}" % (b, a, n) for n, a, b in ((1, 2, 3), (2, 3, 2), (3, 2, 3)))
_FINAL = "CASE WHEN q IN (0, 3) THEN 0 WHEN q = 2 THEN 1 ELSE 2 END"
#: Cheapest edits row by row: of each state of the roles (0 none, 1 s, 2 ends with u, 3 ends with a) the least (cost, letters), with up to three inserts before a row.
REPAIR = rf"""WITH RECURSIVE o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
dm AS (SELECT *, {_CRC} % 20 AS d FROM o), ids AS (SELECT DISTINCT conv_id FROM o),
rw AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN d = 3 THEN [1, 2] ELSE [1] END) AS copy FROM dm WHERE d <> 0),
nu AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM rw),
ft AS (SELECT *, left(role, 1) AS r1, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 3 ELSE 0 END AS f, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS r0 FROM nu),
st AS (SELECT conv_id, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps, count(*) FILTER (WHERE f = 1) AS blank, count(*) FILTER (WHERE f = 2) AS duplicate, count(*) FILTER (WHERE f = 3) AS truncated,
 count(*) FILTER (WHERE r0 || r1 NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM ft GROUP BY 1),
dp AS (SELECT conv_id, 0::BIGINT AS i, 0 AS q, 0::BIGINT AS cost, '' AS audit, ''::VARCHAR AS said FROM st UNION ALL
 SELECT conv_id, i, q, cost, audit, said FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) AS best FROM
  (SELECT conv_id, i, m.q AS q, cost + m.c AS cost, audit || m.l AS audit, said || CASE WHEN m.l = 'D' THEN '' ELSE chr(10) || (CASE WHEN m.l = 'K' THEN role WHEN m.q = 2 THEN 'user' ELSE 'assistant' END) || ':' || text END AS said FROM
   (SELECT x.*, ft.i AS i, ft.role, ft.text, unnest([{{'l': 'D', 'q': x.q, 'c': 2}}, {{'l': 'R', 'q': CASE WHEN f IN (1, 2) THEN NULL WHEN x.q = 2 THEN 3 ELSE 2 END, 'c': 1 + CASE WHEN f = 3 THEN 5 ELSE 0 END}},
    {{'l': 'K', 'q': CASE WHEN f IN (1, 2) THEN NULL WHEN r1 = 's' AND x.q = 0 THEN 1 WHEN r1 = 'u' AND x.q <> 2 THEN 2 WHEN r1 = 'a' AND x.q = 2 THEN 3 END, 'c': CASE WHEN f = 3 THEN 5 ELSE 0 END}}]) AS m FROM
    (SELECT conv_id, pos, p.q AS q, cost + 5 * p.n AS cost, audit || repeat('I', p.n) AS audit, said || CASE WHEN p.n = 0 THEN '' WHEN q = 2 THEN left(chr(10) || 'assistant:' || chr(10) || 'user:' || chr(10) || 'assistant:', [11, 17, 28][p.n]) ELSE left(chr(10) || 'user:' || chr(10) || 'assistant:' || chr(10) || 'user:', [6, 17, 23][p.n]) END AS said FROM
     (SELECT conv_id, i AS pos, q, cost, audit, said, unnest([{{'q': q, 'n': 0}}, {_INSERTED}]) AS p FROM dp)) x
    JOIN ft ON ft.conv_id IS NOT DISTINCT FROM x.conv_id AND ft.i = x.pos + 1) WHERE m.q IS NOT NULL)) WHERE best = 1),
en AS (SELECT dp.conv_id AS conv_id, cost + 5 * {_FINAL} AS cost, audit || repeat('I', {_FINAL}) AS audit, said || CASE WHEN q = 1 THEN chr(10) || 'user:' || chr(10) || 'assistant:' WHEN q = 2 THEN chr(10) || 'assistant:' ELSE '' END AS said FROM dp JOIN st ON st.conv_id IS NOT DISTINCT FROM dp.conv_id AND dp.i = st.n),
bs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) AS best FROM en) WHERE best = 1)
SELECT ids.conv_id AS conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(substr(coalesce(said, ''), 2)) AS repaired_sha256
FROM ids LEFT JOIN st ON st.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN bs ON bs.conv_id IS NOT DISTINCT FROM ids.conv_id"""
