"""DuckDB SQL with the results of those queries that SQL can express.

Not expressible: trained classifiers (op1, op2), tokenized packing (op8), flow and seeded selection (op10).
"""

from __future__ import annotations

from gaugeline.llm import disclosure, fingerprints

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"
_SPACE = r"[\x20\x09-\x0D]+"

_CHAT = r"""
WITH said AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), c AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM said
), marked AS (
  SELECT *, 23 + 2 * (length(r) + length(t)) - length(translate(r, '\<[', '')) - length(translate(t, '\<[', '')) AS chars FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t)) AS turns_sha256,
  CAST(coalesce(sum(length(t)) FILTER (WHERE r = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn, r, t) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

_JACCARD = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) >= 5 THEN list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS sh FROM w
), e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (SELECT a, b FROM shared WHERE 100 * c >= 75 * (na + nb - c)),
reached AS (
  SELECT doc_id, doc_id AS c FROM s
  UNION SELECT l.b, r.c FROM reached r JOIN links l ON l.a = r.doc_id
)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, min(r.c) AS component_id
FROM s JOIN reached r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.sh
"""

_EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0
    AND len(list_filter(embedding, lambda y: y <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.93
), reached AS (
  SELECT vec_id, vec_id AS c FROM embeddings
  UNION SELECT l.b, r.c FROM reached r JOIN links l ON l.a = r.vec_id
), least AS (SELECT vec_id, min(c) AS component_id FROM reached GROUP BY vec_id),
many AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT l.vec_id, coalesce(n, 0) AS n_links, component_id, l.vec_id = component_id AS kept
FROM least l LEFT JOIN many ON a = l.vec_id
"""

_CHANCE = "CASE k " + " ".join(f"WHEN {k} THEN {c}" for k, c in enumerate(fingerprints.SUBSETS)) + " END"
_DASH = "-" * fingerprints.DIGITS
_TERMS = rf"list_distinct(list_filter(string_split_regex(lower({{}}), '{_SPACE}'), lambda x: x <> ''))"

_PRINTS = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id) AS rn, count(*) OVER () AS n FROM documents),
e AS (
  SELECT a.doc_id, b.doc_id AS next_id, a.t, length(a.t) AS n_chars,
    substr(a.t, 1, length(a.t) - length(a.t) // 2) || substr(b.t, 1, length(a.t) // 2) AS edited
  FROM d a JOIN d b ON b.rn = a.rn % a.n + 1
), lexicon AS (
  SELECT w FROM (SELECT unnest({_TERMS.format("t")}) AS w FROM d) GROUP BY w
  HAVING count(*) BETWEEN {fingerprints.BAND[0]} * (SELECT count(*) FROM d) AND {fingerprints.BAND[1]} * (SELECT count(*) FROM d)
), subsets AS (
  SELECT w, k FROM lexicon, range({len(fingerprints.SUBSETS)}) r(k)
  WHERE CAST('0x' || substr(md5(k || ':' || w), 1, 2) AS INTEGER) < {_CHANCE}
), v AS (
  SELECT doc_id, 0 AS v, unnest({_TERMS.format("t")}) AS w FROM e
  UNION ALL SELECT doc_id, 1, unnest({_TERMS.format("edited")}) FROM e
), h AS (
  SELECT doc_id, v, k, substr(md5(string_agg(w, ' ' ORDER BY w)), 1, {fingerprints.DIGITS}) AS h FROM v JOIN subsets USING (w) GROUP BY ALL
), slots AS (
  SELECT doc_id, v, k FROM e, range(2) a(v), range({len(fingerprints.SUBSETS)}) b(k)
), f AS (
  SELECT doc_id, v, string_agg(coalesce(h, '{_DASH}'), '' ORDER BY k) AS p, count(h) AS held FROM slots LEFT JOIN h USING (doc_id, v, k) GROUP BY ALL
), prints AS (
  SELECT e.*, CASE WHEN a.held > 0 THEN a.p ELSE '=' || md5(e.t) END AS fp, CASE WHEN b.held > 0 THEN b.p ELSE '=' || md5(e.edited) END AS efp
  FROM e JOIN f a ON a.doc_id = e.doc_id AND a.v = 0 JOIN f b ON b.doc_id = e.doc_id AND b.v = 1
), near AS (
  SELECT p.doc_id, p.fp, o.fp AS other, o.kind FROM prints p JOIN
    (SELECT doc_id, efp AS fp, 0 AS kind FROM prints UNION ALL SELECT q.doc_id, n.fp, 1 FROM prints q JOIN prints n ON n.doc_id = q.next_id) o ON o.doc_id = p.doc_id
), cut AS (
  SELECT doc_id, kind, fp, other, substr(fp, {fingerprints.DIGITS} * k + 1, {fingerprints.DIGITS}) AS x, substr(other, {fingerprints.DIGITS} * k + 1, {fingerprints.DIGITS}) AS y
  FROM near, range({len(fingerprints.SUBSETS)}) r(k)
), likeness AS (
  SELECT doc_id, kind, CASE WHEN fp = other THEN 1.0 WHEN starts_with(fp, '=') OR starts_with(other, '=') THEN 0.0
    ELSE CAST(count(*) FILTER (WHERE x = y AND x <> '{_DASH}') AS DOUBLE) / count(*) FILTER (WHERE x <> '{_DASH}' OR y <> '{_DASH}') END AS l
  FROM cut GROUP BY doc_id, kind, fp, other
)
SELECT p.doc_id, p.n_chars, sha256(p.edited) AS edited_sha256, p.fp AS fingerprint, p.efp AS edited_fingerprint,
  CAST(a.l AS DOUBLE) AS near_edited, CAST(b.l AS DOUBLE) AS near_next
FROM prints p JOIN likeness a ON a.doc_id = p.doc_id AND a.kind = 0 JOIN likeness b ON b.doc_id = p.doc_id AND b.kind = 1
"""


def _fits(host: str, path: str) -> str:
    return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"


_URLS = rf"""
WITH u AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), r AS (
  SELECT *, CASE WHEN {_fits("www.example.com", "/en/")} THEN 'www.example.com/en/' WHEN {_fits("example.com", "/en/")} THEN 'example.com/en/'
    WHEN {_fits("net", "/es/")} THEN 'net/es/' WHEN {_fits("net", "/fr/")} THEN 'net/fr/' WHEN {_fits("com", "/")} THEN 'com/' END AS rule FROM p
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""

_REPEATS = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
win AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS p FROM w),
ranked AS (SELECT doc_id, p, rank() OVER (PARTITION BY array_to_string(ws[p:p + 19], ' ') ORDER BY doc_id, p) AS k FROM win),
gone AS (SELECT doc_id, list(DISTINCT p + i) AS g FROM ranked, range(20) r(i) WHERE k > 1 GROUP BY doc_id),
kept AS (SELECT doc_id, ws, CASE WHEN g IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(g, i)) END AS left_over FROM w LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - len(left_over) AS BIGINT) AS n_removed, sha256(array_to_string(left_over, ' ')) AS kept_sha256
FROM kept
"""

_PHRASES = rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
piece AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM piece),
total AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase FROM w, range(1, 5) r(k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2),
cut AS (
  SELECT c.lang, c.phrase, c.a, j, l.a AS l, r.a AS r, CAST(2000000 AS HUGEINT) * c.a // (CAST(l.a AS HUGEINT) + r.a) AS score
  FROM c, range(1, 4) x(j), f l, f r
  WHERE j < c.k AND l.lang = c.lang AND l.phrase = array_to_string(ws[1:j], ' ') AND r.lang = c.lang AND r.phrase = array_to_string(ws[j + 1:], ' ')
), least AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (
  SELECT c.lang, c.a, array_to_string(ws[i:i + m - 1], ' ') AS phrase FROM c, range(1, 4) s(i), range(2, 4) t(m) WHERE m < k AND i + m - 1 <= k
), covered AS (SELECT lang, phrase, max(a) AS longer FROM inside GROUP BY ALL),
kept AS (SELECT least.* FROM least LEFT JOIN covered USING (lang, phrase) WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < 80 * CAST(a AS HUGEINT)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept QUALIFY rank <= 2000)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN total USING (lang)
"""


def _moves() -> str:
    """(symbol, from, to, cost, edits) for every message: insertions, then its own edit, by the contract's costs."""
    step = {0: (2,), 1: (2,), 2: (3,), 3: (2,)}
    inserted, todo = set(), [(i, i, 0) for i in range(4)]
    while todo:
        i, k, n = todo.pop()
        if n <= 3 and (i, k, n) not in inserted:
            inserted.add((i, k, n))
            todo += [(i, j, n + 1) for j in step[k]]
    lines = []
    for i, k, n in sorted(inserted):
        for kind in "suaxg":
            for truncated in (0, 1):
                ways = [(k, 4, "D")]
                if kind != "g":
                    ways.append((3 if k == 2 else 2, 3 + 3 * truncated, "R"))
                    keep = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((kind, k))
                    ways += [(keep, 3 * truncated, "K")] if keep is not None else []
                lines += [f"('{kind}', {truncated}, {i}, {j}, {3 * n + cost}, '{'I' * n}{edit}')" for j, cost, edit in ways]
    return ", ".join(lines)


_REPAIR = rf"""
WITH RECURSIVE bytes AS (
  SELECT list(list_reduce(range(8), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t FROM range(256) r(i)
), keyed AS (
  SELECT *, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS key FROM conversations
), said AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(key, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS harm FROM keyed, bytes
), harmed AS (
  SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
    CASE harm WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text FROM said, range(2) c(k) WHERE harm <> 0 AND (k = 0 OR harm = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM harmed
), faults AS (
  SELECT *, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS k, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM placed
), judged AS (
  SELECT *, CASE WHEN last = '' THEN 'b' WHEN k > 1 THEN 'd' WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM faults
), marked AS (
  SELECT *, CASE WHEN fault IN ('b', 'd') THEN 'g' WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS kind, CASE WHEN fault = 't' THEN 1 ELSE 0 END AS cut FROM judged
), moves(kind, cut, f, t, cost, edits) AS (VALUES {_moves()}),
dp AS (
  SELECT conv_id, 0 AS pos, 0 AS st, '000000000' AS best FROM marked GROUP BY conv_id
  UNION ALL
  SELECT dp.conv_id, dp.pos + 1, m.t, min(lpad(CAST(CAST(left(best, 9) AS INTEGER) + m.cost AS VARCHAR), 9, '0') || substr(best, 10) || m.edits)
  FROM dp JOIN marked r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.pos = dp.pos + 1 JOIN moves m ON m.kind = r.kind AND m.cut = r.cut AND m.f = dp.st
  GROUP BY dp.conv_id, dp.pos + 1, m.t
), sums AS (
  SELECT conv_id, count(*) AS many, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate,
    count(*) FILTER (WHERE fault = 't') AS truncated, count(*) FILTER (WHERE before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id
), done AS (
  SELECT s.conv_id, min(lpad(CAST(CAST(left(best, 9) AS INTEGER) + CASE st WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 0 END AS VARCHAR), 9, '0') || substr(best, 10) || CASE st WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END) AS best
  FROM sums s JOIN dp ON dp.conv_id IS NOT DISTINCT FROM s.conv_id AND dp.pos = s.many GROUP BY s.conv_id
), edit AS (
  SELECT conv_id, i, substr(best, 9 + i, 1) AS e, length(replace(substr(best, 10, i), 'I', '')) AS row_at, length(replace(substr(best, 10, i), 'D', '')) AS out_at
  FROM done, range(1, length(best) - 8) x(i)
), kept AS (
  SELECT e.*, r.role, r.text, max(CASE WHEN e.e = 'K' AND out_at = 1 AND left(r.role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS led
  FROM edit e LEFT JOIN marked r ON e.e <> 'I' AND r.conv_id IS NOT DISTINCT FROM e.conv_id AND r.pos = e.row_at WHERE e.e <> 'D'
), left_over AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (out_at - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY i) AS lines FROM kept GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(CAST(left(best, 9) AS INTEGER), 0) AS BIGINT) AS cost, coalesce(substr(best, 10), '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN left_over l ON l.conv_id IS NOT DISTINCT FROM c.conv_id
"""

def _matches(table: str, column: str, pattern: str, kind: str) -> str:
    """(id, kind, m, s, e) of a pattern's matches: their lengths and those of what lies between them add up to offsets."""
    return rf"""SELECT id, {kind} AS kind, i, m, CAST(sum(length(p)) OVER upto + coalesce(sum(length(m)) OVER before, 0) AS BIGINT) AS s, CAST(sum(length(p)) OVER upto + sum(length(m)) OVER upto AS BIGINT) AS e
  FROM (SELECT id, unnest(ms) AS m, unnest(ps[:len(ms)]) AS p, unnest(range(len(ms))) AS i
    FROM (SELECT id, regexp_extract_all({column}, '{pattern}') AS ms, string_split_regex({column}, '{pattern}') AS ps FROM {table}))
  WINDOW upto AS (PARTITION BY id ORDER BY i ROWS UNBOUNDED PRECEDING), before AS (PARTITION BY id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


# The contract's patterns.
_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
_IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
_CARD = r"[0-9]([\x20-]?[0-9])+"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_DIGITS = "regexp_replace(m, '[ ().+-]', '', 'g')"

_PRIVATE = rf"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t FROM documents),
raw AS ({" UNION ALL ".join(f"({_matches('d', 't', p, str(k))})" for k, p in enumerate((_EMAIL, _IP, _CARD, _PHONE)))}),
spans AS (
  SELECT id, kind, s, e, kind || ':' || CASE WHEN kind < 2 THEN translate(m, '{_UPPER}', '{_LOWER}') ELSE {_DIGITS} END AS entity FROM raw
  WHERE CASE kind WHEN 0 THEN true
    WHEN 1 THEN len(list_filter(string_split(m, '.'), lambda x: CASE WHEN length(ltrim(x, '0')) > 3 THEN true ELSE CAST('0' || ltrim(x, '0') AS INTEGER) > 255 END)) = 0
    WHEN 2 THEN length({_DIGITS}) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i:
      CASE WHEN i % 2 = 1 THEN CAST(substr(reverse({_DIGITS}), i, 1) AS INTEGER)
        ELSE 2 * CAST(substr(reverse({_DIGITS}), i, 1) AS INTEGER) - CASE WHEN CAST(substr(reverse({_DIGITS}), i, 1) AS INTEGER) > 4 THEN 9 ELSE 0 END END)) % 10 = 0
    ELSE length({_DIGITS}) BETWEEN 8 AND 15 END
), low AS (SELECT id, translate(t, '{_UPPER}', '{_LOWER}') AS t FROM d),
w AS (SELECT id, i, m, s, e, CASE WHEN length(m) > {disclosure.BEGINNING} THEN left(m, {disclosure.BEGINNING}) || '*' END AS b FROM ({_matches("low", "t", r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "9")})),
free AS (SELECT * FROM w WHERE NOT EXISTS (FROM spans x WHERE x.id = w.id AND x.s < w.e AND x.e > w.s)),
beside AS (
  SELECT id, entity, i FROM (SELECT x.id, x.entity, w.i, row_number() OVER (PARTITION BY x.id, x.kind, x.s ORDER BY w.i DESC) AS k FROM spans x JOIN w ON w.id = x.id AND w.e <= x.s) WHERE k <= {disclosure.WINDOW}
  UNION SELECT id, entity, i FROM (SELECT x.id, x.entity, w.i, row_number() OVER (PARTITION BY x.id, x.kind, x.s ORDER BY w.i) AS k FROM spans x JOIN w ON w.id = x.id AND w.s >= x.e) WHERE k <= {disclosure.WINDOW}
), near AS (
  SELECT DISTINCT id, entity, m AS term FROM beside JOIN free USING (id, i) UNION SELECT DISTINCT id, entity, b FROM beside JOIN free USING (id, i) WHERE b IS NOT NULL
), entities AS (
  SELECT entity, count(DISTINCT id) AS n FROM spans JOIN d USING (id) GROUP BY entity
  HAVING count(DISTINCT t) >= {disclosure.SUPPORT} AND count(DISTINCT id) <= CAST({disclosure.PUBLIC} AS DOUBLE) * (SELECT count(*) FROM d)
), pairs AS (
  SELECT entity, n, term, CAST(count(*) AS DOUBLE) AS met FROM near JOIN entities USING (entity) JOIN d USING (id) GROUP BY ALL HAVING count(DISTINCT t) >= {disclosure.SUPPORT}
), terms AS (SELECT term, CAST(count(DISTINCT id) AS DOUBLE) AS n FROM (SELECT id, m AS term FROM w UNION SELECT id, b FROM w WHERE b IS NOT NULL) GROUP BY term),
strong AS (
  SELECT DISTINCT term FROM pairs p JOIN terms t USING (term)
  WHERE CAST((SELECT count(*) FROM d) AS DOUBLE) * met * met * met * met >= CAST(p.n AS DOUBLE) * t.n * t.n * t.n * t.n
), hits AS (
  SELECT id, 9 AS kind, s, e, b IS NULL OR b IN (SELECT term FROM strong) AS removed FROM free WHERE m IN (SELECT term FROM strong)
), every AS (SELECT id, kind, s, e, false AS removed FROM spans UNION ALL SELECT * FROM hits),
named AS (SELECT *, CASE kind WHEN 0 THEN 'email' WHEN 1 THEN 'ip' WHEN 2 THEN 'card' WHEN 3 THEN 'phone' ELSE 'term' END || ':' || s || ':' || e AS line FROM every)
SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_email, count(*) FILTER (WHERE kind = 1) AS n_ip, count(*) FILTER (WHERE kind = 2) AS n_card, count(*) FILTER (WHERE kind = 3) AS n_phone,
  sha256(coalesce(string_agg(line, ',' ORDER BY kind, s) FILTER (WHERE kind < 9), '')) AS base_sha256, coalesce(string_agg(line, ',' ORDER BY kind, s), '') AS spans,
  count(*) FILTER (WHERE kind = 9) AS n_term, count(*) FILTER (WHERE removed) AS n_removed
FROM d LEFT JOIN named USING (id) GROUP BY id, doc_id
"""

ORACLES = {
    "op3_chat_formatting": _CHAT,
    "op4_jaccard_join": _JACCARD,
    "op5_embedding_dedup": _EMBEDDINGS,
    "op6_fingerprints": _PRINTS,
    "op7_url_filters": _URLS,
    "op9_substring_dedup": _REPEATS,
    "op11_phrase_mining": _PHRASES,
    "op12_structure_repair": _REPAIR,
    "op13_pii": _PRIVATE,
}
