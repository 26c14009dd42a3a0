"""DuckDB SQL for the queries that SQL can express (the others are tested against brute force)."""

from __future__ import annotations

from .licences import BASE, LOOKUP, SLACK, TEMPLATES, VOTES, words_of

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP1 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS.format(LOWER.format("coalesce(text, '')"))} AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3
    THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w
), n AS (
  SELECT d.doc_id, count(s) AS n FROM documents d LEFT JOIN sh USING (doc_id) GROUP BY d.doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * o >= 90 * (na.n + nb.n - o)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
), deg AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a)
SELECT n.doc_id, n.n AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
FROM n JOIN comp USING (doc_id) LEFT JOIN deg USING (doc_id)
"""

_ASSIGN = (r"((?i:password|passwd|secret|token|api_?key))[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)")


def _kind(no: int, kind: str, pattern: str, group: int, least: int) -> str:
    return f"""
  SELECT doc_id, source, '{kind}' AS kind, {no} AS kind_no, m.v AS v, m.s AS size,
         sum(m.g + m.s) OVER (PARTITION BY doc_id ORDER BY i) AS e, {least} AS least
  FROM (SELECT doc_id, source, unnest(m) AS m, generate_subscripts(m, 1) AS i FROM (
    SELECT doc_id, source, list_transform(range(1, len(ms) + 1),
      lambda k: {{'g': length(gs[k]), 's': length(ms[k]), 'v': vs[k]}}) AS m FROM (
      SELECT doc_id, source, regexp_extract_all(coalesce(text, ''), '{pattern}') AS ms,
             regexp_extract_all(coalesce(text, ''), '{pattern}', {group}) AS vs,
             string_split_regex(coalesce(text, ''), '{pattern}') AS gs FROM documents)))"""


OP3 = f"""
WITH raw AS ({' UNION ALL '.join([_kind(0, 'assign', _ASSIGN, 2, 8), _kind(1, 'access', 'AKIA[A-Z0-9]+', 0, 16),
                                  _kind(2, 'hex', '[0-9a-f]+', 0, 32),
                                  _kind(3, 'token', '[A-Za-z0-9+/_=-]{20,}', 0, 20)])}
), sp AS (
  SELECT doc_id, source, kind, kind_no, v, e - size AS st, e FROM raw WHERE length(v) >= least
    AND (kind <> 'token' OR (regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')))
), clear AS (
  SELECT * FROM sp t WHERE kind <> 'token' OR NOT EXISTS (
    SELECT 1 FROM sp b WHERE b.kind <> 'token' AND b.doc_id = t.doc_id AND b.st < t.e AND b.e > t.st)
), freq AS (
  SELECT v, count(DISTINCT source) AS owners, count(DISTINCT doc_id) AS repos FROM clear GROUP BY v
), kept AS (
  SELECT c.*, owners = 1 AND repos <= 3 AS specific FROM clear c JOIN freq USING (v)
  WHERE kind <> 'token' OR (owners = 1 AND repos <= 3)
), agg AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || st || ':' || e, ',' ORDER BY st, kind_no) FILTER (kind <> 'token') AS base,
    string_agg(kind || ':' || st || ':' || e, ',' ORDER BY st, kind_no) AS spans,
    count(*) FILTER (specific) AS n_specific FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_specific, 0) AS n_specific
FROM documents d LEFT JOIN agg USING (doc_id)
"""

OP4 = f"""
WITH w AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w)
), first AS (SELECT s, min(doc_id) AS d FROM win GROUP BY s
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM win JOIN first USING (s) WHERE d < doc_id
), kept AS (
  SELECT a.doc_id, string_agg(word, ' ' ORDER BY a.i) FILTER (g.i IS NULL) AS t, count(g.i) AS n_removed
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w) a
  LEFT JOIN gone g ON g.doc_id = a.doc_id AND g.i = a.i GROUP BY a.doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)
"""

# The given pages hold no redirects or canonical links; classes of linked urls are tested on small tables.
OP5 = f"""
WITH p AS (
  SELECT page_id, coalesce({LOWER.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")}, '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), r AS (SELECT * FROM (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')) t(h, pre, v)
), m AS (
  SELECT page_id, arg_max(h || pre, length(h || pre)) AS rule, arg_max(v, length(h || pre)) AS v
  FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre) GROUP BY page_id)
SELECT p.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)
"""

_CONTROL = r"([<\[])(\\*)((?:\|im_start\||\|im_end\||/?s)>|<?/?SYS>>|/?INST\])"

OP7 = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(role) + length(regexp_replace(text, '{_CONTROL}', '\1\\\2\3', 'g'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

_ALNUM = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP9 = f"""
WITH d AS (SELECT doc_id, {_ALNUM.format(LOWER.format("coalesce(text, '')"))} AS w FROM documents
), b AS (SELECT item_id, {_ALNUM.format(LOWER.format("coalesce(text, '')"))} AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS s
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM bw))
), hit AS (SELECT dw.doc_id, dw.m, dw.i, item_id FROM dw JOIN bw ON dw.s = bw.s AND dw.m = bw.m
), words AS (
  SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS i FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string; ``tab`` is the column of the CRC table."""
    return f"""xor(4294967295::BIGINT, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)),
      lambda acc, b: xor(acc >> 8, tab[((xor(acc, b) & 255) + 1)::INT])))"""


# The table of the reflected polynomial 0xEDB88320, by its rule.
_CRC_TABLE = """crc AS MATERIALIZED (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS tab)"""


def _hashed(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"


def _merkle_levels(name: str, levels: int = 4) -> str:
    """CTEs over ``{name}0`` (t, i, h): nodes of each level with the digests beside them (a lone node has none)."""
    out = []
    for k in range(levels):
        out.append(f"""{name}s{k} AS MATERIALIZED (SELECT t, i, h, count(*) OVER (PARTITION BY t) AS n,
    coalesce(string_agg(h, '') OVER (PARTITION BY t, i // 16 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER (PARTITION BY t, i // 16 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k})""")
        out.append(f"""{name}{k + 1} AS (SELECT t, i // 16 AS i,
    CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h
  FROM {name}s{k} GROUP BY t, i // 16)""")
    return ", ".join(out)


def _merkle_climb(name: str, tree: str, index: str, start: str, levels: int = 4) -> tuple[str, str, str]:
    """Joins, the concatenated digests, and the digest that ``start`` leads to."""
    joins, digests, at = "", [], start
    for k in range(levels):
        s = f"{name}s{k}"
        joins += f" JOIN {s} ON {s}.t = {tree} AND {s}.i = {index} // {16 ** k}"
        digests.append(f"CASE WHEN {s}.n > 1 THEN {s}.l || {s}.r ELSE '' END")
    return joins, " || ".join(digests), at


def _op12() -> str:
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    leaf = " || ".join(map(_hashed, columns))
    changed = " || ".join(_hashed(c) if c != "text" else _hashed(LOWER.format("text")) for c in columns)
    down, digests, _ = _merkle_climb("a", "w.t", "w.i", "")
    up, more, _ = _merkle_climb("b", "0", "w.j", "")
    steps, x = [], "x0"
    for k, s in enumerate([f"as{k}" for k in range(4)] + [f"bs{k}" for k in range(4)]):
        steps.append(f"f{k} AS MATERIALIZED (SELECT * EXCLUDE (x), CASE WHEN n{k} > 1 THEN sha256(l{k} || x || r{k}) ELSE x END AS x FROM "
                     + ("p" if k == 0 else f"f{k - 1}") + ")")
    sides = ", ".join(f"{s}.n AS n{k}, {s}.l AS l{k}, {s}.r AS r{k}"
                      for k, s in enumerate([f"as{k}" for k in range(4)] + [f"bs{k}" for k in range(4)]))
    return f"""
WITH {_CRC_TABLE}, d AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || source, '') AS src, sha256({leaf}) AS leaf,
    CASE WHEN {_crc32("doc_id::VARCHAR")} % 5 = 0 THEN sha256({changed}) END AS changed FROM documents, crc
), w AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY src) - 1 AS j, dense_rank() OVER (ORDER BY src) - 1 AS t,
    row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d
), a0 AS (SELECT t, i, leaf AS h FROM w), {_merkle_levels("a")},
b0 AS (SELECT 0 AS t, t AS i, h FROM a4), {_merkle_levels("b")},
p AS MATERIALIZED (
  SELECT doc_id, leaf, a4.h AS subroot, b4.h AS root, sha256({digests} || {more}) AS proof_sha256, coalesce(changed, leaf) AS x, {sides}
  FROM w JOIN a4 ON a4.t = w.t JOIN b4 ON true {down}{up}
), {", ".join(steps)}
SELECT doc_id, leaf, subroot, root, proof_sha256, x AS folded_root, x = root AS verified FROM f7
"""


OP12 = _op12()

_BLANKS = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

# States: 0 nothing yet, 1 system, 2 user, 3 assistant. From the last row to the first, one row per
# (conversation, state) with the cheapest edits of what follows; up to two inserts before a row.
OP13 = f"""
WITH RECURSIVE {_CRC_TABLE}, c AS (
  SELECT conv_id, turn, {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS f,
    coalesce(role, ' ') AS role, coalesce(text, ' ') AS text FROM conversations, crc
), k AS (
  SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM c
), m AS (
  SELECT *, rtrim(text, {_BLANKS}) AS bare, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS seen FROM k
), r AS MATERIALIZED (
  SELECT conv_id, turn, role, text, left(role, 1) AS ini,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, seen) AS i,
    count(*) OVER (PARTITION BY conv_id) AS n,
    CASE WHEN bare = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
  FROM m
), stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated FROM r GROUP BY conv_id
), pairs AS (
  SELECT conv_id, count(*) FILTER (p NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT conv_id, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS p FROM r) GROUP BY conv_id
), ins AS (SELECT * FROM (VALUES
  (0, 0, 0, '', []::VARCHAR[]), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
  (0, 2, 5, 'I', ['user:']), (1, 2, 5, 'I', ['user:']), (3, 2, 5, 'I', ['user:']), (2, 3, 5, 'I', ['assistant:']),
  (0, 3, 10, 'II', ['user:', 'assistant:']), (1, 3, 10, 'II', ['user:', 'assistant:']), (3, 3, 10, 'II', ['user:', 'assistant:']),
  (2, 2, 10, 'II', ['assistant:', 'user:'])) t(q, p, w, a, o)
), turns AS (SELECT * FROM (VALUES (0, 2, 'user', 'u'), (1, 2, 'user', 'u'), (3, 2, 'user', 'u'), (2, 3, 'assistant', 'a'),
  (0, 1, 's', 's')) t(q, p, role, ini)
), ops AS MATERIALIZED (
  SELECT conv_id, i, s.q, s.q AS p, 2 AS w, 'D' AS a, []::VARCHAR[] AS o FROM r, (SELECT unnest([0, 1, 2, 3]) AS q) s
  UNION ALL SELECT conv_id, i, q, p, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, 'K', [r.role || ':' || text]
    FROM r JOIN turns USING (ini) WHERE fault IS NULL OR fault = 'truncated'
  UNION ALL SELECT conv_id, i, q, p, CASE WHEN fault = 'truncated' THEN 6 ELSE 1 END, 'R', [turns.role || ':' || text]
    FROM r JOIN turns ON turns.ini <> r.ini AND turns.role <> 's' WHERE fault IS NULL OR fault = 'truncated'
), moves AS MATERIALIZED (
  SELECT conv_id, i, ins.q, ops.p, ins.w + ops.w AS w, ins.a || ops.a AS a, ins.o || ops.o AS o FROM ops JOIN ins ON ins.p = ops.q
), best(conv_id, i, q, e) AS (
  SELECT conv_id, n + 1, q, {{'w': w, 'a': a, 'o': o}} FROM (
    SELECT DISTINCT conv_id, n, ins.q, first(ins.w ORDER BY ins.w, ins.a) OVER z AS w, first(ins.a ORDER BY ins.w, ins.a) OVER z AS a,
      first(ins.o ORDER BY ins.w, ins.a) OVER z AS o
    FROM (SELECT DISTINCT conv_id, n FROM r), ins WHERE ins.p IN (0, 3) WINDOW z AS (PARTITION BY conv_id, ins.q))
  UNION ALL
  SELECT conv_id, i, q, arg_min({{'w': w, 'a': a, 'o': o}}, (w, a)) FROM (
    SELECT b.conv_id, m.i, m.q, m.w + b.e.w AS w, m.a || b.e.a AS a, m.o || b.e.o AS o
    FROM best b JOIN moves m ON m.conv_id IS NOT DISTINCT FROM b.conv_id AND m.i = b.i - 1 AND m.p = b.q) GROUP BY conv_id, i, q
)
SELECT x.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(e.w, 0) AS BIGINT) AS cost, coalesce(e.a, '') AS audit,
  sha256(coalesce(array_to_string(e.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) x
LEFT JOIN stats ON stats.conv_id IS NOT DISTINCT FROM x.conv_id LEFT JOIN pairs ON pairs.conv_id IS NOT DISTINCT FROM x.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM x.conv_id AND best.i = 1 AND best.q = 0
"""


def _op11() -> str:
    words, keys, labels = [], [], []
    for t, (label, text, phrases) in enumerate(TEMPLATES):
        ws = words_of(text)
        labels.append(f"({t}, '{label}', {len(ws)})")
        words += [f"({t}, {i}, '{w}')" for i, w in enumerate(ws)]
        for phrase in phrases:
            ks = words_of(phrase)
            at = next(i for i in range(len(ws)) if ws[i:i + len(ks)] == ks)
            keys.append(f"({t}, {at}, '{' '.join(ks)}', {len(ks)})")
    base = ", ".join(f"('{p}', '{x}', {len(p.split())})" for p, x in BASE)
    return f"""
WITH tpl AS (SELECT * FROM (VALUES {", ".join(labels)}) t(t, label, n)
), tw AS MATERIALIZED (SELECT * FROM (VALUES {", ".join(words)}) t(t, j, word)
), keys AS (SELECT *, row_number() OVER () AS k FROM (VALUES {", ".join(keys)}) t(t, j, phrase, m)
), base AS (SELECT * FROM (VALUES {base}) t(phrase, label, m)
), d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_ALNUM.format(LOWER.format("coalesce(text, '')"))} AS w FROM documents
), dw AS MATERIALIZED (SELECT r, generate_subscripts(w, 1) - 1 AS i, unnest(w) AS word FROM d
), grams AS MATERIALIZED (
  SELECT r, i, m, array_to_string(w[i + 1:i + m], ' ') AS s
  FROM (SELECT r, w, m, unnest(range(0, len(w) - m + 1)) AS i FROM d, (SELECT DISTINCT m FROM (SELECT m FROM keys UNION SELECT m FROM base)))
  WHERE w[i + 1] IN (SELECT split_part(phrase, ' ', 1) FROM keys UNION SELECT split_part(phrase, ' ', 1) FROM base)
), b AS (
  SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list_sort(list_distinct(list(label))) AS labels
  FROM grams JOIN base ON s = phrase AND grams.m = base.m GROUP BY r
), df AS MATERIALIZED (
  SELECT word, count(DISTINCT r) AS df FROM dw WHERE word IN (SELECT word FROM tw) GROUP BY word
), place AS (SELECT k, t, r, i - j AS o FROM grams JOIN keys ON s = phrase AND grams.m = keys.m
), full_key AS (
  SELECT r, t FROM place GROUP BY r, t HAVING count(DISTINCT k) = (SELECT count(*) FROM keys WHERE keys.t = place.t)
), rare AS (
  SELECT r, t, word FROM (SELECT DISTINCT f.r, f.t, tw.word, df FROM full_key f JOIN tw USING (t) JOIN dw ON dw.r = f.r AND dw.word = tw.word
    JOIN df ON df.word = tw.word) QUALIFY row_number() OVER (PARTITION BY r, t ORDER BY df, word) <= {LOOKUP}
), cand AS (
  SELECT r, t, dw.i - tw.j AS o FROM rare JOIN dw USING (r, word) JOIN tw USING (t, word)
  GROUP BY r, t, dw.i - tw.j HAVING count(DISTINCT word) >= {VOTES}
), sure AS (
  SELECT c.r, c.t, c.o FROM cand c JOIN place p ON p.r = c.r AND p.t = c.t AND abs(p.o - c.o) <= {SLACK}
  GROUP BY c.r, c.t, c.o HAVING count(DISTINCT k) = (SELECT count(*) FROM keys WHERE keys.t = c.t)
), score AS (
  SELECT s.r, s.t, s.o, count(*) / any_value(n)::DOUBLE AS score
  FROM sure s JOIN tpl USING (t) JOIN tw USING (t) JOIN dw ON dw.r = s.r AND dw.i = s.o + tw.j AND dw.word = tw.word GROUP BY s.r, s.t, s.o
), best AS (SELECT r, max(score) AS score, list(label) AS labels FROM score JOIN tpl USING (t) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  array_to_string(coalesce(b.labels, []), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(best.labels, [])))), ',') AS labels,
  coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN best USING (r)
"""


OP11 = _op11()

ORACLES = {"op1_ngram_join": OP1, "op3_secret_scan": OP3, "op4_substring_dedup": OP4, "op5_url_filter": OP5,
           "op7_chat_trees": OP7, "op9_decontaminate": OP9, "op11_licence_scan": OP11, "op12_merkle_manifest": OP12,
           "op13_repair_conversations": OP13}
