"""DuckDB SQL of the contract queries that SQL can express on whole tables.

Missing: 4, 7, 8, 10 (fitted models; edit distances of all line pairs), 6 (a
tokenizer), 9 (the shuffle's hash is no DuckDB function) and the pipeline. Tests hold those against brute force, round trips or held-out rows.
"""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL: dict[str, str] = {}

SQL["op1_exact_topk"] = """
WITH ints AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, unnest(range(len(vec))) AS at, unnest(vec) AS v FROM ints),
scores AS (
  SELECT q.vec_id AS query_id, x.vec_id, CAST(sum(q.v * x.v) AS BIGINT) AS score
  FROM parts q JOIN parts x ON q.at = x.at AND q.vec_id <> x.vec_id
  WHERE q.vec_id % 100 = 0 GROUP BY ALL)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score
FROM scores QUALIFY rank <= 10"""

SQL["op2_ngram_jaccard_join"] = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS start, doc_id AS goal FROM documents
  UNION SELECT reach.start, sides.b FROM reach JOIN sides ON sides.a = reach.goal)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(goal) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN reach ON reach.start = d.doc_id GROUP BY d.doc_id, n"""

SQL["op3_source_mixture"] = """
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
    CAST('0x' || substr(md5(coalesce(length(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), 't')
      || coalesce(text, '')), 1, 9) AS BIGINT) AS h
  FROM documents),
sources AS (
  SELECT source, sum(size) AS total, 3.0::DOUBLE * sum(size) AS most,
    1.0::DOUBLE + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 AS weight
  FROM sized GROUP BY source),
share AS (
  SELECT *, (sum(total) OVER () - coalesce(sum(most) OVER below, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER below, 0)) AS level
  FROM sources WINDOW below AS (ORDER BY most / weight, weight, total, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, total, CASE WHEN most / weight <= level THEN most
    ELSE weight * (SELECT max(level) FROM share WHERE most / weight > level) END AS target FROM share),
run AS (
  SELECT sized.*, total, target, CASE WHEN total > 0 THEN floor(target / total) ELSE 1 END AS every,
    sum(size) OVER (PARTITION BY sized.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS through,
    sum(size) OVER (PARTITION BY sized.source, h) AS own,
    row_number() OVER (PARTITION BY sized.source, h ORDER BY doc_id) AS nth
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size::BIGINT AS size, total::BIGINT AS source_size, target,
  (size * (every + CASE WHEN (through - own) + (nth - 0.5) * size <= target - every * total THEN 1 ELSE 0 END))::BIGINT AS taken
FROM run"""

SQL["op5_winnowing_decontamination"] = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS m,
    unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2), lambda i: array_to_string(w[i:i + least(13, len(w)) - 1], ' '))) AS s
  FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT m FROM windows),
spans AS (
  SELECT doc_id, m, unnest(range(1, len(w) - m + 2)) AS i,
    unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS s
  FROM d, sizes WHERE len(w) >= m),
hits AS (SELECT doc_id, item_id, i, spans.m FROM spans JOIN windows USING (m, s)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit_words.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(hit_words.n, 0) > 0 AND 20 * hit_words.n >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)"""


_CRC_TABLE = """list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END))"""


def _crc32(table: str, key: str) -> str:
    """CRC-32 of the ASCII string ``key``, with the 256 values of ``_CRC_TABLE`` in ``table``."""
    codes = f"list_transform(range(1, len({key}) + 1), lambda i: ascii(substr({key}, i, 1))::BIGINT)"
    step = f"lambda c, b: xor(c >> 8, {table}[1 + (xor(c, b) & 255)])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), {step}), 4294967295::BIGINT)"


SQL["op11_suffix_family"] = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS raw FROM documents),
windows AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY md5(raw[i + 1:i + 100]) ORDER BY doc_id, i) AS nth
  FROM (SELECT doc_id, raw, unnest(range(0, octet_length(raw) - 99)) AS i FROM d)),
starts AS (
  SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, true) AS fresh FROM windows WHERE nth > 1),
spans AS (
  SELECT doc_id, min(i) AS lo, max(i) + 100 AS hi
  FROM (SELECT *, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM starts) GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, lo AS stop, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS start, hi - lo AS size FROM spans
  UNION ALL
  SELECT doc_id, octet_length(raw), coalesce((SELECT max(hi) FROM spans WHERE spans.doc_id = d.doc_id), 0), NULL FROM d),
kept AS (
  SELECT doc_id, string_agg(hex(raw[start + 1:stop]), '' ORDER BY start) AS bytes, coalesce(sum(size), 0) AS gone, count(size) AS n
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, octet_length(raw)::BIGINT AS n_bytes, gone::BIGINT AS n_removed, n::BIGINT AS n_spans, sha256(unhex(bytes)) AS kept_sha256
FROM kept JOIN d USING (doc_id)"""


def _lightest(*weights: str) -> str:
    return f"list_min([{', '.join(weights)}])"


def _edited(weight: str, cost: str, edit: str, line: str = "''") -> str:
    """Weight {c, a, l} (cost, audit, repaired lines) after one more edit; null stays null."""
    return (f"CASE WHEN {weight} IS NULL THEN NULL ELSE {{'c': {weight}.c + {cost}, 'a': {weight}.a || '{edit}', "
            f"'l': {weight}.l || {line}}} END")


_NL = "chr(10)"
_INSERTED = {
    2: _lightest("s2", *(_edited(s, "2", "I", f"{_NL} || 'user:'") for s in ("s0", "s1", "s3"))),
    3: _lightest("s3", _edited("t2", "2", "I", f"{_NL} || 'assistant:'"))}
_KEPT = f"{_NL} || role || ':' || body"
_ROLE = {2: f"{_NL} || 'user:' || body", 3: f"{_NL} || 'assistant:' || body"}
_BEFORE = {2: ("s0", "s1", "t3"), 3: ("t2",)}


def _after_row(state: int) -> str:
    """The lightest weight in ``state`` after the row (role, body, fault, extra cost) is kept, reroled or deleted."""
    old = {0: "s0", 1: "s1", 2: "t2", 3: "t3"}[state]
    out = [_edited(old, "3", "D")]
    may = lambda when, w: f"CASE WHEN fault NOT IN (1, 2) AND {when} THEN {w} END"
    if state == 1:
        out.append(may("role[1] = 's'", _edited("s0", "extra", "K", _KEPT)))
    for before in _BEFORE.get(state, ()):
        out.append(may(f"role[1] = '{'u' if state == 2 else 'a'}'", _edited(before, "extra", "K", _KEPT)))
        out.append(may("true", _edited(before, "2 + extra", "R", _ROLE[state])))
    return _lightest(*out)


SQL["op12_lightest_derivation"] = f"""
WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS t),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS body,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
marked AS (SELECT keyed.*, {_crc32("t", "key")} % 20 AS kind FROM keyed, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(body, '.!?', '') ELSE body END AS body
  FROM marked WHERE kind <> 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, body ORDER BY turn NULLS FIRST, copy) AS nth,
    trim(body, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM damaged),
rows_ AS (
  SELECT *, CASE WHEN bare = '' THEN 1 WHEN nth > 1 THEN 2 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    CASE WHEN fault = 3 THEN 1 ELSE 0 END AS extra,
    i > 1 AND (lag(role) OVER (PARTITION BY conv_id ORDER BY i))[1] || role[1] NOT IN ('su', 'ua', 'au') AS illegal
  FROM ranked),
totals AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (illegal) AS illegal
  FROM rows_ GROUP BY conv_id),
dp AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 'l': ''}} AS s0, NULL::STRUCT(c INTEGER, a VARCHAR, l VARCHAR) AS s1,
    NULL::STRUCT(c INTEGER, a VARCHAR, l VARCHAR) AS s2, NULL::STRUCT(c INTEGER, a VARCHAR, l VARCHAR) AS s3 FROM totals
  UNION ALL
  SELECT conv_id, i, {", ".join(_after_row(s) for s in range(4))}
  FROM (SELECT *, {_INSERTED[3]} AS t3
        FROM (SELECT dp.conv_id, r.i, s0, s1, s2, s3, role, body, fault, extra, {_INSERTED[2]} AS t2
              FROM dp JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.i = dp.i + 1))),
done AS (
  SELECT conv_id, {_lightest("s0", "t3")} AS best
  FROM (SELECT *, {_INSERTED[3]} AS t3 FROM (SELECT dp.*, {_INSERTED[2]} AS t2 FROM dp JOIN totals USING (conv_id) WHERE i = n)))
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
  coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.l, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN totals USING (conv_id) LEFT JOIN done USING (conv_id)"""


def _encoded(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_encoded(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _levels(name: str, leaves: str) -> str:
    """Recursive table of all levels of the binary trees over ``leaves`` (grp, idx, n, d)."""
    return f"""{name} AS (
  SELECT grp, 0 AS lvl, idx, n, d FROM {leaves}
  UNION ALL
  SELECT grp, lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY idx)) FROM {name} WHERE n > 1 GROUP BY grp, lvl, idx // 2, n)"""


SQL["op13_merkle_manifest"] = f"""
WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS t),
docs AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS grp, {_leaf("n_chars")} AS leaf,
    CASE WHEN {_crc32("t", "doc_id::VARCHAR")} % 7 = 0 THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS changed
  FROM documents, crc),
leaves AS (
  SELECT *, leaf AS d, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY grp) AS n
  FROM docs),
{_levels("lower_", "leaves")},
subroots AS (SELECT 0 AS grp, grp AS idx, count(*) OVER () AS n, d FROM lower_ WHERE n = 1),
{_levels("upper_", "subroots")},
steps AS (
  SELECT l.doc_id, me.lvl, (l.idx >> me.lvl) % 2 = 1 AS later, sib.d
  FROM leaves l JOIN lower_ me ON me.grp = l.grp AND me.idx = l.idx >> me.lvl AND me.n > 1
  LEFT JOIN lower_ sib ON sib.grp = l.grp AND sib.lvl = me.lvl AND sib.idx = xor(me.idx, 1)
  UNION ALL
  SELECT l.doc_id, 1000 + me.lvl, (l.grp >> me.lvl) % 2 = 1, sib.d
  FROM leaves l JOIN upper_ me ON me.idx = l.grp >> me.lvl AND me.n > 1
  LEFT JOIN upper_ sib ON sib.lvl = me.lvl AND sib.idx = xor(me.idx, 1)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY lvl) AS step FROM steps),
proofs AS (SELECT doc_id, count(*) AS depth, string_agg(d, '' ORDER BY step) AS path FROM numbered GROUP BY doc_id),
folds AS (
  SELECT doc_id, 0::BIGINT AS step, changed AS d FROM leaves
  UNION ALL
  SELECT f.doc_id, s.step, sha256(CASE WHEN s.later THEN s.d || f.d ELSE f.d || coalesce(s.d, '') END)
  FROM folds f JOIN numbered s ON s.doc_id = f.doc_id AND s.step = f.step + 1)
SELECT l.doc_id, l.leaf, subroots.d AS subroot, root.d AS root, sha256(coalesce(path, '')) AS proof_sha256,
  folds.d AS folded_root, folds.d = root.d AS verified
FROM leaves l JOIN subroots ON subroots.idx = l.grp JOIN (SELECT d FROM upper_ WHERE n = 1) root ON true
LEFT JOIN proofs ON proofs.doc_id = l.doc_id JOIN folds ON folds.doc_id = l.doc_id AND folds.step = coalesce(depth, 0)"""
