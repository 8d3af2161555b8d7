"""SQL twins of the operators that SQL can express on whole tables."""

from __future__ import annotations

from tillsight.llm.quality_rules import RULES

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = "list_filter(regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
_WORDS = f"list_filter(regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"

DECONTAMINATION = f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM b, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS t(i) WHERE len(w) > 0),
dw AS (SELECT doc_id, l.n, i, array_to_string(w[i:i + l.n - 1], ' ') AS s
  FROM d, (SELECT DISTINCT n FROM bw) l, unnest(range(1, greatest(len(w) - l.n + 2, 1))) AS t(i)),
hits AS (SELECT DISTINCT doc_id, dw.n, i, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.s = bw.s),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids FROM (
  SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""

NGRAM_JACCARD = f"""WITH RECURSIVE d AS (SELECT doc_id, {_PLAIN.format(text=_LOWER)} AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
met AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM met JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 90 * (nx.n + ny.n - c)),
both_ways AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
reach AS (SELECT doc_id AS start, doc_id AS node FROM d UNION SELECT start, y FROM reach JOIN both_ways ON x = node)
SELECT start AS doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(node) AS component_id
FROM reach LEFT JOIN n ON n.doc_id = start GROUP BY start"""


def _quality(risk: float = 0.01, alpha: float = 0.05) -> str:
    size = len(next(iter(RULES.values()))[1])
    values = {}
    for name, (value, cuts) in sorted(RULES.items()):
        # try_divide(a, b) is a / b, null where b is 0.
        a, b = value.removeprefix("try_divide(").removesuffix(")").split(", ")
        values[name] = f"coalesce(CAST({a} AS DOUBLE) / nullif({b}, 0), 0) > ({cuts}::DOUBLE[])"
    over = " OR ".join(f"{v}[g]" for v in values.values())
    names = ", ".join(f"CASE WHEN {v}[place] THEN '{name}' END" for name, v in values.items())
    return f"""WITH w AS (SELECT doc_id, lang AS s, coalesce(text, '') AS t, {_PLAIN.format(text="coalesce(text, '')")} AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
grams AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM w, unnest(range(1, greatest(len(w) - 3, 1))) AS t(i)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
again AS (SELECT doc_id, count(DISTINCT p) AS n FROM twice, unnest(range(i, i + 5)) AS t(p) GROUP BY doc_id),
m AS (SELECT doc_id, s, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, len(l) AS n_lines,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
  len(w) < 10 OR 100 * coalesce(n, 0) > 20 * len(w) AS base_failed FROM w LEFT JOIN again USING (doc_id)),
held AS (SELECT s, good, g, {over} AS beyond FROM m JOIN (SELECT doc_id, max(quality) > 0 AS good FROM labels WHERE quality IS NOT NULL GROUP BY 1) USING (doc_id),
  range(1, {size + 1}) AS t(g) WHERE NOT base_failed),
c AS (SELECT s, g, count(*) FILTER (WHERE good) AS n, count(*) FILTER (WHERE good AND beyond) AS k,
  count(*) FILTER (WHERE NOT good AND beyond) AS bad, (SELECT count(DISTINCT coalesce(s, '') || (s IS NULL)) FROM held) AS strata FROM held GROUP BY 1, 2),
p AS (SELECT *, CASE WHEN n = 0 OR k >= n * {risk!r} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1),
  lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({risk!r}) + (n - j) * ln(1 - {risk!r})))) END AS p FROM c),
passed AS (SELECT *, min(CAST(p <= {alpha!r} / strata AS INT)) OVER (PARTITION BY s ORDER BY g) AS ok FROM p),
chosen AS (SELECT s, first(g ORDER BY bad DESC, g) AS place FROM passed WHERE ok = 1 AND bad > 0 GROUP BY 1),
named AS (SELECT m.*, list_filter([{names}], lambda x: x IS NOT NULL) AS f FROM m LEFT JOIN chosen ON m.s IS NOT DISTINCT FROM chosen.s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND len(f) = 0 AS kept, array_to_string(f, ',') AS failed_rules
FROM named"""


QUALITY_RULES = _quality()

RECOMPRESSION = f"""WITH d AS (SELECT doc_id, {_PLAIN.format(text="coalesce(text, '')")} AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s FROM d, unnest(range(1, greatest(len(w) - 18, 1))) AS t(i)),
again AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS place FROM g) WHERE place > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM again, unnest(range(i, i + 20)) AS t(p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(list_filter(w, lambda x, i: NOT coalesce(list_contains(ps, i), false)), ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)"""

TARGET_RESAMPLING = f"""WITH tbl AS (SELECT list(c ORDER BY i) AS tb FROM (SELECT i,
  list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM range(256) t(i))),
w AS (SELECT 'd' AS side, doc_id AS id, {_WORDS} AS w FROM documents UNION ALL SELECT 'b', item_id, {_WORDS} FROM benchmark),
f AS (SELECT side, id, array_to_string(w[i:i + k], ' ') AS s FROM w, range(0, 3) n(k), unnest(range(1, greatest(len(w) - k, 0) + 1)) AS t(i)),
names AS MATERIALIZED (SELECT s, hex(encode(s)) AS h FROM (SELECT DISTINCT s FROM f)),
crcs AS MATERIALIZED (SELECT s, xor(list_reduce(list_transform(range(0, len(h) // 2), lambda j: CAST('0x' || substr(h, 2 * j + 1, 2) AS BIGINT)),
  lambda c, x: xor(c >> 8, tb[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket FROM names, tbl),
fb AS MATERIALIZED (SELECT side, id, bucket, count(*) AS n FROM f JOIN crcs USING (s) GROUP BY ALL),
n AS (SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (WHERE side = 'b'), 0)::DOUBLE AS t FROM fb GROUP BY 1),
g AS (SELECT bucket, CAST(floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM n) + 10000) / ((s + 1) * ((SELECT sum(t) FROM n) + 10000)))) AS BIGINT) AS gain FROM n),
d AS (SELECT id AS doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight FROM fb JOIN g USING (bucket) WHERE side = 'd' GROUP BY 1),
x AS (SELECT w.id AS doc_id, len(w.w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  CAST('0x' || substr(sha256('42:' || w.id), 1, 8) AS BIGINT)::DOUBLE AS h FROM w LEFT JOIN d ON d.doc_id = w.id WHERE side = 'd'),
sc AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296e0))) AS BIGINT) AS score FROM x),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM sc WHERE n_words >= 20)
SELECT sc.doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank FROM sc LEFT JOIN r USING (doc_id)"""


def _vector_codes(rounds: int = 6) -> str:
    ctes = ["""v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
  list_transform(embedding, lambda c: CAST(floor(4096 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)""",
            "p AS MATERIALIZED (SELECT r, part, x[part * len(x) // 8 + 1:(part + 1) * len(x) // 8] AS x FROM v, range(8) t(part))",
            "b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x AS c FROM p WHERE r <= 16)"]
    for i in range(rounds + 1):
        ctes.append(f"""a{i} AS MATERIALIZED (SELECT r, part, any_value(x) AS x, arg_min(entry, [d, entry]) AS entry, min(d) AS d FROM (SELECT r, part, x, entry,
  list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM p JOIN b{i} USING (part)) GROUP BY r, part)""")
        if i < rounds:
            ctes.append(f"""b{i + 1} AS MATERIALIZED (SELECT part, entry, coalesce(n.c, b{i}.c) AS c FROM b{i} LEFT JOIN (SELECT part, entry, list(m ORDER BY j) AS c FROM (
  SELECT part, entry, j, CAST(floor(sum(x[j]) / count(*)) AS BIGINT) AS m FROM a{i}, unnest(range(1, len(x) + 1)) AS t(j) GROUP BY 1, 2, 3) GROUP BY 1, 2) n USING (part, entry))""")
    last = rounds
    return "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM b{last}) AS codebooks_sha256
FROM v JOIN (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{last} GROUP BY r) USING (r)"""


VECTOR_CODES = _vector_codes()
