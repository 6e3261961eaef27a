"""Named queries over the given tables and SQL for those SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postgauge.llm import (
    bpe,
    conversation,
    html_text,
    leaks,
    neardup,
    order,
    quality,
    secret_scan,
    shards,
    spelling,
    toxicity,
    vectors,
    warc,
)
from postgauge.llm.common import table

RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.training_order(table(spark, sf_dir, "documents"))


def op2_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), width=2).drop("set_key")


def op4_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op5_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leak_digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_indexed_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.assign_shards(table(spark, sf_dir, "documents"), shards=8, law="bytes")
    return placed.select(
        "*", F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    )


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(RANK_FILE),
        public_tokenizers.PATTERN,
    )


def op9_crf_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op10_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op11_checkpointed_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation.digests(conversation.damage(table(spark, sf_dir, "conversations")))


def op12_sorted_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


def op13_hyperplane_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_training_order": op1_training_order,
    "op2_kneser_ney": op2_kneser_ney,
    "op3_bottom_k": op3_bottom_k,
    "op4_secret_forest": op4_secret_forest,
    "op5_suffix_arrays": op5_suffix_arrays,
    "op6_indexed_warc": op6_indexed_warc,
    "op7_sampled_splitters": op7_sampled_splitters,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_crf_blocks": op9_crf_blocks,
    "op10_rule_cascade": op10_rule_cascade,
    "op11_checkpointed_repair": op11_checkpointed_repair,
    "op12_sorted_variants": op12_sorted_variants,
    "op13_hyperplane_tables": op13_hyperplane_tables,
}

_OP10 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
      FROM d),
win AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS k
        FROM w, unnest(range(1, len(ws) - 1)) r(i)),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win)
        WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM rep, (VALUES (0), (1), (2)) v(o)
        GROUP BY doc_id),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(cov.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines
      FROM w LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT *, NOT (base_failed OR 10 * n_symbols > n_words OR 100 * n_dup_lines > 30 * n_lines
    OR word_chars < 2 * n_words OR word_chars > 12 * n_words) AS kept
FROM b
"""

_OP3 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, ws[i] || ' ' || ws[i + 1] AS k FROM w, unnest(range(1, len(ws))) r(i)
  UNION ALL SELECT doc_id, ws[1] FROM w WHERE len(ws) = 1),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
      FROM s x JOIN s y ON x.k = y.k AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 80 * (na.n + nb.n - c)),
r AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) c USING (doc_id)
"""

_OP5 = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
bw AS (
  SELECT item_id, ws, least(10, len(ws)) AS size FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark)
  WHERE len(ws) > 0),
win AS (
  SELECT DISTINCT item_id, size, array_to_string(ws[i:i + size - 1], ' ') AS k
  FROM bw, unnest(range(1, len(ws) - size + 2)) r(i)),
dwin AS (
  SELECT doc_id, i, size, array_to_string(ws[i:i + size - 1], ' ') AS k
  FROM dw, (SELECT DISTINCT size FROM win), unnest(range(1, len(ws) - size + 2)) r(i)),
hit AS (SELECT doc_id, item_id, i, win.size FROM dwin JOIN win USING (k)),
cov AS (
  SELECT doc_id, count(DISTINCT i + o) AS n FROM hit, unnest(range(0, size)) r(o) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(cov.n, 0)::BIGINT AS n_hit,
  coalesce(its.n, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(cov.n, 0) > 0 AS contaminated
FROM dw LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""

_OP6 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM f
"""

#: Macros for the damage of op11 and op12: bytes of text up to U+00FF, and their CRC-32.
_CRC = """
tab AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i::BIGINT] || range(8),
      lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))),
"""


def _crc(text: str) -> str:
    codes = f"list_transform(string_split({text}, ''), lambda s: unicode(s)::BIGINT)"
    data = f"flatten(list_transform({codes}, lambda p: CASE WHEN p < 128 THEN [p] ELSE [192 + (p >> 6), 128 + (p & 63)] END))"
    steps = f"list_reduce([4294967295::BIGINT] || {data}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))"
    return f"xor({steps}, 4294967295)"


_OP11 = rf"""
WITH RECURSIVE {_CRC}
d AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS h
  FROM conversations, tab),
r AS (
  SELECT conv_id, turn, copy, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM d, (VALUES (1), (2)) c(copy) WHERE h <> 0 AND (copy = 1 OR h = 3)),
n AS (
  SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text
      ORDER BY turn NULLS FIRST, md5(text), copy) AS nth,
    regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g') AS solid, left(role, 1) AS ini,
    lag(left(role, 1)) OVER w AS before
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy)),
f AS (
  SELECT *, CASE WHEN solid = '' THEN 'b' WHEN nth > 1 THEN 'd'
      WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM n),
c AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
    count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
    count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (i > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS last
  FROM f GROUP BY conv_id),
-- What may come before a row: states 0 (nothing yet), 1 (after s), 2 (after u), 3 (after a).
ins(q, to_q, letters, cost, lines) AS (VALUES
  (0, 0, '', 0, []::VARCHAR[]), (1, 1, '', 0, []), (2, 2, '', 0, []), (3, 3, '', 0, []),
  (0, 2, 'I', 2, ['user:']), (1, 2, 'I', 2, ['user:']), (2, 3, 'I', 2, ['assistant:']),
  (3, 2, 'I', 2, ['user:']), (0, 3, 'II', 4, ['user:', 'assistant:']),
  (1, 3, 'II', 4, ['user:', 'assistant:'])),
step AS (
  SELECT f.conv_id, f.i, ins.q, e.to_q, ins.letters || e.letter AS letters,
    ins.cost + e.cost + CASE WHEN fault = 't' AND letter <> 'D' THEN 1 ELSE 0 END AS cost,
    ins.lines || CASE letter WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text]
      ELSE [e.role_to || ':' || text] END AS lines
  FROM f, ins JOIN (VALUES
    (0, 0, 'D', 3, '', ''), (1, 1, 'D', 3, '', ''), (2, 2, 'D', 3, '', ''), (3, 3, 'D', 3, '', ''),
    (0, 1, 'K', 0, 's', ''), (0, 2, 'K', 0, 'u', ''), (1, 2, 'K', 0, 'u', ''),
    (2, 3, 'K', 0, 'a', ''), (3, 2, 'K', 0, 'u', ''),
    (0, 2, 'R', 2, '', 'user'), (1, 2, 'R', 2, '', 'user'), (2, 3, 'R', 2, '', 'assistant'),
    (3, 2, 'R', 2, '', 'user')) e(q, to_q, letter, cost, needs, role_to) ON e.q = ins.to_q
  WHERE letter = 'D' OR (fault NOT IN ('b', 'd') AND (needs = '' OR needs = ini))),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS q, '' AS audit, 0 AS cost, []::VARCHAR[] AS lines FROM c
  UNION ALL
  SELECT conv_id, i, q, best.audit, best.cost, best.lines FROM (
    SELECT w.conv_id, s.i, s.to_q AS q,
      min({{'cost': w.cost + s.cost, 'audit': w.audit || s.letters, 'lines': w.lines || s.lines}}) AS best
    FROM walk w JOIN step s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.i = w.i + 1 AND s.q = w.q
    GROUP BY w.conv_id, s.i, s.to_q)),
done AS (
  SELECT w.conv_id, min({{'cost': w.cost + ins.cost, 'audit': w.audit || ins.letters,
      'lines': w.lines || ins.lines}}) AS best
  FROM walk w JOIN c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = c.last
  JOIN ins ON ins.q = w.q AND ins.to_q IN (0, 3) GROUP BY w.conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
  coalesce(best.audit, '') AS audit,
  sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM o.conv_id
"""

_OP12 = rf"""
WITH RECURSIVE {_CRC}
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
seen AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run),
marked AS (
  SELECT run, n, {_crc("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM seen, tab),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0
      THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
      ELSE run END AS word FROM marked)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS MATERIALIZED (
  SELECT word, n, p, left(word, p::INT - 1) || substr(word, p::INT + 1) AS rest
  FROM words, unnest(range(1, length(word) + 1)) r(p)),
pairs AS (
  SELECT DISTINCT a, b, n FROM (
    SELECT x.word AS a, y.word AS b, y.n FROM cut x JOIN cut y ON x.rest = y.rest AND x.p = y.p AND x.word <> y.word
    UNION ALL SELECT w.word, c.word, c.n FROM cut c JOIN words w ON w.word = c.rest
    UNION ALL SELECT c.word, w.word, w.n FROM cut c JOIN words w ON w.word = c.rest)),
best AS (
  SELECT a AS word, count(*) AS n_near, arg_min({{'b': b, 'n': n}}, {{'less': -n, 'b': encode(b)}}) AS top
  FROM pairs GROUP BY a),
formed AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN top.n >= 2 * n THEN top.b END AS form, CASE WHEN top.n >= 2 * n THEN top.n END AS form_n
  FROM words LEFT JOIN best USING (word)),
way AS (
  SELECT word, word AS at, form AS onward FROM formed
  UNION ALL SELECT way.word, f.word, f.form FROM way JOIN formed f ON f.word = way.onward)
SELECT f.word, f.form, way.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN way ON way.word = f.word AND way.onward IS NULL
"""

_OP13 = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, embedding::DOUBLE[] AS e, row_number() OVER () AS i FROM embeddings),
g AS MATERIALIZED (
  SELECT vec_id, e, i FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (
  SELECT a.i AS a, b.i AS b FROM g a JOIN g b ON len(a.e) = len(b.e) AND a.i <> b.i
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT i AS a, i AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
c AS (SELECT r.a, min(v.vec_id) AS low FROM r JOIN v ON v.i = r.b GROUP BY r.a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.low AS component_id,
  vec_id IS NOT DISTINCT FROM c.low AS kept
FROM v JOIN c ON c.a = v.i LEFT JOIN n ON n.a = v.i
"""

ORACLES = {
    "op11_checkpointed_repair": _OP11,
    "op12_sorted_variants": _OP12,
    "op13_hyperplane_tables": _OP13,
    "op6_indexed_warc": _OP6,
    "op5_suffix_arrays": _OP5,
    "op3_bottom_k": _OP3,
    "op10_rule_cascade": _OP10,
}
