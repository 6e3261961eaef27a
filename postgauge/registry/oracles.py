"""Independent SQL for the named queries, written for DuckDB."""

from __future__ import annotations

# The instruction text the models were given, written out again here.
TASK_TEXT = """You are evaluating an academic NLP benchmark for suicidal ideation detection.
Classify whether the {which} contains suicidal ideation or suicidal risk.

Return only valid JSON with this exact schema:
{{
  "label": "yes" or "no",
  "score": number from 0.0 to 1.0,
  "evidence": ["short quoted or paraphrased evidence"],
  "justification": "brief explanation"
}}

Rules:
- Use "yes" when the post expresses suicidal ideation, intent, planning,
  self-harm intent, or explicit desire not to live.
- Use "no" for depression, stress, sadness, or support-seeking without suicidal
  ideation or self-harm intent.
- The score is confidence for the "yes" class.
- Do not provide clinical advice. Do not add text outside the JSON.

"""


SPACE = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
NOT_SPACE = SPACE.replace("[", "[^", 1)
METRIC_NAMES = (
    "protocol_auc", "roc_auc", "recall", "precision", "f1", "true_positive_rate", "false_positive_rate",
)
CELLS = ("true_negative", "false_positive", "false_negative", "true_positive")


def normalized(text: str) -> str:
    """Lower case, URL token, control characters, white space, trim."""
    linked = f"regexp_replace(lower({text}), 'https?://{NOT_SPACE}+|www\\.{NOT_SPACE}+', ' url_token ', 'g')"
    printable = f"regexp_replace({linked}, '[\\x00-\\x1f\\x7f-\\x{{9f}}]', ' ', 'g')"
    return f"trim(regexp_replace({printable}, '{SPACE}+', ' ', 'g'))"


def stripped(text: str) -> str:
    return f"regexp_replace({text}, '^{SPACE}+|{SPACE}+$', '', 'g')"


POSTS = f"""
posts AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS text_id,
         d.source || '_' || CAST(d.doc_id % 7 AS VARCHAR) AS user_id,
         CASE WHEN strpos(d.text, chr(10)) > 0 THEN substr(d.text, 1, strpos(d.text, chr(10)) - 1)
              ELSE d.text END AS title,
         CASE WHEN strpos(d.text, chr(10)) > 0 THEN substr(d.text, strpos(d.text, chr(10)) + 1)
              ELSE '' END AS text,
         CAST(l.quality AS INTEGER) AS y, l.toxic
  FROM (SELECT doc_id, source, coalesce(text, '') AS text FROM documents) d
  LEFT JOIN labels l USING (doc_id)),
norm AS (SELECT *, {normalized("title || chr(10) || text")} AS t FROM posts),
pool AS (SELECT * FROM norm WHERE y IS NOT NULL),
fresh AS (SELECT * FROM norm WHERE y IS NULL)"""

SPLIT = f"""{POSTS},
users AS (
  SELECT user_id, row_number() OVER (ORDER BY md5('42:' || user_id)) AS place, count(*) OVER () AS n
  FROM (SELECT DISTINCT user_id FROM pool)),
tagged AS (
  SELECT p.*, CASE WHEN u.place <= ceil(CAST(0.2 AS DOUBLE) * u.n) THEN 'validacion'
                   ELSE 'entrenamiento' END AS split
  FROM pool p JOIN users u USING (user_id)),
train AS (SELECT * FROM tagged WHERE split = 'entrenamiento'),
valid AS (SELECT * FROM tagged WHERE split = 'validacion')"""

WORD = r"regexp_extract_all(t, '[\p{L}\p{N}_]{2,}')"


def occurrences(source: str, name: str, kind: str = "word1") -> str:
    """CTE of (text_id, term), one row per occurrence."""
    if kind == "char":
        return f"""
{name}_w AS (SELECT text_id, ' ' || w || ' ' AS p FROM
  (SELECT text_id, unnest(string_split(t, ' ')) AS w FROM {source}) WHERE w <> ''),
{name} AS (SELECT text_id, substr(p, CAST(i AS INTEGER), CAST(n AS INTEGER)) AS term
  FROM {name}_w, unnest([3, 4, 5]) AS a(n), unnest(range(1, length(p) - n + 2)) AS b(i)
  WHERE n <= length(p))"""
    size = int(kind[-1])
    parts = [f"SELECT text_id, unnest(w) AS term FROM {name}_w"]
    for n in range(2, size + 1):
        joined = " || ' ' || ".join(f"w[i + {k}]" for k in range(n))
        parts.append(
            f"SELECT text_id, {joined} FROM {name}_w, unnest(range(1, len(w) - {n} + 2)) AS r(i)"
            f" WHERE len(w) >= {n}"
        )
    return f"""
{name}_w AS (SELECT text_id, {WORD} AS w FROM {source}),
{name} AS ({" UNION ALL ".join(parts)})"""


def vocabulary(source: str, kind: str = "word1", limit: int = 20_000) -> str:
    """CTEs ``ttf`` (document counts) and ``vocab`` of a source."""
    return f"""{occurrences(source, "occ", kind)},
ttf AS (SELECT text_id, term, count(*) AS tf FROM occ GROUP BY text_id, term),
size AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM {source}),
vocab AS (
  SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf FROM ttf GROUP BY term
  HAVING count(*) >= 2 AND count(*) <= 0.95 * (SELECT n FROM size)
  ORDER BY tf DESC, term LIMIT {limit}),
idf AS (SELECT term, df, tf, ln((1 + (SELECT n FROM size)) / (1 + df)) + 1 AS idf FROM vocab)"""


def weighted(source: str, name: str, kind: str = "word1") -> str:
    """CTE ``name`` of (text_id, term, v) with unit length per text."""
    return f"""{occurrences(source, name + "_o", kind)},
{name}_r AS (
  SELECT o.text_id, o.term, count(*) * any_value(i.idf) AS v
  FROM {name}_o o JOIN idf i USING (term) GROUP BY o.text_id, o.term),
{name} AS (SELECT text_id, term, v / sqrt(sum(v * v) OVER (PARTITION BY text_id)) AS v FROM {name}_r)"""


def bayes(prior: bool, kind: str = "word1", limit: int = 20_000, target: str = "valid") -> str:
    """CTE chain from the split to ``pred`` for ``target``."""
    shift = "ln((SELECT sum(y) FROM train) / (SELECT sum(1 - y) FROM train))" if prior else "0"
    return f"""{SPLIT},{vocabulary("train", kind, limit)},{weighted("train", "wt", kind)},
sums AS (SELECT term, sum(CASE WHEN y = 1 THEN v ELSE 0 END) + 1 AS s1,
                sum(CASE WHEN y = 0 THEN v ELSE 0 END) + 1 AS s0
         FROM wt JOIN train USING (text_id) GROUP BY term),
theta AS (SELECT term, ln(s1 / (SELECT sum(s1) FROM sums)) - ln(s0 / (SELECT sum(s0) FROM sums)) AS w
          FROM sums),{weighted(target, "wv", kind)},
margin AS (
  SELECT p.text_id, p.user_id, p.y, p.title, p.text,
         coalesce(sum(wv.v * theta.w), 0) + {shift} AS m
  FROM {target} p LEFT JOIN wv ON wv.text_id = p.text_id LEFT JOIN theta USING (term)
  GROUP BY p.text_id, p.user_id, p.y, p.title, p.text),
pred AS (SELECT text_id, user_id, y AS y_true, CASE WHEN m > 0 THEN 1 ELSE 0 END AS y_pred,
                1 / (1 + exp(-m)) AS score, title, text FROM margin)"""


def rates(source: str, keys: str) -> str:
    """CTEs ``cells`` and ``rates`` of predictions grouped by keys."""
    return f"""
cells AS (
  SELECT {keys}, count(*) FILTER (y_true = 0 AND y_pred = 0) AS true_negative,
         count(*) FILTER (y_true = 0 AND y_pred = 1) AS false_positive,
         count(*) FILTER (y_true = 1 AND y_pred = 0) AS false_negative,
         count(*) FILTER (y_true = 1 AND y_pred = 1) AS true_positive
  FROM {source} GROUP BY {keys}),
shares AS (
  SELECT *, CASE WHEN true_positive + false_negative > 0
                 THEN true_positive / (true_positive + false_negative) ELSE 0 END AS tpr,
         CASE WHEN false_positive + true_negative > 0
              THEN false_positive / (false_positive + true_negative) ELSE 0 END AS fpr
  FROM cells),
rates AS (
  SELECT {keys}, (1 + tpr - fpr) / 2 AS protocol_auc, tpr AS recall,
         CASE WHEN true_positive + false_positive > 0
              THEN true_positive / (true_positive + false_positive) ELSE 0 END AS precision,
         CASE WHEN 2 * true_positive + false_positive + false_negative > 0
              THEN 2 * true_positive / (2 * true_positive + false_positive + false_negative)
              ELSE 0 END AS f1,
         tpr AS true_positive_rate, fpr AS false_positive_rate,
         true_negative, false_positive, false_negative, true_positive
  FROM shares)"""


def area(source: str, keys: str, score: str = "score") -> str:
    """CTE ``area`` with the exact ROC AUC from mid-ranks."""
    return f"""
placed AS (
  SELECT {keys}, y_true, s, rank() OVER (PARTITION BY {keys} ORDER BY s)
         + (count(*) OVER (PARTITION BY {keys}, s) - 1) / 2 AS mid
  FROM (SELECT {keys}, y_true, {score} AS s FROM {source})),
area AS (
  SELECT {keys}, CASE WHEN sum(y_true) > 0 AND sum(1 - y_true) > 0 THEN
         (sum(CASE WHEN y_true = 1 THEN mid ELSE 0 END) - sum(y_true) * (sum(y_true) + 1) / 2)
         / (CAST(sum(y_true) AS DOUBLE) * sum(1 - y_true)) END AS roc_auc
  FROM placed GROUP BY {keys})"""


def metric_list(prefix: str = "") -> str:
    return ", ".join(f"round({prefix}{m}, 6) AS {m}" for m in METRIC_NAMES)


CELL_LIST = ", ".join(CELLS)

ORDERS = """
op AS (
  SELECT o_orderkey, o_custkey, o_orderpriority AS priority,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y_true,
         CASE WHEN o_totalprice > 250000.0 THEN 1 ELSE 0 END AS y_pred,
         floor(o_totalprice / 1000) AS score, o_totalprice AS price
  FROM orders)"""

CLASSIFIER_LIST = (
    "['logistic_regression', 'linear_svm', 'sgd_logistic', 'multinomial_nb', 'complement_nb']"
)
FEATURE_LIST = "['word_unigram', 'word_unigram_bigram', 'word_unigram_trigram', 'char_wb_3_5']"


def pair(key: str) -> str:
    return (
        f"{CLASSIFIER_LIST}[CAST({key} % 5 + 1 AS INTEGER)] AS classifier_name, "
        f"{FEATURE_LIST}[CAST((CAST({key} AS BIGINT) // 5) % 4 + 1 AS INTEGER)] AS feature_config_name"
    )


def fold_of(user: str) -> str:
    return f"CAST(CAST('0x' || substr(md5('42:' || {user}), 1, 8) AS BIGINT) % 5 + 1 AS INTEGER)"


RUNS = f"""{ORDERS},{rates("op", "o_custkey")},{area("op", "o_custkey")},
custm AS (SELECT * FROM rates JOIN area USING (o_custkey)),
custn AS (
  SELECT c.*, {pair("c_custkey")}, c_mktsegment AS experiment_name,
         CASE WHEN c_acctbal < 0 THEN 'unknown' ELSE
           strftime(coalesce(m.last_order, TIMESTAMP '1990-01-01'), '%Y-%m-%dT%H:%M:%SZ') END AS started_at,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN 'failed' ELSE 'completed' END AS status
  FROM customer c
  LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey) m
    ON m.o_custkey = c.c_custkey),
keyed AS (
  SELECT *, trim(regexp_replace(lower(experiment_name), '[^a-z0-9]+', '-', 'g'), '-') || '__'
         || regexp_replace(classifier_name, '[^a-z0-9]+', '-', 'g') || '__'
         || regexp_replace(feature_config_name, '[^a-z0-9]+', '-', 'g') || '__'
         || replace(replace(regexp_replace(started_at, '[-:+]', '', 'g'), 'T', '-'), 'Z', 'z') AS run_key
  FROM custn),
summary AS (
  SELECT c_custkey, run_key || '__' || CAST(c_custkey AS VARCHAR) AS run_id, status, experiment_name,
         classifier_name, feature_config_name, started_at,
         CASE WHEN status = 'completed' THEN started_at END AS completed_at,
         abs(c_acctbal) AS duration_seconds, 42 AS random_state, CAST(0.2 AS DOUBLE) AS validation_size,
         m.* EXCLUDE (o_custkey)
  FROM keyed k LEFT JOIN custm m ON m.o_custkey = k.c_custkey),
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
        PARTITION BY classifier_name, feature_config_name
        ORDER BY try_cast(replace(replace(started_at, 'T', ' '), 'Z', '') AS TIMESTAMP) DESC NULLS FIRST,
                 run_id DESC) AS place
    FROM summary WHERE status = 'completed' AND protocol_auc IS NOT NULL)
  WHERE place = 1)"""

ORDER_FOLDS = f"""{ORDERS},
opf AS (SELECT *, {pair("o_custkey")}, {fold_of("CAST(o_custkey AS VARCHAR)")} AS fold FROM op),
{rates("opf", "classifier_name, feature_config_name, fold")},
{area("opf", "classifier_name, feature_config_name, fold")},
folds AS (SELECT * FROM rates JOIN area USING (classifier_name, feature_config_name, fold))"""

CV = f"""{POSTS},
docs AS (SELECT *, {fold_of("user_id")} AS fold FROM pool),
fs AS (SELECT unnest(range(1, 6)) AS f),{occurrences("docs", "occ")},
ttf AS (SELECT text_id, term, count(*) AS tf FROM occ GROUP BY text_id, term),
ft AS (SELECT fold, term, count(*) AS df, sum(tf) AS tf FROM ttf JOIN docs USING (text_id) GROUP BY fold, term),
sizes AS (SELECT f, CAST(count(*) AS DOUBLE) AS n, sum(y) AS n1, sum(1 - y) AS n0
          FROM fs JOIN docs ON docs.fold <> fs.f GROUP BY f),
fv AS (SELECT f, term, sum(df) AS df, sum(tf) AS tf FROM fs JOIN ft ON ft.fold <> fs.f GROUP BY f, term),
vocab AS (
  SELECT * FROM (SELECT f, term, ln((1 + n) / (1 + df)) + 1 AS idf,
                        row_number() OVER (PARTITION BY f ORDER BY tf DESC, term) AS place
                 FROM fv JOIN sizes USING (f) WHERE df >= 2 AND df <= 0.95 * n)
  WHERE place <= 20000),
raw AS (SELECT v.f, t.text_id, t.term, t.tf * v.idf AS v FROM ttf t JOIN vocab v USING (term)),
unit AS (SELECT f, text_id, term, v / sqrt(sum(v * v) OVER (PARTITION BY f, text_id)) AS v FROM raw),
sums AS (
  SELECT f, term, sum(CASE WHEN y = 1 THEN v ELSE 0 END) + 1 AS s1,
         sum(CASE WHEN y = 0 THEN v ELSE 0 END) + 1 AS s0
  FROM unit JOIN docs USING (text_id) WHERE fold <> f GROUP BY f, term),
theta AS (SELECT f, term, ln(s1 / sum(s1) OVER (PARTITION BY f)) - ln(s0 / sum(s0) OVER (PARTITION BY f)) AS w
          FROM sums),
held AS (
  SELECT d.text_id, d.fold, d.y, coalesce(sum(u.v * h.w), 0) AS m
  FROM docs d LEFT JOIN unit u ON u.text_id = d.text_id AND u.f = d.fold
  LEFT JOIN theta h ON h.f = u.f AND h.term = u.term GROUP BY d.text_id, d.fold, d.y),
both_models AS (
  SELECT 'complement_nb' AS classifier_name, fold, y, m FROM held UNION ALL
  SELECT 'multinomial_nb', fold, y, m + ln(n1 / n0) FROM held JOIN sizes ON f = fold),
pred AS (
  SELECT classifier_name, 'word_unigram' AS feature_config_name, fold, y AS y_true,
         CASE WHEN m > 0 THEN 1 ELSE 0 END AS y_pred, round(1 / (1 + exp(-m)), 12) AS score
  FROM both_models),
{rates("pred", "classifier_name, feature_config_name, fold")},
{area("pred", "classifier_name, feature_config_name, fold")},
people AS (
  SELECT f AS fold, count(*) FILTER (fold <> f) AS train_rows, count(*) FILTER (fold = f) AS validation_rows,
         count(DISTINCT user_id) FILTER (fold <> f) AS train_users,
         count(DISTINCT user_id) FILTER (fold = f) AS validation_users, 0 AS user_overlap_count
  FROM fs, docs GROUP BY f),
folds AS (
  SELECT * FROM rates JOIN area USING (classifier_name, feature_config_name, fold) JOIN people USING (fold))"""


def fold_summary_ctes() -> str:
    stats = ", ".join(
        f"avg({m}) AS mean_{m}, CASE WHEN count({m}) = 1 THEN 0 ELSE stddev_samp({m}) END AS std_{m}"
        for m in METRIC_NAMES
    )
    return f"""
cvs AS (SELECT classifier_name, feature_config_name, 5 AS n_splits, {stats}, count(*) AS folds_completed
        FROM folds GROUP BY classifier_name, feature_config_name)"""


STAT_LIST = ", ".join(
    f"round({s}_{m}, 6) AS {s}_{m}" for m in METRIC_NAMES for s in ("mean", "std")
)
CV_ORDER = (
    "mean_protocol_auc DESC NULLS LAST, std_protocol_auc ASC NULLS LAST, classifier_name, feature_config_name"
)
NOTE = (
    "La selección se hizo exclusivamente con data_train.csv; "
    "data_test_fold1.csv no se usó para selección de modelo."
)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


EXAMPLES = """
usable AS (SELECT * FROM pool WHERE length(t) BETWEEN 80 AND 1200 AND trim(t) <> ''),
drawn AS (
  SELECT y, text_id, t FROM (
    SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5(CAST(42 + y AS VARCHAR) || ':' || text_id), text_id) AS r
    FROM usable) WHERE r <= 3),
examples AS (
  SELECT row_number() OVER (ORDER BY y DESC, text_id) AS position, text_id,
         CASE WHEN y = 1 THEN 'yes' ELSE 'no' END AS label, t AS text
  FROM drawn)"""


def zero_shot(text: str) -> str:
    opening = TASK_TEXT.format(which="Reddit post") + 'Reddit post:\n"""'
    return f"{quoted(opening)} || substr({text}, 1, 6000) || " + "'\"\"\"'"


FEW_SHOT_OPENING = TASK_TEXT.format(which="final Reddit post") + "Few-shot examples:\n"
FEW_SHOT_BLOCK = (
    "'Example ' || position || chr(10) || 'Reddit post:' || chr(10) || '\"\"\"' || substr(text, 1, 1800)"
    " || '\"\"\"' || chr(10) || 'Expected JSON:' || chr(10) || '{\"label\":\"' || label || '\",\"score\":'"
    " || CASE label WHEN 'yes' THEN '0.90' ELSE '0.10' END"
    " || ',\"evidence\":[],\"justification\":\"Labeled training example.\"}'"
)


def made_answer(label: str, score: str, evidence: str) -> str:
    return (
        f"'{{\"label\":\"' || {label} || '\",\"score\":' || {score} || "
        f"',\"evidence\":{evidence},\"justification\":\" Razón ü \"}}'"
    )


_LABEL = "CASE WHEN substr(h, 2, 1) < '8' THEN ' YES' ELSE 'no' END"
_SCORE = "('0.' || regexp_replace(substr(h, 3, 3), '[a-f]', '7', 'g'))"
_EVIDENCE_LIST = "CAST(json_extract(raw_response, '$.evidence') AS VARCHAR[])"
STORED = f"""
hashed AS (
  SELECT *, CASE WHEN model = 'gemma3:4b' THEN substr(h, 1, 1) ELSE 'f' END AS kind FROM (
    SELECT CAST(doc_id AS VARCHAR) AS text_id, model, prompt_mode,
           md5(model || ':' || prompt_mode || ':' || CAST(doc_id AS VARCHAR)) AS h
    FROM documents, unnest(['gemma3:4b', 'llama3.2:3b']) AS a(model),
         unnest(['few_shot', 'zero_shot']) AS b(prompt_mode))),
stored AS (
  SELECT text_id, model, prompt_mode, 1 AS seq,
         CASE kind WHEN '0' THEN 'no es json' WHEN '1' THEN '["yes"]'
           WHEN '2' THEN {made_answer("'maybe'", _SCORE, "[]")}
           WHEN '3' THEN {made_answer(_LABEL, "'1.4'", "[]")}
           WHEN '4' THEN {made_answer(_LABEL, _SCORE, '["a"," ","b ","c","d","e","f"]')}
           WHEN '5' THEN '{{}}'
           WHEN '6' THEN {made_answer(_LABEL, f"'\"' || {_SCORE} || '\"'", '["x"]')}
           WHEN '7' THEN {made_answer(_LABEL, _SCORE, '[1,"x"]')}
           ELSE {made_answer(_LABEL, _SCORE, '["uno"," dos "]')} END AS raw_response
  FROM hashed WHERE kind <> '8'
  UNION ALL
  SELECT text_id, model, prompt_mode, 2, {made_answer("'no'", _SCORE, '["segunda"]')}
  FROM hashed WHERE kind IN ('0', '9'))"""


def judged(source: str, columns: str) -> str:
    """CTE ``judged`` with the parsed answer columns of ``source.raw_response``."""
    return f"""
typed AS (
  SELECT *, json_valid(raw_response) AS is_json,
         CASE WHEN json_valid(raw_response) THEN raw_response END AS doc FROM {source}),
read AS (
  SELECT *, json_type(doc) AS kind_of, lower(trim(json_extract_string(doc, '$.label'))) AS lab,
         try_cast(json_extract_string(doc, '$.score') AS DOUBLE) AS sc,
         json_type(doc, '$.label') AS lab_type,
         CASE WHEN json_type(doc, '$.evidence') = 'ARRAY' THEN
           list_aggregate(json_type(doc, '$.evidence[*]'), 'string_agg', ',') ELSE '' END AS ev_types,
         CASE WHEN json_type(doc, '$.evidence') = 'ARRAY' THEN json_extract_string(doc, '$.evidence[*]')
              ELSE [] END AS ev
  FROM typed),
checked AS (
  SELECT *, CASE WHEN NOT is_json THEN 'La respuesta del LLM no es JSON válido.'
    WHEN kind_of <> 'OBJECT' THEN 'La respuesta del LLM debe ser un objeto JSON.'
    WHEN coalesce(lab_type = 'VARCHAR' AND lab IN ('yes', 'no') AND sc BETWEEN 0 AND 1
         AND NOT regexp_matches(coalesce(ev_types, ''), 'BIGINT|DOUBLE|NULL'), false) THEN NULL
    ELSE 'La respuesta del LLM no cumple el esquema esperado.' END AS error
  FROM read),
judged AS (
  SELECT {columns}, error, CASE WHEN error IS NULL THEN lab END AS label_pred,
         CASE WHEN error IS NULL THEN CASE lab WHEN 'yes' THEN 1 ELSE 0 END END AS y_pred,
         CASE WHEN error IS NULL THEN sc END AS score,
         CASE WHEN error IS NULL THEN
           '[' || coalesce((SELECT string_agg('"' || e || '"', ', ' ORDER BY i) FROM
             (SELECT e, i, row_number() OVER (ORDER BY i) AS r FROM
               (SELECT trim(unnest(ev)) AS e, unnest(range(1, len(ev) + 1)) AS i) WHERE e <> '')
             WHERE r <= 5), '') || ']' ELSE '[]' END AS evidence,
         CASE WHEN error IS NULL THEN trim(json_extract_string(doc, '$.justification')) ELSE '' END AS justification
  FROM checked)"""


LAST = """
lasts AS (SELECT model, prompt_mode, text_id, arg_max(raw_response, seq) AS raw_response
          FROM stored GROUP BY model, prompt_mode, text_id)"""




def histogram(source: str, group: str, keep: str) -> str:
    return f"""
SELECT {keep} AS y_true, CAST(b.bin AS INTEGER) AS bin, round(lo + b.bin * ((hi - lo) / 20), 6) AS bin_start,
       round(CASE WHEN b.bin = 19 THEN hi ELSE lo + (b.bin + 1) * ((hi - lo) / 20) END, 6) AS bin_end,
       coalesce(c.n, 0) AS count
FROM (SELECT {group} AS g, CASE WHEN min(price) = max(price) THEN min(price) - 0.5 ELSE min(price) END AS lo,
             CASE WHEN min(price) = max(price) THEN max(price) + 0.5 ELSE max(price) END AS hi
      FROM {source} GROUP BY 1) r
CROSS JOIN (SELECT unnest(range(0, 20)) AS bin) b
LEFT JOIN (
  SELECT g, CASE WHEN price < lo + guess * step THEN guess - 1
                 WHEN price >= lo + (guess + 1) * step AND guess < 19 THEN guess + 1 ELSE guess END AS bin,
         count(*) AS n
  FROM (SELECT s.price, q.*, least(floor((s.price - lo) * (20.0 / (hi - lo))), 19) AS guess, (hi - lo) / 20 AS step
        FROM (SELECT price, {group} AS g FROM {source}) s
        JOIN (SELECT {group} AS g, min(price) AS lo, max(price) AS hi FROM {source} GROUP BY 1) q USING (g))
  GROUP BY 1, 2) c ON c.g = r.g AND c.bin = b.bin"""




def fragment_of(text: str) -> str:
    line = stripped(f"regexp_replace({text}, '{SPACE}+', ' ', 'g')")
    return f"CASE WHEN length({line}) <= 320 THEN {line} ELSE rtrim(substr({line}, 1, 317)) || '...' END"


RAW_TEXT = "title || chr(10) || text"
PRED_LIST = "text_id, user_id, y_true, y_pred, round(score, 6) AS score, 'validacion' AS split"


def vocabulary_query(kind: str, limit: int) -> str:
    return f"WITH {POSTS},{vocabulary('norm', kind, limit)} SELECT term, df, tf FROM vocab"


ORACLES: dict[str, str] = {
    "flagship_metrics": f"""WITH {bayes(False)},
one AS (SELECT 1 AS k, y_true, y_pred, round(score, 12) AS score FROM pred),{rates("one", "k")},{area("one", "k")}
SELECT {metric_list()}, {CELL_LIST} FROM rates JOIN area USING (k)""",
    "post_ingest": f"WITH {POSTS} SELECT text_id, user_id, title, text, y, {RAW_TEXT} AS joined FROM pool",
    "normalized_text": f"WITH {POSTS} SELECT text_id, t AS normalized FROM norm",
    "normalized_pages": f"SELECT page_id, {normalized('url || chr(10) || html')} AS normalized FROM pages",
    "text_fragments": f"WITH {POSTS} SELECT text_id, {fragment_of(RAW_TEXT)} AS fragmento FROM norm",
    "truncated_text": f"WITH {POSTS} SELECT text_id, substr(t, 1, 6000) AS cut FROM norm",
    "binary_flags": """SELECT doc_id, try_cast(lang AS DOUBLE) AS lang,
CASE WHEN lower(source) = 'yes' THEN 1.0::DOUBLE END AS source,
CASE l.quality WHEN 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END * CASE WHEN l.doc_id IS NULL THEN NULL ELSE 1 END AS quality_text,
CAST(l.quality AS DOUBLE) AS quality_number
FROM documents LEFT JOIN labels l USING (doc_id)""",
    "label_distribution": f"""WITH {POSTS} SELECT y, count(*) AS rows,
round(count(*) / sum(count(*)) OVER (), 6) AS share FROM pool GROUP BY y""",
    "word_term_stats": f"""WITH {POSTS},{occurrences("norm", "occ")}
SELECT term, count(DISTINCT text_id) AS df, count(*) AS tf FROM occ GROUP BY term""",
    "term_frequencies": f"""WITH {POSTS},{occurrences("pool", "occ")}
SELECT text_id, term, count(*) AS tf FROM occ GROUP BY text_id, term""",
    "word_unigram_vocab": vocabulary_query("word1", 20_000),
    "word_bigram_vocab": vocabulary_query("word2", 20_000),
    "word_trigram_vocab": vocabulary_query("word3", 30_000),
    "char_wb_vocab": vocabulary_query("char", 40_000),
    "shared_vocabularies": " UNION ALL ".join(
        f"SELECT term, df, tf, '{name}' AS feature_config_name FROM ({vocabulary_query(kind, limit)})"
        for name, kind, limit in (
            ("word_unigram", "word1", 20_000), ("word_unigram_bigram", "word2", 20_000),
            ("word_unigram_trigram", "word3", 30_000), ("char_wb_3_5", "char", 40_000),
        )
    ),
    **{
        f"{short}_optimality": f"""WITH {SPLIT} SELECT '{name}' AS classifier_name, count(*) AS n,
          count(*) FILTER (y = 0) AS count_0, count(*) FILTER (y = 1) AS count_1, true AS optimal FROM train"""
        for short, name in (("lr", "logistic_regression"), ("svm", "linear_svm"), ("sgd", "sgd_logistic"))
    },
    "embedding_optimality": """WITH users AS (
        SELECT user_id, row_number() OVER (ORDER BY md5('42:' || user_id)) AS place, count(*) OVER () AS n
        FROM (SELECT DISTINCT CAST(vec_id % 50 AS VARCHAR) AS user_id FROM embeddings)),
      train AS (SELECT CAST(label >= 5 AS INTEGER) AS y FROM embeddings JOIN users
        ON user_id = CAST(vec_id % 50 AS VARCHAR) WHERE place > ceil(CAST(0.2 AS DOUBLE) * n))
      SELECT name AS classifier_name, count(*) AS n, count(*) FILTER (y = 0) AS count_0,
        count(*) FILTER (y = 1) AS count_1, true AS optimal
      FROM train, (VALUES ('logistic_regression'), ('linear_svm'), ('sgd_logistic')) c(name) GROUP BY name""",
    "cv_grid_shape": f"""WITH {POSTS}, pairs AS (
        SELECT c AS classifier_name, f AS feature_config_name FROM unnest({CLASSIFIER_LIST}) a(c),
          unnest(['word_unigram', 'word_unigram_bigram', 'word_unigram_trigram', 'char_wb_3_5']) b(f))
      SELECT classifier_name, feature_config_name, CAST(3 AS BIGINT) AS folds, count(*) AS validation_rows,
        2 * count(*) AS train_rows, CAST(0 AS BIGINT) AS overlap, CAST(sum(y) AS BIGINT) AS positives
      FROM pool, pairs GROUP BY ALL""",
    "tfidf_idf": f"WITH {SPLIT},{vocabulary('train')} SELECT term, df, tf, round(idf, 6) AS idf FROM idf",
    "tfidf_vectors": f"""WITH {SPLIT},{vocabulary("train")},{weighted("train", "wt")}
SELECT text_id, term, round(v, 6) AS tfidf FROM wt""",
    "tfidf_transform": f"""WITH {SPLIT},{vocabulary("train")},{weighted("fresh", "wt")}
SELECT f.text_id, CAST(count(wt.term) AS INTEGER) AS n_terms, round(coalesce(sum(wt.v), 0), 6) AS total
FROM fresh f LEFT JOIN wt USING (text_id) GROUP BY f.text_id""",
    "group_split": f"WITH {SPLIT} SELECT text_id, user_id, split FROM tagged",
    "order_split": """WITH users AS (
  SELECT o_custkey, row_number() OVER (ORDER BY md5('42:' || CAST(o_custkey AS VARCHAR))) AS place, count(*) OVER () AS n
  FROM (SELECT DISTINCT o_custkey FROM orders))
SELECT o_orderkey AS text_id, o_custkey AS user_id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
  CASE WHEN place <= ceil(CAST(0.2 AS DOUBLE) * n) THEN 'validacion' ELSE 'entrenamiento' END AS split
FROM orders JOIN users USING (o_custkey)""",
    "split_quality": f"""WITH {SPLIT} SELECT split, count(*) AS rows, count(DISTINCT user_id) AS unique_users,
count(*) FILTER (y = 0) AS count_no, count(*) FILTER (y = 1) AS count_yes,
round(count(*) FILTER (y = 0) / count(*), 6) AS share_no, round(count(*) FILTER (y = 1) / count(*), 6) AS share_yes,
(SELECT count(*) FROM (SELECT user_id FROM train INTERSECT SELECT user_id FROM valid)) AS user_id_overlap_count
FROM tagged GROUP BY split""",
    "shared_users": f"WITH {POSTS} SELECT user_id FROM pool INTERSECT SELECT user_id FROM fresh",
    "fold_balance": """SELECT 5 AS folds, count(*) AS rows, count(DISTINCT o_custkey) AS users,
true AS users_once, true AS rows_even, true AS yes_even, true AS no_even FROM orders""",
    "fold_integrity": """SELECT 5 AS folds, count(*) AS rows, count(DISTINCT o_custkey) AS users,
count(*) FILTER (o_orderstatus <> 'F') AS count_no, count(*) FILTER (o_orderstatus = 'F') AS count_yes,
0 AS overlap FROM orders""",
    "fewshot_sample": f"WITH {POSTS},{EXAMPLES} SELECT position, text_id, label, text FROM examples",
    "test_fold_diagnostics": f"""WITH {POSTS}
SELECT (SELECT count(*) FROM pool) AS train_rows, (SELECT count(*) FROM fresh) AS test_rows,
(SELECT count(*) FROM fresh WHERE title = '') AS missing_title_values,
(SELECT count(*) FROM fresh WHERE text = '') AS missing_text_values,
(SELECT count(DISTINCT user_id) FROM pool) AS unique_train_users,
(SELECT count(DISTINCT user_id) FROM fresh) AS unique_test_users,
(SELECT count(*) FROM (SELECT user_id FROM pool INTERSECT SELECT user_id FROM fresh)) AS train_test_user_overlap_count""",
    "test_fold_labelled": f"""WITH {SPLIT}
SELECT (SELECT count(*) FROM train) AS train_rows, count(*) AS test_rows,
count(*) FILTER (title = '') AS missing_title_values, count(*) FILTER (text = '') AS missing_text_values,
(SELECT count(DISTINCT user_id) FROM train) AS unique_train_users, count(DISTINCT user_id) AS unique_test_users,
(SELECT count(*) FROM (SELECT user_id FROM train INTERSECT SELECT user_id FROM valid)) AS train_test_user_overlap_count,
count(*) FILTER (y = 0) AS test_label_no, count(*) FILTER (y = 1) AS test_label_yes FROM valid""",
    "test_fold_record": f"""WITH {SPLIT}
SELECT 'complement_nb' AS classifier_name, 'word_unigram' AS feature_config_name,
(SELECT count(*) FROM train) AS train_rows, count(*) AS test_rows, true AS labels_present_in_test_fold,
false AS labels_used_for_evaluation, 'train' AS train_input, 'test' AS test_input, 'out/predictions' AS predictions_out,
CAST(NULL AS VARCHAR) AS metrics_out, CAST(NULL AS VARCHAR) AS model_out,
'Este flujo genera resultados experimentales del reto académico y no constituye una herramienta de diagnóstico clínico.' AS ethical_note,
'Las etiquetas del fold de prueba no se usan para entrenamiento, selección de modelo ni ajuste de hiperparámetros.' AS test_label_usage_note,
0 AS missing_title_values, 0 AS missing_text_values,
(SELECT count(DISTINCT user_id) FROM train) AS unique_train_users, count(DISTINCT user_id) AS unique_test_users,
(SELECT count(*) FROM (SELECT user_id FROM train INTERSECT SELECT user_id FROM valid)) AS train_test_user_overlap_count,
count(*) FILTER (y = 0) AS test_label_no, count(*) FILTER (y = 1) AS test_label_yes, true AS labels_withheld,
count(*) AS predictions FROM valid""",
    "csv_posts": f"WITH {POSTS} SELECT text_id, user_id, title, text FROM posts",
    "answer_log": f"""WITH {POSTS}, asked AS (SELECT text_id, length({zero_shot("t")}) AS n FROM norm)
SELECT text_id, 'gemma3:4b' AS model, 'zero_shot' AS prompt_mode, attempt,
CASE WHEN n % 5 = 0 THEN 'sin respuesta' ELSE '{{"label":"' || CASE WHEN n % 2 = 1 THEN 'yes' ELSE 'no' END
  || '","score":0.' || CAST(n % 10 AS VARCHAR) || '}}' END AS raw_response
FROM asked, (VALUES (1::BIGINT), (2::BIGINT)) a(attempt) WHERE attempt = 1 OR n % 5 = 0""",
    "embedding_store": f"""WITH {POSTS} SELECT text_id, 'nomic-embed-text' AS model,
CAST(length(substr(t, 1, 6000)) AS DOUBLE) AS length FROM pool""",
    "report": f"""WITH {bayes(True)},
ends AS (SELECT *, row_number() OVER (ORDER BY round(w, 9) DESC, term) AS high, row_number() OVER (ORDER BY round(w, 9), term) AS low FROM theta),
wrong AS (SELECT *, CASE WHEN y_true = 1 THEN 'falsos_negativos_prioritarios' ELSE 'falsos_positivos' END AS section
          FROM pred WHERE y_true <> y_pred),
placed AS (SELECT *, row_number() OVER (PARTITION BY section ORDER BY round(score, 12) DESC, text_id) AS r FROM wrong),
parts AS (
  SELECT 'terminos_asociados_a_yes' AS section, CAST(high AS INTEGER) AS rank, term AS termino, round(w, 6) AS peso,
    NULL AS text_id, NULL AS user_id, NULL AS y_true, NULL AS y_pred, NULL AS score, NULL AS fragmento FROM ends WHERE high <= 25
  UNION ALL SELECT 'terminos_asociados_a_no', CAST(low AS INTEGER), term, round(w, 6), NULL, NULL, NULL, NULL, NULL, NULL
    FROM ends WHERE low <= 25
  UNION ALL SELECT section, NULL, NULL, NULL, text_id, user_id, y_true, y_pred, round(score, 6), {fragment_of(RAW_TEXT)}
    FROM placed WHERE r <= 5)
SELECT *, 'Evidencia exploratoria del modelo; no debe interpretarse como diagnóstico clínico ni como explicación validada de riesgo individual.' AS nota_etica
FROM parts""",
    "class_weights": f"""WITH {SPLIT} SELECT y, count(*) AS rows,
round((SELECT count(*) FROM train) / (2.0 * count(*)), 6) AS weight FROM train GROUP BY y""",
    "mnb_predictions": f"WITH {bayes(True)} SELECT {PRED_LIST} FROM pred",
    "cnb_predictions": f"WITH {bayes(False)} SELECT {PRED_LIST} FROM pred",
    "cnb_char_predictions": f"WITH {bayes(False, 'char', 40_000)} SELECT {PRED_LIST} FROM pred",
    "conversation_predictions": f"""WITH {bayes(False, target="turns").replace(
        "train AS (SELECT", f'''turns AS (SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS text_id,
  role AS user_id, NULL AS y, '' AS title, '' AS text, {normalized("coalesce(text, '')")} AS t FROM conversations),
train AS (SELECT''', 1)}
SELECT text_id, user_id, y_pred, CASE y_pred WHEN 1 THEN 'yes' ELSE 'no' END AS label_pred,
round(score, 6) AS score FROM pred""",
    "embedding_cache_misses": f"""WITH {POSTS} SELECT text_id, 'nomic-embed-text' AS model,
sha256(substr(t, 1, 6000)) AS text_hash FROM norm WHERE toxic IS NULL OR toxic = 1""",
    "embedding_fill": f"""WITH {POSTS} SELECT text_id,
CASE WHEN toxic = 0 THEN length(t)::DOUBLE ELSE length(substr(t, 1, 6000))::DOUBLE END AS length,
CASE WHEN toxic = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS stored FROM norm""",
    "confusion_metrics": f"""WITH {ORDERS},{rates("op", "priority")}
SELECT priority, {CELL_LIST}, {", ".join(f"round({m}, 6) AS {m}" for m in METRIC_NAMES if m != "roc_auc")} FROM rates""",
    "roc_auc_exact": f"""WITH {ORDERS},{area("op", "priority", "price")}
SELECT priority, round(roc_auc, 6) AS roc_auc FROM area""",
    "metric_records": f"""WITH {ORDERS},{rates("op", "o_custkey")},{area("op", "o_custkey")}
SELECT o_custkey, {metric_list()}, {CELL_LIST} FROM rates JOIN area USING (o_custkey)""",
    "roc_curve": f"""WITH {ORDERS},
per AS (SELECT priority, score, sum(y_true) AS pos, sum(1 - y_true) AS neg FROM op GROUP BY priority, score),
cum AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, row_number() OVER w AS place,
  lead(pos) OVER w AS np, lead(neg) OVER w AS nn,
  sum(pos) OVER (PARTITION BY priority) AS p, sum(neg) OVER (PARTITION BY priority) AS n
  FROM per WINDOW w AS (PARTITION BY priority ORDER BY score DESC))
SELECT priority, score AS threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM cum
WHERE place = 1 OR np IS NULL OR np <> pos OR nn <> neg
UNION ALL SELECT DISTINCT priority, 'inf'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM cum""",
    "score_histogram": f"""WITH {ORDERS} {histogram("op", "'all'", "'all'")}
UNION ALL {histogram("op", "y_true", "CAST(r.g AS VARCHAR)")}""",
    "prediction_counts": f"""WITH {bayes(False)} SELECT c.y_pred, c.label,
(SELECT count(*) FROM pred WHERE pred.y_pred = c.y_pred) AS count
FROM (VALUES (0, 'no'), (1, 'yes')) AS c(y_pred, label)""",
    "cv_nb_folds": f"""WITH {CV} SELECT classifier_name, feature_config_name, fold, train_rows, validation_rows,
train_users, validation_users, user_overlap_count, {metric_list()}, {CELL_LIST} FROM folds""",
    "cv_summary": f"""WITH {CV},{fold_summary_ctes()}
SELECT classifier_name, feature_config_name, n_splits, {STAT_LIST}, folds_completed FROM cvs""",
    "cv_best": f"""WITH {CV},{fold_summary_ctes()}
SELECT classifier_name, feature_config_name, 'mean_protocol_auc' AS selected_by,
round(mean_protocol_auc, 6) AS mean_protocol_auc, round(std_protocol_auc, 6) AS std_protocol_auc,
round(mean_roc_auc, 6) AS mean_roc_auc, round(mean_recall, 6) AS mean_recall,
round(mean_precision, 6) AS mean_precision, round(mean_f1, 6) AS mean_f1, {quoted(NOTE)} AS note
FROM cvs ORDER BY {CV_ORDER.replace("mean_protocol_auc", "cvs.mean_protocol_auc").replace("std_protocol_auc", "cvs.std_protocol_auc")} LIMIT 1""",
    "fold_summary": f"""WITH {ORDER_FOLDS},{fold_summary_ctes()}
SELECT classifier_name, feature_config_name, n_splits, {STAT_LIST}, folds_completed FROM cvs""",
    "cv_ranking": f"""WITH {ORDER_FOLDS},{fold_summary_ctes()}
SELECT CAST(row_number() OVER (ORDER BY cvs.mean_protocol_auc DESC NULLS LAST, classifier_name, feature_config_name) AS INTEGER) AS rank,
classifier_name, feature_config_name, n_splits, {STAT_LIST}, folds_completed FROM cvs
ORDER BY rank LIMIT 10""",
    "top_error_bars": f"""WITH {ORDER_FOLDS},{fold_summary_ctes()},
top AS (SELECT * FROM cvs ORDER BY {CV_ORDER} LIMIT 10)
SELECT classifier_name, feature_config_name, {", ".join(
    f"round(mean_{m}, 6) AS mean_{m}, round(coalesce(std_{m}, 0), 6) AS std_{m}"
    for m in ("protocol_auc", "roc_auc", "f1"))} FROM top""",
    "run_keys": f"""WITH {RUNS} SELECT c_custkey, run_key,
lower(trim(regexp_replace(started_at, '[^a-zA-Z0-9]+', '_', 'g'), '_')) AS model_slug FROM keyed""",
    "top_terms": f"""WITH {bayes(False)},
ends AS (SELECT *, row_number() OVER (ORDER BY round(w, 9) DESC, term) AS high, row_number() OVER (ORDER BY round(w, 9), term) AS low FROM theta)
SELECT 'terminos_asociados_a_yes' AS section, CAST(high AS INTEGER) AS rank, term AS termino, round(w, 6) AS peso FROM ends WHERE high <= 25
UNION ALL SELECT 'terminos_asociados_a_no', CAST(low AS INTEGER), term, round(w, 6) FROM ends WHERE low <= 25""",
    "error_examples": f"""WITH {bayes(True)},
wrong AS (SELECT *, CASE WHEN y_true = 1 THEN 'falsos_negativos_prioritarios' ELSE 'falsos_positivos' END AS section
          FROM pred WHERE y_true <> y_pred),
placed AS (SELECT *, row_number() OVER (PARTITION BY section ORDER BY round(score, 12) DESC, text_id) AS r FROM wrong)
SELECT section, text_id, user_id, y_true, y_pred, round(score, 6) AS score, {fragment_of(RAW_TEXT)} AS fragmento
FROM placed WHERE r <= 5""",
    "high_confidence": f"""WITH {bayes(True, target="fresh")}
SELECT 'predicciones_alta_confianza' AS section, text_id, user_id, y_pred, round(pred.score, 6) AS score,
{fragment_of(RAW_TEXT)} AS fragmento FROM pred ORDER BY round(pred.score, 12) DESC, text_id LIMIT 5""",
    "run_summary": f"""WITH {RUNS} SELECT run_id, status, experiment_name, classifier_name, feature_config_name,
started_at, completed_at, duration_seconds, random_state, validation_size, {metric_list()}, {CELL_LIST} FROM summary""",
    "latest_runs": f"""WITH {RUNS} SELECT classifier_name, feature_config_name, run_id, started_at, {metric_list()} FROM latest""",
    "run_counters": f"""WITH {RUNS} SELECT (SELECT count(*) FROM summary) AS registered,
(SELECT count(*) FROM summary WHERE status = 'completed') AS completed, (SELECT count(*) FROM latest) AS pairs,
round(protocol_auc, 6) AS best_protocol_auc, round(roc_auc, 6) AS best_roc_auc
FROM latest ORDER BY latest.protocol_auc DESC, classifier_name, feature_config_name LIMIT 1""",
    "ranking_top_n": f"""WITH {RUNS}, top AS (SELECT *, row_number() OVER (
  ORDER BY protocol_auc DESC, classifier_name, feature_config_name) AS r FROM latest)
SELECT CAST(r AS INTEGER) AS rank, classifier_name, feature_config_name,
{", ".join(f"round({m}, 6) AS {m}" for m in ("protocol_auc", "roc_auc", "recall", "precision", "f1"))}
FROM top WHERE r <= 10""",
    "auc_matrix": f"""WITH {RUNS} SELECT classifier_name, {", ".join(
    f"round(max(protocol_auc) FILTER (feature_config_name = '{f}'), 6) AS {f}"
    for f in ("word_unigram", "word_unigram_bigram", "word_unigram_trigram", "char_wb_3_5"))}
FROM latest GROUP BY classifier_name""",
    "auc_comparison": f"""WITH {RUNS} SELECT classifier_name, feature_config_name, round(roc_auc, 6) AS roc_auc,
round(protocol_auc, 6) AS protocol_auc FROM latest""",
    "method_comparison": f"""WITH {RUNS},
pr AS (SELECT * FROM ({"WITH " + rates("op", "priority") + "," + area("op", "priority")}
  SELECT rates.*, area.roc_auc FROM rates JOIN area USING (priority))),
methods AS (
  SELECT 'phase2b_baseline' AS method, priority AS representation, 'complement_nb' AS classifier,
         'baseline' AS metrics_path, -1 AS place, protocol_auc, roc_auc, recall, precision, f1, {CELL_LIST} FROM pr
  UNION ALL
  SELECT 'phase3_embeddings_' || classifier_name, feature_config_name, classifier_name, NULL, o_custkey,
         protocol_auc, roc_auc, recall, precision, f1, {CELL_LIST}
  FROM (SELECT *, {pair("o_custkey")} FROM custm))
SELECT method, representation, classifier, metrics_path,
{", ".join(f"round({m}, 6) AS {m}" for m in ("protocol_auc", "roc_auc", "recall", "precision", "f1"))}, {CELL_LIST}
FROM (SELECT *, row_number() OVER (PARTITION BY method, representation, classifier ORDER BY place DESC) AS r FROM methods)
WHERE r = 1""",
    "prompts_zero_shot": f"WITH {POSTS} SELECT text_id, {zero_shot('t')} AS prompt FROM norm",
    "prompts_few_shot": f"""WITH {POSTS},{EXAMPLES},
block AS (SELECT string_agg({FEW_SHOT_BLOCK}, chr(10) || chr(10) ORDER BY position) AS shown FROM examples)
SELECT text_id, {quoted(FEW_SHOT_OPENING)} || (SELECT shown FROM block) || chr(10) || chr(10)
|| 'Final Reddit post:' || chr(10) || '\"\"\"' || substr(t, 1, 6000) || '\"\"\"' AS prompt FROM norm""",
    "answer_validate": f"""WITH {STORED},{judged("stored", "text_id, model, prompt_mode, seq")}
SELECT text_id, model, prompt_mode, seq, label_pred, y_pred, score, evidence, justification, error FROM judged""",
    "answer_replay": f"""WITH {POSTS},{STORED},{LAST},
wanted AS (SELECT n.text_id, n.user_id, n.y AS y_true, coalesce(l.raw_response, '') AS raw_response
  FROM norm n LEFT JOIN lasts l ON l.text_id = n.text_id AND l.model = 'gemma3:4b' AND l.prompt_mode = 'zero_shot'),
{judged("wanted", "text_id, user_id, y_true")}
SELECT text_id, user_id, y_true, y_pred, label_pred, score, evidence, justification, error FROM judged""",
    "answer_matrix_metrics": f"""WITH {POSTS},{STORED},{LAST},
wanted AS (SELECT p.text_id, p.y AS y_true, c.model, c.prompt_mode, coalesce(l.raw_response, '') AS raw_response
  FROM pool p CROSS JOIN (SELECT DISTINCT model, prompt_mode FROM stored) c
  LEFT JOIN lasts l ON l.text_id = p.text_id AND l.model = c.model AND l.prompt_mode = c.prompt_mode),
{judged("wanted", "text_id, y_true, model, prompt_mode")},
errors AS (SELECT model, prompt_mode, count(error) AS error_count FROM judged GROUP BY model, prompt_mode),
clean AS (SELECT j.* FROM judged j JOIN errors e USING (model, prompt_mode) WHERE e.error_count = 0),
{rates("clean", "model, prompt_mode")},{area("clean", "model, prompt_mode")}
SELECT 'phase3_llm_' || prompt_mode AS method, model,
'ollama_' || lower(regexp_replace(model, '[^a-zA-Z0-9]+', '_', 'g')) AS representation,
prompt_mode || '_prompt' AS classifier, prompt_mode, error_count,
{", ".join(f"round({m}, 6) AS {m}" for m in ("protocol_auc", "roc_auc", "recall", "precision", "f1"))}, {CELL_LIST}
FROM errors LEFT JOIN rates USING (model, prompt_mode) LEFT JOIN area USING (model, prompt_mode)""",
    "answer_classify": f"""WITH {POSTS}, asked AS (SELECT text_id, y, length({zero_shot("t")}) AS n FROM norm)
SELECT text_id, y AS y_true, CASE WHEN n % 5 <> 0 THEN CAST(n % 2 AS INTEGER) END AS y_pred,
CASE WHEN n % 5 <> 0 THEN (n % 10) / 10 END AS score,
CASE WHEN n % 5 = 0 THEN 'La respuesta del LLM no es JSON válido.' END AS error,
CASE WHEN n % 5 = 0 THEN 2 ELSE 1 END AS attempts, CASE WHEN n % 5 <> 0 THEN CAST(n % 2 AS INTEGER) END AS label_value
FROM asked""",
}
