"""DuckDB oracle SQL for the registered queries (same names and columns)."""

from __future__ import annotations

from corpusflow.functions import rules as R
from corpusflow.operators import borders as BD
from corpusflow.operators import filters as FL
from corpusflow.plans import fixtures as FX
from corpusflow.plans import sqltext as S

q = R.sql_str


def _normalized(units: str) -> str:
    return f"""
SELECT doc_id, line_no, classifier, source_lang, target_lang,
       {S.normalize('source', 'source_lang', True)} AS source,
       {S.normalize('target', 'target_lang', True)} AS target
FROM ({units}) f1"""


NORMALIZE_LINES = f"SELECT doc_id, line_no, source_lang, source, target FROM ({_normalized(S.F1)}) n"


def _leader(c):
    return f"regexp_matches({c}, {q(R.LEADER_PATTERN)})"


def _cleaned() -> str:
    inside = " OR ".join(f"(source_lang IN ('{a}', '{b}') AND target_lang IN ('{a}', '{b}'))" for a, b in FX.UNIT_PAIRS)
    reason = f"""CASE
  WHEN NOT ({inside}) THEN '{FL.NOT_IN_PAIR}'
  WHEN source_lang = target_lang THEN '{FL.SAME_LANGUAGE}'
  WHEN source IS NULL OR target IS NULL THEN '{FL.NULL_TEXT}'
  WHEN {_leader('source')} OR {_leader('target')} THEN '{FL.LEADER_CHARS}'
  WHEN {S.py_strip('source')} IN (source_lang, target_lang) OR {S.py_strip('target')} IN (source_lang, target_lang) THEN '{FL.SUSPICIOUS}'
  ELSE NULL END"""
    return f"""
SELECT doc_id, line_no, classifier, source, target, source_lang || '-' || target_lang AS langs,
       {S.translation_id('classifier', 'source', 'target')} AS id, {reason} AS reject_reason
FROM ({_normalized(S.units_sql())}) n"""


CLEAN_PAIRS = f"""SELECT doc_id, line_no, id, classifier, source, target, langs
FROM ({_cleaned()}) c WHERE reject_reason IS NULL"""

REJECT_COUNTS = f"""SELECT coalesce(reject_reason, 'kept') AS reason, count(*) AS n
FROM ({_cleaned()}) c GROUP BY ALL"""

DEDUP_PAIRS = f"""SELECT DISTINCT id, classifier, source, target, langs FROM ({S.CORPUS}) c"""

SEGMENT_STATS = f"""
WITH kept AS (SELECT DISTINCT id, classifier, source, target, langs FROM ({CLEAN_PAIRS}) c),
sides AS (
  SELECT classifier, split_part(langs, '-', 1) AS lang, source AS text FROM kept
  UNION ALL
  SELECT classifier, split_part(langs, '-', 2) AS lang, target AS text FROM kept)
SELECT classifier, lang, count(*) AS n_sentences,
       CAST(sum(len(string_split(text, ' '))) AS BIGINT) AS n_words
FROM sides GROUP BY ROLLUP (classifier, lang)"""

ALPHA_TOKENS = f"""
SELECT doc_id, CAST(pos - 1 AS BIGINT) AS pos, word FROM (
  SELECT doc_id, unnest(toks) AS word, unnest(range(1, len(toks) + 1)) AS pos
  FROM (SELECT doc_id, {S.alpha_tokens('text')} AS toks FROM documents) d) x"""

ORACLE = {
    "normalize_lines": NORMALIZE_LINES,
    "translation_ids": f"SELECT id, classifier, source, target, langs FROM ({S.CORPUS}) c",
    "clean_pairs": CLEAN_PAIRS,
    "reject_counts": REJECT_COUNTS,
    "dedup_rows": f"SELECT DISTINCT * FROM ({S.CORPUS}) c",
    "dedup_pairs": DEDUP_PAIRS,
    "segment_stats": SEGMENT_STATS,
    "alpha_tokens": ALPHA_TOKENS,
}


# --- language identification and spelling ------------------------------------
from corpusflow.operators import langid as LID  # noqa: E402


def _grams_sql(src: str, text: str, extra: str, where: str = "TRUE") -> str:
    return (f"SELECT {extra}, length(p) - 2 AS g, substring(p, i, 3) AS gram FROM "
            f"(SELECT *, ' ' || lower({text}) || ' ' AS p FROM {src} WHERE {text} IS NOT NULL AND {where}) x, "
            f"LATERAL (SELECT unnest(range(1, length(p) - 1)) AS i) r")


PROFILE = f"""
WITH g AS ({_grams_sql('documents', 'text', 'lang', 'lang IS NOT NULL')}),
c AS (SELECT lang, gram, count(*) AS cnt FROM g GROUP BY lang, gram)
SELECT lang, gram, cnt,
       ln((cnt + 1) / (sum(cnt) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang))) AS logp,
       ln(1.0 / (sum(cnt) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang))) AS unseen_logp
FROM c"""

LANG_PROFILE = f"SELECT lang, gram, cnt, round(logp, 6) AS logp, round(unseen_logp, 6) AS unseen_logp FROM ({PROFILE}) p"


def detect_sql(texts_sql: str) -> str:
    """Detected language per distinct text: columns ``t, detected``."""
    return f"""
WITH prof AS ({PROFILE}),
texts AS (SELECT DISTINCT t FROM ({texts_sql}) s WHERE t IS NOT NULL),
g AS ({_grams_sql('texts', 't', 't')}),
s AS (SELECT t, g, lang, sum(logp - unseen_logp) + any_value(unseen_logp) * g AS score
      FROM g JOIN prof USING (gram) GROUP BY t, g, lang),
r AS (SELECT t, g, lang, score,
             row_number() OVER (PARTITION BY t ORDER BY score DESC, lang) AS rk,
             lead(score) OVER (PARTITION BY t ORDER BY score DESC, lang) AS second
      FROM s)
SELECT t, CASE WHEN second IS NULL OR (score - second) / g >= {LID.DEFAULT_MARGIN} THEN lang END AS detected
FROM r WHERE rk = 1"""


LANG_DETECT = f"""
SELECT f.doc_id, f.line_no, f.source_lang AS lang, d.detected
FROM ({S.F1}) f LEFT JOIN ({detect_sql(f'SELECT source AS t FROM ({S.F1}) f1')}) d ON f.source = d.t"""

LEXICON = f"""
SELECT lang, word FROM (
  SELECT DISTINCT lang, lower(w) AS word, doc_id FROM (
    SELECT lang, doc_id, unnest({S.alpha_tokens('text')}) AS w FROM documents) a) b
GROUP BY lang, word HAVING count(*) >= 3"""


def _form(w: str) -> str:
    cap = f"upper(substring({w}, 1, 1)) || lower(substring({w}, 2))"
    return f"CASE WHEN {w} = upper({w}) OR {w} = {cap} THEN lower({w}) ELSE {w} END"


MISSPELT = f"""
WITH kept AS ({CLEAN_PAIRS}),
sides AS (SELECT id, split_part(langs, '-', 1) AS lang, source AS text FROM kept
          UNION ALL SELECT id, split_part(langs, '-', 2) AS lang, target AS text FROM kept),
toks AS (SELECT id, lang, unnest({S.alpha_tokens('text')}) AS word FROM sides),
lex AS ({LEXICON})
SELECT id, lang, word FROM toks
WHERE NOT EXISTS (SELECT 1 FROM lex WHERE lex.lang = toks.lang AND lex.word = {_form('toks.word')})"""

MISSPELT_WORDS = f"SELECT lang, word, count(*) AS count FROM ({MISSPELT}) m GROUP BY lang, word"
MISSPELT_SENTENCES = f"""SELECT lang, id AS translation_id, array_to_string(list_sort(list_distinct(list(word))), ', ') AS words
FROM ({MISSPELT}) m GROUP BY lang, id"""
SPELLING_GATE = f"""SELECT doc_id, line_no, id, classifier, source, target, langs FROM ({CLEAN_PAIRS}) c
WHERE id NOT IN (SELECT id FROM ({MISSPELT}) m)"""

LANG_GATE = f"""WITH kept AS ({CLEAN_PAIRS}), det AS ({detect_sql('SELECT source AS t FROM kept UNION ALL SELECT target FROM kept')})
SELECT k.* FROM kept k JOIN det a ON a.t = k.source JOIN det b ON b.t = k.target
WHERE a.detected = split_part(k.langs, '-', 1) AND b.detected = split_part(k.langs, '-', 2)"""

ORACLE.update({
    "lang_gate": LANG_GATE,
    "lang_profile": LANG_PROFILE,
    "lang_detect": LANG_DETECT,
    "lexicon": LEXICON,
    "misspelt_words": MISSPELT_WORDS,
    "misspelt_sentences": MISSPELT_SENTENCES,
    "spelling_gate": SPELLING_GATE,
})


# --- splitting ------------------------------------------------------------------

def _flag_sql(base: str) -> str:
    return f"""(SELECT *, rk <= ceil(CAST(0.1 AS DOUBLE) * n) AS held FROM (
  SELECT *, row_number() OVER (PARTITION BY split_n ORDER BY h, id, langs) AS rk,
         count(*) OVER (PARTITION BY split_n) AS n
  FROM (SELECT *, md5(concat_ws('|', '42', CAST(split_n AS VARCHAR), md5(concat_ws(chr(31), source, target)))) AS h
        FROM {base} WHERE classifier = 'Health') a) b)"""


def _split_sql(base: str, valid_label: str) -> str:
    """Rows (split_n, label, id, classifier, source, target, langs) of one classified split."""
    cols = "split_n, id, classifier, source, target, langs"
    return f"""(WITH flag AS {_flag_sql(base)},
train AS (SELECT {cols} FROM flag WHERE NOT held
          UNION ALL SELECT {cols} FROM {base} WHERE classifier = 'Unknown'),
test AS (SELECT {cols} FROM flag h WHERE held AND NOT EXISTS (
          SELECT 1 FROM train t WHERE t.split_n = h.split_n AND t.source = h.source AND t.target = h.target))
SELECT 'train' AS label, {cols} FROM train UNION ALL SELECT '{valid_label}' AS label, {cols} FROM test)"""


SPLIT_BASE = f"(SELECT *, 0 AS split_n FROM ({DEDUP_PAIRS}) d)"

HOLDOUT = f"SELECT id, langs, held FROM {_flag_sql(SPLIT_BASE)} f"

CLASSIFIED_SPLIT = f"SELECT CAST(split_n AS INTEGER) AS split_n, label, id FROM {_split_sql(SPLIT_BASE, 'test')} s"

REPEATED_SPLITS = f"""
WITH first AS {_split_sql(SPLIT_BASE, 'test')},
draws AS (SELECT f.id, f.classifier, f.source, f.target, f.langs, g.split_n
          FROM first f, (SELECT unnest(generate_series(1, 10)) AS split_n) g WHERE f.label = 'train')
SELECT CAST(split_n AS INTEGER) AS split_n, label, id FROM first WHERE label = 'test'
UNION ALL
SELECT CAST(split_n AS INTEGER) AS split_n, label, id FROM {_split_sql('draws', 'valid')} s"""

ORACLE.update({
    "holdout": HOLDOUT,
    "classified_split": CLASSIFIED_SPLIT,
    "repeated_splits": REPEATED_SPLITS,
})


# --- translation metrics ------------------------------------------------------------

def _ws_split(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, {q(R.WS + '+')}), lambda t: t <> '')"


def _tok13a(x: str) -> str:
    y = f"replace(replace(replace({x}, '<skipped>', ''), '-' || chr(10), ''), chr(10), ' ')"
    for old, new in R.TOK13A_ENTITIES:
        y = f"replace({y}, {q(old)}, {q(new)})"
    y = f"(' ' || {y} || ' ')"
    for pat, rep in R.TOK13A_RULES:
        y = R.sql_regexp_replace(y, pat, rep)
    return _ws_split(y)


def _gram_rows(tcol: str, side_h: int, n_max: int, char: bool) -> str:
    if char:
        g, ln = f"substring({tcol}, i, n)", f"length({tcol})"
    else:
        g, ln = f"array_to_string({tcol}[i:i + n - 1], ' ')", f"len({tcol})"
    return (f"SELECT seg, n, {g} AS g, {side_h} AS h, {1 - side_h} AS r FROM t, "
            f"(SELECT unnest(range(1, {n_max + 1})) AS n) o, "
            f"LATERAL (SELECT unnest(range(1, {ln} - n + 2)) AS i) x")


def _match_sql(n_max: int, char: bool) -> str:
    cols = ", ".join(f"coalesce(max(CASE WHEN n = {n} THEN {c} END), 0)::DOUBLE AS {c}{n}"
                     for n in range(1, n_max + 1) for c in ("match", "hyp_n", "ref_n"))
    return f"""(SELECT {cols} FROM (
  SELECT n, sum(m) AS match, sum(CASE WHEN {int(char)} = 0 OR r > 0 THEN h ELSE 0 END) AS hyp_n, sum(r) AS ref_n
  FROM (SELECT seg, n, sum(least(h, r)) AS m, sum(h) AS h, sum(r) AS r FROM (
    SELECT seg, n, g, sum(h) AS h, sum(r) AS r FROM (
      {_gram_rows('a', 1, n_max, char)} UNION ALL {_gram_rows('b', 0, n_max, char)}) u
    GROUP BY seg, n, g) pg GROUP BY seg, n) sg GROUP BY n) m)"""


def _bleu_sql() -> str:
    logs, zeros = [], []
    for n in range(1, 5):
        zeros.append(f"(match{n} = 0)::INT")
        z = " + ".join(zeros)
        logs.append(f"ln(CASE WHEN match{n} = 0 THEN 100.0 / (pow(2, {z}) * hyp_n{n}) ELSE 100.0 * match{n} / hyp_n{n} END)")
    bp = "CASE WHEN sys_len >= ref_len THEN 1.0 WHEN sys_len > 0 THEN exp(1 - ref_len / sys_len) ELSE 0.0 END"
    return f"""
WITH t AS (SELECT (doc_id, line_no) AS seg, {_tok13a('hyp')} AS a, {_tok13a('ref')} AS b FROM ({S.F5}) f5),
l AS (SELECT sum(len(a))::DOUBLE AS sys_len, sum(len(b))::DOUBLE AS ref_len FROM t),
m AS {_match_sql(4, False)}
SELECT round(CASE WHEN hyp_n4 = 0 THEN 0.0 ELSE ({bp}) * exp(({' + '.join(logs)}) / 4) END, 6) AS bleu,
       round(sys_len, 6) AS sys_len, round(ref_len, 6) AS ref_len
FROM l, m"""


def _chrf_sql() -> str:
    ps, rs, es = [], [], []
    for n in range(1, 7):
        both = f"(hyp_n{n} > 0 AND ref_n{n} > 0)"
        ps.append(f"CASE WHEN {both} THEN match{n} / hyp_n{n} ELSE 0 END")
        rs.append(f"CASE WHEN {both} THEN match{n} / ref_n{n} ELSE 0 END")
        es.append(f"{both}::INT")
    nospace = lambda c: f"regexp_replace({c}, {q(R.WS + '+')}, '', 'g')"
    return f"""
WITH t AS (SELECT (doc_id, line_no) AS seg, {nospace('hyp')} AS a, {nospace('ref')} AS b FROM ({S.F5}) f5),
m AS {_match_sql(6, True)},
s AS (SELECT ({' + '.join(ps)}) AS ps, ({' + '.join(rs)}) AS rs, ({' + '.join(es)}) AS eff FROM m),
a AS (SELECT CASE WHEN eff > 0 THEN ps / eff ELSE 0 END AS ap, CASE WHEN eff > 0 THEN rs / eff ELSE 0 END AS ar FROM s)
SELECT round(CASE WHEN ap + ar > 0 THEN 100.0 * 5 * ap * ar / (4 * ap + ar) ELSE 0.0 END, 6) AS chrf FROM a"""


# The hypothesis is the reference without some words, so the word distance of a
# segment is the difference in length (no edit script is shorter, and deleting
# them is one) and its words are the hits; unit tests hold the distance itself
# against the plain recurrence.
_LENGTHS = f"""(SELECT CAST(sum(len({_ws_split('ref')})) AS DOUBLE) AS n, CAST(sum(len({_ws_split('hyp')})) AS DOUBLE) AS m FROM ({S.F5}) f5)"""
WER = f"SELECT round((n - m) / n, 6) AS wer FROM {_LENGTHS} e"
EDIT_RATE = f"SELECT round(100.0 * (n - m) / n, 6) AS edit_rate FROM {_LENGTHS} e"
MER_WIL = f"SELECT round((n - m) / n, 6) AS mer, round(1 - (m / n) * (m / m), 6) AS wil FROM {_LENGTHS} e"
SCORE_TABLE = " UNION ALL ".join([
    f"SELECT 'BLEU' AS metric, bleu AS score FROM ({_bleu_sql()}) x", f"SELECT 'CHRF', chrf FROM ({_chrf_sql()}) x",
    f"SELECT 'TER', edit_rate FROM ({EDIT_RATE}) x", f"SELECT 'WER', wer FROM ({WER}) x",
    f"SELECT 'MER', mer FROM ({MER_WIL}) x", f"SELECT 'WIL', wil FROM ({MER_WIL}) x"])

# Edits, distance, hits and words of either side follow from the kind of edit:
# words are distinct, so nothing cheaper turns one side into the other.
WORD_EDITS = f"""WITH f AS (SELECT CAST((doc_id + line_no) % 5 AS INTEGER) AS kind, len(list_distinct(regexp_extract_all(target, '[a-z]+'))) AS n FROM ({S.F1}) f1),
e AS (SELECT kind, n, CASE WHEN kind = 0 AND n BETWEEN 2 AND 50 THEN 1 WHEN kind = 4 AND n BETWEEN 7 AND 50 THEN 3 ELSE 0 END AS k FROM f WHERE n > 0),
d AS (SELECT kind, n AS n, CASE kind WHEN 2 THEN n - 1 WHEN 3 THEN n + 1 ELSE n END AS m,
             CASE WHEN k > 0 THEN 1 WHEN kind IN (1, 2, 3) THEN 1 ELSE 0 END AS moved,
             CASE WHEN k > 0 THEN 2 * k WHEN kind IN (1, 2, 3) THEN 1 ELSE 0 END AS dist,
             CASE WHEN k > 0 THEN n - k WHEN kind IN (1, 2) THEN n - 1 ELSE n END AS hits FROM e),
t AS (SELECT kind, sum(n)::DOUBLE AS n, sum(m)::DOUBLE AS m, sum(moved) AS moved, sum(dist) AS dist, sum(hits)::DOUBLE AS hits FROM d GROUP BY kind)
SELECT kind, 'TER' AS metric, round(100 * moved / n, 6) AS score FROM t UNION ALL SELECT kind, 'WER', round(dist / n, 6) FROM t
UNION ALL SELECT kind, 'MER', round(dist / (hits + dist), 6) FROM t UNION ALL SELECT kind, 'WIL', round(1 - (hits / n) * (hits / m), 6) FROM t"""

ORACLE.update({
    "word_edits": WORD_EDITS,
    "bleu": _bleu_sql(),
    "chrf": _chrf_sql(),
    "wer": WER,
    "edit_rate": EDIT_RATE,
    "mer_wil": MER_WIL,
    "score_table": SCORE_TABLE,
})


# --- training logs -------------------------------------------------------------------
F3 = """(SELECT CASE WHEN event_type = 'error' THEN ['click', 'purchase', 'signup', 'view'][(user_id % 4) + 1]
            ELSE event_type END AS job,
       event_id AS line_no, date_trunc('second', ts) AS ts, event_type = 'error' AS is_valid,
       CAST(event_id // 1000 + 1 AS INTEGER) AS epoch, event_id + 1 AS up,
       (event_id + 1) * 1000 + user_id AS sen, round(value, 2) AS cost, round(value, 2) AS time_s,
       round(value * 100, 2) AS wps, 3e-4 * (user_id % 5 + 1) AS lr,
       CASE WHEN user_id % 3 = 0 THEN 0 ELSE CAST(user_id % 3 AS INTEGER) END AS stalled
FROM events)"""

LOG_PARSE = f"""SELECT job, line_no, ts, epoch, up, sen, round(cost, 6) AS cost, round(time_s, 6) AS time_s,
       round(wps, 6) AS wps, round(lr, 6) AS lr FROM {F3} f WHERE NOT is_valid"""

VALID_PARSE = f"""SELECT job, line_no, ts, epoch, up, 'bleu-detok' AS metric, round(cost, 6) AS value, stalled
FROM {F3} f WHERE is_valid"""

SEN_DIFF = f"""SELECT job, line_no, sen - coalesce(lag(sen) OVER (PARTITION BY job ORDER BY line_no), 0) AS sen_diff
FROM {F3} f WHERE NOT is_valid"""

ADJUSTED = f"""(WITH g AS (SELECT job, line_no, ts, epoch_us(ts) AS t,
                          epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY job ORDER BY line_no) AS gap FROM {F3} f),
s AS (SELECT *, sum(CASE WHEN gap <= 1200000000 THEN gap ELSE 0 END) OVER w AS ss,
                sum(CASE WHEN gap <= 1200000000 THEN 1 ELSE 0 END) OVER w AS nn
      FROM g WINDOW w AS (PARTITION BY job ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
c AS (SELECT *, sum(CASE WHEN gap > 1200000000
                         THEN gap - CASE WHEN nn > 0 THEN CAST(round(CAST(ss AS DOUBLE) / nn) AS BIGINT) ELSE 0 END
                         ELSE 0 END) OVER w AS gg
      FROM s WINDOW w AS (PARTITION BY job ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT job, line_no, ts, CAST(gap AS DOUBLE) / CAST(1000000 AS DOUBLE) AS gap,
       CAST(t - gg AS DOUBLE) / CAST(1000000 AS DOUBLE) AS adj_ts FROM c)"""

PAUSE_ADJUSTED = f"SELECT job, line_no, round(gap, 6) AS gap, round(adj_ts, 6) AS adj_ts FROM {ADJUSTED} a"

RUN_DURATION = f"SELECT job, round((epoch(max(ts)) - epoch(min(ts))) / 3600.0, 6) AS hours FROM {F3} f GROUP BY job"

BEST_UPDATE = f"""SELECT job, first(up ORDER BY cost DESC, line_no ASC) AS best_up, round(max(cost), 6) AS best_value
FROM {F3} f WHERE is_valid GROUP BY job"""

SCALARS = f"""
WITH a AS {ADJUSTED},
t AS (SELECT f.*, a.adj_ts, f.sen - coalesce(lag(f.sen) OVER (PARTITION BY f.job ORDER BY f.line_no), 0) AS sen_diff
      FROM {F3} f JOIN a USING (job, line_no) WHERE NOT f.is_valid),
v AS (SELECT f.*, a.adj_ts FROM {F3} f JOIN a USING (job, line_no) WHERE f.is_valid),
u AS (
  SELECT job, up AS step, adj_ts AS wall_time, 'train/epoch' AS tag, CAST(epoch AS DOUBLE) AS value FROM t
  UNION ALL SELECT job, up, adj_ts, 'train/sentences', CAST(sen AS DOUBLE) FROM t
  UNION ALL SELECT job, up, adj_ts, 'train/sentences-diff', CAST(sen_diff AS DOUBLE) FROM t
  UNION ALL SELECT job, up, adj_ts, 'train/cost', cost FROM t
  UNION ALL SELECT job, up, adj_ts, 'train/time[sec]', time_s FROM t
  UNION ALL SELECT job, up, adj_ts, 'train/speed[words per sec]', wps FROM t
  UNION ALL SELECT job, up, adj_ts, 'train/learning_rate', lr FROM t
  UNION ALL SELECT job, up, epoch(ts), 'train/wall-clock', epoch(ts) FROM t
  UNION ALL SELECT job, up, adj_ts, 'train/gpus', CAST(length(job) AS DOUBLE) FROM t
  UNION ALL SELECT NULL, event_id + 1, NULL, 'valid-avg/avg-' || CAST(user_id % 3 AS VARCHAR) || '_bleu', round(value, 2) FROM events
  UNION ALL SELECT job, up, adj_ts, 'valid/bleu-detok', cost FROM v
  UNION ALL SELECT job, up, adj_ts, 'valid/bleu-detok_stalled', CAST(stalled AS DOUBLE) FROM v)
SELECT job, tag, step, round(wall_time, 6) AS wall_time, round(value, 6) AS value FROM u"""

AVG_LOGS = "SELECT 'avg-' || CAST(user_id % 3 AS VARCHAR) AS name, event_id + 1 AS step, round(value, 2) AS score FROM events"

BURSTS = f"""
WITH g AS (SELECT job, line_no, ts, epoch(ts) - lag(epoch(ts)) OVER (PARTITION BY job ORDER BY line_no) AS gap FROM {F3} f),
b AS (SELECT *, sum(CASE WHEN gap > 1200 THEN 1 ELSE 0 END) OVER (PARTITION BY job ORDER BY line_no
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS burst FROM g)
SELECT job, CAST(burst AS BIGINT) AS burst, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS n_lines
FROM b GROUP BY job, burst"""

ORACLE.update({
    "log_parse": LOG_PARSE,
    "valid_parse": VALID_PARSE,
    "sentences_diff": SEN_DIFF,
    "pause_adjusted": PAUSE_ADJUSTED,
    "gpu_counts": f"SELECT job, line_no, CAST(length(job) AS INTEGER) AS gpus FROM {F3} f WHERE NOT is_valid",
    "run_duration": RUN_DURATION,
    "best_update": BEST_UPDATE,
    "scalars": SCALARS,
    "avg_logs": AVG_LOGS,
    "bursts_batch": BURSTS,
})


# --- experiments -----------------------------------------------------------------------
F6 = """(WITH g AS (
  SELECT 'en-cy_' || event_type AS session, CAST(user_id % 10 + 1 AS INTEGER) AS split_n,
         date_trunc('week', ts) AS week,
         CAST(sum(round(value * 100)) AS DOUBLE) / count(*) / 100 AS bleu, max(value) AS chrf, min(value) AS ter,
         max(ts) AS updated_at
  FROM events GROUP BY ALL)
SELECT session, split_n, 'BLEU' AS metric, bleu AS score, updated_at FROM g
UNION ALL SELECT session, split_n, 'CHRF', chrf, updated_at FROM g
UNION ALL SELECT session, split_n, 'TER', ter, updated_at FROM g)"""

LATEST = f"""(SELECT session, split_n, metric, arg_max(score, updated_at) AS score, max(updated_at) AS updated_at
FROM {F6} f GROUP BY session, split_n, metric)"""

LATEST_SESSIONS = f"""SELECT session, max(updated_at) AS updated_at,
  arg_max(split_n, (updated_at, split_n, metric)) AS split_n, arg_max(metric, (updated_at, split_n, metric)) AS metric,
  round(arg_max(score, (updated_at, split_n, metric)), 6) AS score
FROM {F6} f GROUP BY session"""

LIST_SESSIONS = f"""WITH s AS (SELECT session, min(updated_at) AS created, max(updated_at) AS last FROM {F6} f GROUP BY session),
c AS (SELECT session AS cur FROM s ORDER BY last DESC, session DESC LIMIT 1)
SELECT session, created, session = (SELECT cur FROM c) AS is_current FROM s ORDER BY created DESC, session LIMIT 3"""

SCORES_MATRIX = f"""SELECT session, split_n,
  round(max(CASE WHEN metric = 'BLEU' THEN score END), 6) AS BLEU,
  round(max(CASE WHEN metric = 'CHRF' THEN score END), 6) AS CHRF,
  round(max(CASE WHEN metric = 'TER' THEN score END), 6) AS TER
FROM {LATEST} l GROUP BY session, split_n"""

BEST_SPLIT = f"""SELECT session, first(split_n ORDER BY score DESC, split_n) AS best_split, round(max(score), 6) AS best_score
FROM {LATEST} l WHERE metric = 'BLEU' GROUP BY session"""

CV_SUMMARY = f"""SELECT session, metric, count(*) AS n_splits, round(avg(score), 6) AS mean, round(min(score), 6) AS min,
  round(max(score), 6) AS max, round(stddev_samp(score), 6) AS stddev FROM {LATEST} l GROUP BY session, metric"""

SESSION_IDS = f"""SELECT DISTINCT session, regexp_extract(session, {q(EXP_SESSION_RE)}, 1) AS source_lang,
  regexp_extract(session, {q(EXP_SESSION_RE)}, 2) AS target_lang, regexp_extract(session, {q(EXP_SESSION_RE)}, 3) AS ident
FROM {F6} f""" if (EXP_SESSION_RE := __import__('corpusflow.operators.experiments', fromlist=['x']).SESSION_RE) else ""

LIVE_SESSIONS = f"""SELECT session, split_n, metric FROM {LATEST} l
WHERE session IN (SELECT 'en-cy_' || event_type FROM events WHERE event_type <> 'error')"""

PENDING_SPLITS = f"""WITH inv AS (SELECT s.session, CAST(g.split_n AS INTEGER) AS split_n
  FROM (SELECT DISTINCT session FROM {LATEST} l) s, (SELECT unnest(generate_series(1, 10)) AS split_n) g),
done AS (SELECT session, split_n FROM {LATEST} l WHERE metric = 'BLEU' AND score >= 50)
SELECT session, split_n FROM inv WHERE NOT EXISTS (
  SELECT 1 FROM done d WHERE d.session = inv.session AND d.split_n = inv.split_n)"""

RESULTS_FULL = f"""WITH segs AS (SELECT 'en-cy_' || event_type AS session, CAST(user_id % 10 + 1 AS INTEGER) AS split_n,
  count(*) AS n_segments, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 3600e6, 2) AS hours,
  CAST(sum(strlen(props)) AS BIGINT) AS detail_bytes FROM events GROUP BY ALL)
SELECT l.session, l.split_n, s.n_segments, s.hours, s.detail_bytes,
  round(max(CASE WHEN metric = 'BLEU' THEN score END), 6) AS bleu,
  round(max(CASE WHEN metric = 'CHRF' THEN score END), 6) AS chrf,
  round(max(CASE WHEN metric = 'TER' THEN score END), 6) AS ter
FROM {LATEST} l LEFT JOIN segs s USING (session, split_n) GROUP BY l.session, l.split_n, s.n_segments, s.hours, s.detail_bytes"""
RESULTS_TABLE = f"SELECT * EXCLUDE (detail_bytes) FROM ({RESULTS_FULL}) r"

SESSION_STATES = """SELECT 'en-cy_' || CAST(user_id % 50 AS VARCHAR) AS session,
  min(ts) FILTER (event_type = 'signup') AS created, max(ts) FILTER (event_type = 'click') AS used,
  arg_max('note ' || CAST(event_id AS VARCHAR), (ts, event_id)) FILTER (event_type = 'purchase') AS comment,
  CAST(arg_max(floor(value), (ts, event_id)) FILTER (event_type = 'view') AS INTEGER) AS progress
FROM events WHERE event_type IN ('signup', 'click', 'purchase', 'view') GROUP BY ALL"""

ORACLE.update({
    "latest_sessions": LATEST_SESSIONS,
    "list_sessions": LIST_SESSIONS,
    "scores_matrix": SCORES_MATRIX,
    "best_split": BEST_SPLIT,
    "cv_summary": CV_SUMMARY,
    "session_ids": SESSION_IDS,
    "live_sessions": LIVE_SESSIONS,
    "pending_splits": PENDING_SPLITS,
    "results_table": RESULTS_TABLE,
    "results_full": RESULTS_FULL,
    "session_states": SESSION_STATES,
})


# --- sources and sinks ---------------------------------------------------------------
_LABEL = "CASE WHEN classifier = 'Health' THEN 'Public Health' ELSE classifier END AS classifier"
UNITS = f"SELECT {_LABEL}, source_lang, source, target_lang, target FROM ({S.F1}) f1"
# level-2 markup: the segment's own text nodes, joined by a space
TMX_UNITS = f"""SELECT {_LABEL}, source_lang, CASE WHEN line_no % 3 <> 0 THEN source WHEN source = '' THEN '{{j}}' ELSE '{{j}} ' || source END AS source,
  target_lang, target FROM ({S.F1}) f1"""

_URLS = """(SELECT regexp_replace(url, '[?#].*$', '') || ['.tmx.gz', '.xz', ''][page_id % 3 + 1] AS url FROM pages)"""
MANIFEST = f"""
WITH u AS (SELECT url, regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1) AS path FROM {_URLS} x),
n AS (SELECT url, path, array_to_string(list_filter(string_split(path, '/'), lambda p: p <> ''), '_') AS name,
             regexp_extract(path, '\\.(xz|gz|zip)$', 1) AS comp FROM u)
SELECT url, '/data/downloads/' || CASE WHEN comp <> '' THEN regexp_replace(name, '\\.[^.]+$', '') ELSE name END AS storage_path,
       CASE WHEN comp <> '' THEN comp END AS compression_type FROM n"""

SUBMISSIONS = """SELECT doc_id AS id, source AS domain,
  'https://example.org/en/submissions/' || CAST(doc_id AS VARCHAR) || '.tmx' AS url
FROM documents WHERE lower(source) IN ('src1', 'src2')"""

# an empty quoted field is read as null
POSITIONAL_UNITS = f"""SELECT {_LABEL}, 'en' AS source_lang,
  CASE WHEN line_no % 4 = 0 THEN source || chr(10) || 'and more' ELSE source END AS source, 'en' AS target_lang, target FROM ({S.F1}) f1"""

ORACLE.update({
    "tree_pairs": POSITIONAL_UNITS,
    "load_corpus": DEDUP_PAIRS,
    "aligned_export": REPEATED_SPLITS.replace("AS split_n, label, id FROM", "AS split_n, label, source, target FROM"),
    "tmx_pairs": TMX_UNITS,
    "csv_pairs": POSITIONAL_UNITS,
    "tsv_pairs": POSITIONAL_UNITS,
    "wordfast_pairs": UNITS,
    "manifest": MANIFEST,
    "submissions": SUBMISSIONS,
    "split_roundtrip": REPEATED_SPLITS.replace("AS split_n, label, id FROM", "AS split_n, label, id, source, target FROM"),
})


# --- requests, subword text, review, leaks, vocabulary --------------------------------
#: stands for a cut; no given text has it
SENT_MARK = "␞"


def _sentence_parts(table: str) -> str:
    marked = f"regexp_replace({S.normalize('text')}, {q('([.!?]+)' + R.WS + '+')}, {q(chr(92) + '1' + SENT_MARK)}, 'g')"
    return f"""SELECT conv_id, turn, list_filter(string_split({marked}, {q(SENT_MARK)}), lambda s: s <> '') AS parts
      FROM {table}"""


def _sentences_sql(table: str = "conversations") -> str:
    return f"""(SELECT conv_id, turn, CAST(i - 1 AS BIGINT) AS pos, regexp_replace({S.py_strip('parts[i]')}, '\\.+$', '') AS sentence
FROM ({_sentence_parts(table)}) c, LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i) r)"""


SENTENCE_SEGMENTS = f"SELECT * FROM {_sentences_sql()} s"

def _reassemble_sql(table: str) -> str:
    return f"""SELECT c.conv_id, c.turn, CASE WHEN c.text IS NULL THEN NULL
       WHEN contains(c.text, chr(10)) THEN coalesce(string_agg(sentence, chr(10) ORDER BY pos), '')
       ELSE coalesce(string_agg(sentence, '  ' ORDER BY pos), '') END AS text
FROM {table} c LEFT JOIN {_sentences_sql(table)} s USING (conv_id, turn) GROUP BY c.conv_id, c.turn, c.text"""


REASSEMBLE = _reassemble_sql("conversations")
_BLANK = """(SELECT conv_id, turn, CASE turn % 5 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN ' ' || chr(10) || ' ' ELSE text END AS text FROM conversations)"""

DISTINCT_REQUESTS = f"""SELECT doc_id, line_no, first(doc_id) OVER w AS first_doc, first(line_no) OVER w AS first_line
FROM ({S.F1}) f WINDOW w AS (PARTITION BY source, source_lang ORDER BY doc_id, line_no)"""

BPE_UNJOIN = f"SELECT doc_id, line_no, ref AS text FROM ({S.F5}) f"

DETOK = f"""SELECT doc_id, line_no, array_to_string(list_transform(w, lambda x, i:
    CASE WHEN i = 1 OR regexp_matches(w[i - 1], '[.:?!]$') THEN upper(substring(x, 1, 1)) || substring(x, 2) ELSE x END), ' ') AS text
FROM (SELECT doc_id, line_no, string_split(
   regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(ref), '([.,!?:;])', ' \\1', 'g'),
       ' ([.,!?:;%)\\]}}])', '\\1', 'g'), '([(\\[{{$£]) ', '\\1', 'g'), ' '' ', '''', 'g'), ' ') AS w FROM ({S.F5}) f) d"""

TRIPLES = f"""(WITH f AS (SELECT doc_id, line_no, {S.normalize('src')} AS src, {S.normalize('ref')} AS ref, {S.normalize('hyp')} AS hyp FROM ({S.F5}) x)
SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY src ORDER BY doc_id DESC, line_no DESC) = 1)"""

ALIGNED_TRIPLES = f"SELECT * FROM {TRIPLES} t"

REVIEW_SAMPLE = f"""SELECT doc_id, line_no, repeat('-', 80) || chr(10) || chr(10) || 'SEGMENT: ' || CAST(line_no AS VARCHAR) || chr(10)
  || 'src: ' || src || chr(10) || 'ref: ' || ref || chr(10) || 'hyp: ' || hyp || chr(10) || chr(10)
  || 'REF PROBLEMUS:' || chr(10) || 'HYP PROBLEMUS:' || chr(10) || 'SYLW:' || chr(10) || chr(10) || chr(10) AS block
FROM {TRIPLES} t ORDER BY md5('42|' || src), doc_id, line_no LIMIT 381"""

LEAK_REMOVAL = f"""SELECT doc_id, line_no FROM ({S.F1}) f WHERE classifier = 'Health'
AND NOT EXISTS (SELECT 1 FROM ({S.F1}) b WHERE b.classifier = 'Unknown' AND b.source = f.source AND b.target = f.target)"""

WORD_VOCAB = f"""SELECT word, count, CAST(row_number() OVER (ORDER BY count DESC, word) AS INTEGER) AS rank
FROM (SELECT word, count(*) AS count FROM (SELECT unnest({S.alpha_tokens('text')}) AS word FROM documents) t
      GROUP BY word ORDER BY count DESC, word LIMIT 1000) v"""

VOCAB_INPUT = f"""WITH s AS ({_split_sql(SPLIT_BASE, 'test')}),
first_train AS (SELECT * FROM s WHERE label = 'train'),
draws AS (SELECT f.id, f.classifier, f.source, f.target, f.langs, g.split_n
          FROM first_train f, (SELECT unnest(generate_series(1, 10)) AS split_n) g),
tr AS (SELECT * FROM {_split_sql('draws', 'valid')} x WHERE label = 'train'),
lines AS (SELECT source AS text FROM tr UNION ALL SELECT target FROM tr)
SELECT text FROM lines"""

ORACLE.update({
    "sentence_segments": SENTENCE_SEGMENTS,
    "reassemble_text": REASSEMBLE,
    "reassemble_blank": _reassemble_sql(_BLANK),
    "distinct_requests": DISTINCT_REQUESTS,
    "bpe_unjoin": BPE_UNJOIN,
    "detok": DETOK,
    "aligned_triples": ALIGNED_TRIPLES,
    "review_sample": REVIEW_SAMPLE,
    "leak_removal": LEAK_REMOVAL,
    "word_vocab": WORD_VOCAB,
    "vocab_input": VOCAB_INPUT,
})

ORACLE["monitor_stream"] = f"""SELECT job, a.line_no + 1 AS up, round(gap, 6) AS gap, round(adj_ts, 6) AS adj_ts, sen_diff
FROM {ADJUSTED} a LEFT JOIN ({SEN_DIFF}) s USING (job, line_no)"""
ORACLE["monitor_appended"] = ORACLE["monitor_stream"]

# Encoding then decoding gives back the text with single spaces between words.
ORACLE["pieces_to_text"] = f"""SELECT item_id,
  array_to_string(list_filter(regexp_split_to_array(trim({S.normalize('text')}), '\\s+'), lambda w: w <> ''), ' ') AS text
FROM benchmark WHERE len(list_filter(regexp_split_to_array(trim({S.normalize('text')}), '\\s+'), lambda w: w <> '')) > 0"""


# --- unigram subwords: seeds, and one pass of expectation over the lattices of all words ---
SEEDS = f"""wc AS (SELECT '▁' || word AS w, count(*) AS cnt FROM (
    SELECT unnest(list_filter(regexp_split_to_array(trim({S.normalize('text')}), '\\s+'), lambda w: w <> '')) AS word FROM conversations) x GROUP BY 1),
subs AS (SELECT w, cnt, i AS s, i + m AS e, substr(w, i, m) AS piece
         FROM wc, LATERAL (SELECT unnest(range(1, length(w) + 1)) AS i) a, LATERAL (SELECT unnest(range(1, least(16, length(w) - i + 1) + 1)) AS m) b),
freq AS (SELECT piece, CAST(sum(cnt) AS BIGINT) AS freq FROM subs GROUP BY piece),
seeds AS (SELECT * FROM freq WHERE length(piece) = 1
          UNION ALL (SELECT * FROM freq WHERE length(piece) > 1 AND freq > 1 ORDER BY freq * length(piece) DESC, piece LIMIT 4000))"""
ORACLE["unigram_seeds"] = f"WITH {SEEDS} SELECT * FROM seeds"
ORACLE["unigram_expectation"] = f"""WITH RECURSIVE {SEEDS},
p AS (SELECT piece, freq * length(piece) / (SELECT sum(freq * length(piece)) FROM seeds) AS p FROM seeds),
arcs AS (SELECT w, cnt, s, e, piece, p FROM subs JOIN p USING (piece)),
ends AS (SELECT w, e, list({{'s': s, 'p': p}}) AS x FROM arcs GROUP BY w, e),
starts AS (SELECT w, s, list({{'e': e, 'p': p}}) AS x FROM arcs GROUP BY w, s),
ahead(w, pos, a) AS (SELECT w, 1::BIGINT, [1.0::DOUBLE] FROM wc
  UNION ALL SELECT f.w, f.pos + 1, list_append(f.a, list_sum(list_transform(ends.x, lambda t: f.a[t.s] * t.p)))
            FROM ahead f JOIN ends ON ends.w = f.w AND ends.e = f.pos + 1),
behind(w, pos, b) AS (SELECT w, length(w) + 1, [1.0::DOUBLE] FROM wc
  UNION ALL SELECT f.w, f.pos - 1, list_prepend(list_sum(list_transform(starts.x, lambda t: f.b[t.e - f.pos + 1] * t.p)), f.b)
            FROM behind f JOIN starts ON starts.w = f.w AND starts.s = f.pos - 1)
SELECT piece, round(sum(cnt * a[s] * p * b[e] / a[length(arcs.w) + 1]), 3) AS expected
FROM arcs JOIN ahead ON ahead.w = arcs.w AND ahead.pos = length(arcs.w) + 1 JOIN behind ON behind.w = arcs.w AND behind.pos = 1
GROUP BY piece"""
ORACLE["unigram_text"] = f"""SELECT item_id,
  array_to_string(list_filter(regexp_split_to_array(trim({S.normalize('text')}), '\\s+'), lambda w: w <> ''), ' ') AS text
FROM benchmark"""

# Forms that the rules make of each stem, listed; compounds of a word with itself,
# or of any two or three stems, by their parts.
ORACLE["affix_words"] = f"""WITH RECURSIVE lex AS (SELECT * FROM ({LEXICON}) x WHERE regexp_full_match(word, '[a-z]{{3,}}')),
st AS (SELECT lang, word, substring(word, 1, length(word) - 1) AS cut, length(word) % 2 = 0 AS r, ascii(word) % 2 = 0 AS s,
              length(word) % 3 = 0 AS g, length(word) % 4 = 0 AS c, length(word) % 11 = 0 AS bad FROM lex),
ok AS (SELECT * FROM st WHERE NOT bad),
ends AS (SELECT lang, word AS w, r FROM ok
  UNION ALL SELECT lang, word || 's', r FROM ok WHERE s AND right(word, 1) NOT IN ('s', 'y')
  UNION ALL SELECT lang, cut || 'ies', r FROM ok WHERE s AND right(word, 1) = 'y'),
good AS (SELECT lang, w FROM ends UNION ALL SELECT lang, 're' || w FROM ends WHERE r
  UNION ALL SELECT lang, word || 'ing' FROM ok WHERE g AND right(word, 1) <> 'e'
  UNION ALL SELECT lang, cut || 'ing' FROM ok WHERE g AND right(word, 1) = 'e'),
forms AS (SELECT DISTINCT lang, unnest([word, word || 's', word || 'ing', cut || 'ies', cut || 'ing', 're' || word, 're' || word || 's',
                                        're' || word || 'ing', word || word, word || word || word, word || 'q' || word]) AS word FROM st),
rest AS (SELECT * FROM forms ANTI JOIN (SELECT DISTINCT lang, w AS word FROM good) k USING (lang, word)),
walk(lang, word, pos) AS (SELECT lang, word, 0::BIGINT FROM rest
  UNION SELECT k.lang, k.word, k.pos + length(p.word) FROM walk k JOIN st p
    ON p.lang = k.lang AND p.c AND substring(k.word, k.pos + 1, length(p.word)) = p.word AND length(p.word) < length(k.word))
SELECT lang, word FROM rest ANTI JOIN (SELECT lang, word FROM walk WHERE pos = length(word)) z USING (lang, word)"""

# --- event time in the stream ---------------------------------------------------------------
ORACLE["stream_dedup"] = f"""WITH f AS (SELECT job, CASE WHEN is_valid THEN 'valid' ELSE 'train' END AS kind, up, ts, max(ts) OVER () AS last FROM {F3} x)
SELECT job, kind, up FROM f UNION ALL SELECT job, kind, up + 2000000000 FROM f WHERE ts > last - INTERVAL 30 MINUTE
UNION ALL SELECT '-', 'late', count(*) FROM f WHERE ts < last - INTERVAL 2 HOUR AND up % 50 = 0"""
ORACLE["stream_bursts"] = f"""WITH g AS (SELECT job, ts, max(ts) OVER () AS last, epoch(ts) - lag(epoch(ts)) OVER (PARTITION BY job ORDER BY ts) AS gap FROM {F3} f),
b AS (SELECT *, sum(CASE WHEN gap > 1200 THEN 1 ELSE 0 END) OVER (PARTITION BY job ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS burst FROM g)
SELECT job, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS n_lines FROM b GROUP BY job, burst
HAVING epoch(max(ts)) + 1200 < epoch(any_value(last)) - 3600"""

# --- learnt sentence borders ----------------------------------------------------------------
_SHORT = "text"
for _word, _both in FX.SHORT_AFTER:
    _SHORT = f"replace({_SHORT}, {q(_word)}, {q(_both)})"
ORACLE["abbreviation_scores"] = f"""SELECT lang, word, n_stop, n_free, round(
  2 * ((n_stop * ln({BD.ALWAYS}) + n_free * ln({1 - BD.ALWAYS})) - (n_stop * ln(p) + n_free * ln(1 - p)))
  * exp(-letters) * (length(word) - letters + 1) * pow(letters, -n_free), 6) + 0.0 AS score
FROM (SELECT lang, word, n_stop, n_free, CAST(length(replace(word, '.', '')) AS DOUBLE) AS letters,
             sum(n_stop) OVER (PARTITION BY lang) / sum(n_stop + n_free) OVER (PARTITION BY lang) AS p
      FROM (SELECT lang, word, count(*) FILTER (WHERE stop) AS n_stop, count(*) FILTER (WHERE NOT stop) AS n_free
            FROM (SELECT lang, lower(regexp_extract(t, {q(BD.WORD)}, 1)) AS word, regexp_extract(t, {q(BD.WORD)}, 2) = '.' AS stop
                  FROM (SELECT lang, unnest(regexp_split_to_array({_SHORT}, {q(R.WS + '+')})) AS t FROM documents) a) w
            WHERE word <> '' GROUP BY lang, word) b) c"""
ORACLE["trained_segments"] = f"""WITH short AS (SELECT word, lang FROM ({ORACLE["abbreviation_scores"]}) s
  WHERE score >= {BD.LEAST_SCORE} AND n_stop >= {BD.LEAST_COUNT}),
cut AS (SELECT doc_id AS conv_id, lang AS turn, {_SHORT} AS text FROM documents),
one AS (SELECT conv_id AS doc_id, turn AS lang, i AS p, parts[i] AS s, regexp_extract(parts[i], '(\\S+)$', 1) AS t
  FROM ({_sentence_parts("cut")}) c, LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i) r),
met AS (SELECT doc_id, p, s, regexp_extract(t, {q(BD.WORD)}, 2) = '.'
               AND (lang, lower(regexp_extract(t, {q(BD.WORD)}, 1))) IN (SELECT (lang, word) FROM short) AS open FROM one),
runs AS (SELECT *, sum(CASE WHEN before THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) - 1 AS pos
  FROM (SELECT *, coalesce(lag(open) OVER (PARTITION BY doc_id ORDER BY p), false) AS before FROM met) x)
SELECT doc_id, CAST(pos AS BIGINT) AS pos, regexp_replace({S.py_strip("string_agg(s, ' ' ORDER BY p)")}, '\\.+$', '') AS sentence
FROM runs GROUP BY doc_id, pos"""
ORACLE["packed_pairs"] = TMX_UNITS
