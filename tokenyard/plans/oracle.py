r"""DuckDB SQL oracles for the registered queries (run by the driver on the same Parquet views).

They restate each query's semantics independently in plain SQL. Two notes:
* DuckDB's RE2 has no look-ahead, so the pre-token rule's ``\s+(?!\S)`` branch is emulated: a
  marker (U+E000) is put before the last blank of every blank run that precedes a non-blank, the
  marker is excluded from the "other symbols" class and is never matched, so matches stop there.
* The tokenizer learned by the queries is re-learned here one merge at a time (unrolled CTEs), so the
  multi-merge rounds of the Spark learner are checked against one-by-one learning.
"""

from __future__ import annotations

from ..functions.hashing import hash62_sql
from . import params as P

MARK = "chr(57344)"
RE2_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}\x{E000}]+|\s+"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def pretok(text_expr: str) -> str:
    """SQL list of pre-tokens of a text expression."""
    marked = f"regexp_replace({text_expr}, '(\\s)(\\S)', {MARK} || '\\1\\2', 'g')"
    return f"regexp_extract_all({marked}, {_q(RE2_PATTERN)})"


def toks_of(word_expr: str) -> str:
    return f"regexp_replace(hex(encode({word_expr})), '(..)', '|\\1|', 'g')"


WORD_FREQ = f"""
pt AS (SELECT unnest({pretok('text')}) AS w FROM documents),
wf AS (SELECT w, count(*) AS freq FROM pt GROUP BY w),
w0 AS (SELECT w, {toks_of('w')} AS toks, freq FROM wf)"""


def pairs_of(words: str) -> str:
    return f"""SELECT t[i] AS "left", t[i + 1] AS "right", CAST(sum(freq) AS BIGINT) AS n
    FROM (SELECT t, freq, unnest(generate_series(1, len(t) - 1)) AS i
          FROM (SELECT string_split(trim(toks, '|'), '||') AS t, freq FROM {words}))
    GROUP BY 1, 2"""


ORDER_PAIRS = 'ORDER BY n DESC, "left" DESC, "right" DESC'


def learn(n_merges: int) -> str:
    """CTEs ``w0..wN``, ``m0..m{N-1}``, ``merges(rank, left, right)``, ``vocab(token_id, hx)``."""
    parts = [WORD_FREQ]
    for k in range(n_merges):
        parts.append(f"p{k} AS ({pairs_of(f'w{k}')})")
        parts.append(f'm{k} AS (SELECT {k} AS rank, "left", "right" FROM p{k} {ORDER_PAIRS} LIMIT 1)')
        parts.append(
            f"w{k + 1} AS (SELECT w, replace(toks, '|' || m.\"left\" || '||' || m.\"right\" || '|', "
            f"'|' || m.\"left\" || m.\"right\" || '|') AS toks, freq FROM w{k}, m{k} AS m)"
        )
    union = " UNION ALL ".join(f"SELECT * FROM m{k}" for k in range(n_merges))
    parts.append(f"merges AS ({union})")
    special_hex = P.SPECIAL.encode().hex().upper()
    parts.append(
        "vocab AS (SELECT CAST(i AS INTEGER) AS token_id, lpad(hex(i), 2, '0') AS hx FROM range(256) t(i)"
        f" UNION ALL SELECT 256, '{special_hex}'"
        ' UNION ALL SELECT CAST(257 + rank AS INTEGER), "left" || "right" FROM merges)'
    )
    sel = ", ".join(f'(SELECT "left" FROM m{k}) AS l{k}, (SELECT "right" FROM m{k}) AS r{k}' for k in range(n_merges))
    parts.append(f"mrow AS (SELECT {sel})")
    return ",\n".join(parts)


def apply_merges(toks_expr: str, n_merges: int) -> str:
    e = toks_expr
    for k in range(n_merges):
        e = f"replace({e}, '|' || l{k} || '||' || r{k} || '|', '|' || l{k} || r{k} || '|')"
    return e


def encoded_words(words_cte: str, n_merges: int) -> str:
    """``(w, hx, j)`` one row per token of each distinct word, with the token's position ``j``."""
    enc = apply_merges(toks_of("w"), n_merges)
    return f"""SELECT w, unnest(t) AS hx, unnest(generate_series(1, len(t))) AS j
    FROM (SELECT w, string_split(trim({enc}, '|'), '||') AS t FROM (SELECT DISTINCT w FROM {words_cte}), mrow)"""


N = P.CORPUS_MERGES

# Per-document pre-tokens of the whole text and their encoded statistics.
DOC_TOKENS = f"""
{learn(N)},
dw AS (SELECT doc_id, lang, unnest({pretok('text')}) AS w FROM documents),
ew AS ({encoded_words('dw', N)}),
ewid AS (SELECT ew.w, ew.j, v.token_id, ew.hx FROM ew JOIN vocab v ON v.hx = ew.hx),
wstat AS (SELECT w, count(*) AS ntok, sum(token_id) AS idsum FROM ewid GROUP BY w),
dstat AS (SELECT d.doc_id, d.lang, CAST(sum(ntok) AS BIGINT) AS n_tokens, CAST(sum(idsum) AS BIGINT) AS id_sum
          FROM dw d JOIN wstat s USING (w) GROUP BY d.doc_id, d.lang)"""

# The dataset token stream: documents in doc_id order, each encoded line by line.
STREAM = f"""
{learn(N)},
sp AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
ln AS (SELECT doc_id, unnest(parts) AS piece, unnest(generate_series(1, len(parts))) AS li, len(parts) AS nl FROM sp),
lines AS (SELECT doc_id, li, CASE WHEN li < nl THEN piece || chr(10) ELSE piece END AS line FROM ln),
lw0 AS (SELECT doc_id, li, {pretok('line')} AS ws FROM lines),
lw AS (SELECT doc_id, li, unnest(ws) AS w, unnest(generate_series(1, len(ws))) AS wi FROM lw0),
ew AS ({encoded_words('lw', N)}),
ewid AS (SELECT ew.w, ew.j, v.token_id FROM ew JOIN vocab v ON v.hx = ew.hx),
stream AS (SELECT row_number() OVER (ORDER BY lw.doc_id, lw.li, lw.wi, e.j) - 1 AS pos, lw.doc_id, e.token_id AS id
           FROM lw JOIN ewid e USING (w)),
total AS (SELECT count(*) AS n FROM stream)"""

EMB = """
e AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x,
             CAST(unnest(generate_series(0, len(embedding) - 1)) AS INTEGER) AS class_id FROM embeddings)"""


def _lse():
    return f"""WITH {EMB},
m AS (SELECT vec_id, max(x) AS mx FROM e GROUP BY vec_id),
s AS (SELECT e.vec_id, max(m.mx) + ln(sum(exp(e.x - m.mx))) AS lse FROM e JOIN m USING (vec_id) GROUP BY e.vec_id)"""


def _nucleus_ctes(temperature: float, top_p: float) -> str:
    return f"""WITH {EMB},
z AS (SELECT vec_id, class_id, x / {float(temperature)!r} AS z FROM e),
ez AS (SELECT vec_id, class_id, exp(z - max(z) OVER (PARTITION BY vec_id)) AS ez FROM z),
p AS (SELECT vec_id, class_id, ez / sum(ez) OVER (PARTITION BY vec_id) AS p FROM ez),
r AS (SELECT vec_id, class_id, p,
             row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, class_id) AS rank,
             sum(p) OVER (PARTITION BY vec_id ORDER BY p DESC, class_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
      FROM p),
k AS (SELECT vec_id, class_id, rank, p, p / sum(p) OVER (PARTITION BY vec_id) AS q FROM r WHERE cum - p < {float(top_p)!r})"""


METRICS = f"""
t0 AS (SELECT min(ts) AS t0 FROM events),
metrics AS (
  SELECT 'run_' || CAST(user_id AS VARCHAR) AS run_name, event_id AS step,
         CAST(epoch_us(ts) - epoch_us(t0) AS DOUBLE) / 1e6 AS elapsed_seconds,
         event_id * {P.BATCH_SIZE * P.CONTEXT} AS tokens_seen,
         value AS train_loss,
         CASE WHEN event_type = '{P.EVAL_EVENT}' THEN value END AS val_loss
  FROM events, t0)"""


def queries_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["pretoken_counts"] = f"WITH {WORD_FREQ} SELECT w AS word, freq FROM wf"

    sp2 = P.SPECIAL * 2
    alt = "(" + "|".join(s.replace("|", "\\|") for s in [sp2, P.SPECIAL]) + ")"
    q["special_segments"] = f"""
WITH t AS (SELECT doc_id, replace(text, chr(10), {_q(P.SPECIAL)}) AS text FROM documents),
s AS (SELECT doc_id, string_split(regexp_replace(text, {_q(alt)}, chr(64976) || '\\1' || chr(64976), 'g'), chr(64976)) AS segs FROM t),
u AS (SELECT doc_id, unnest(segs) AS segment, unnest(generate_series(0, len(segs) - 1)) AS seg_idx FROM s)
SELECT doc_id, CAST(seg_idx AS INTEGER) AS seg_idx, segment, segment IN ({_q(P.SPECIAL)}, {_q(sp2)}) AS is_special
FROM u WHERE segment <> ''"""

    q["pair_counts"] = f'WITH {WORD_FREQ}, p AS ({pairs_of("w0")}) SELECT "left", "right", n FROM p'
    q["best_pair"] = f'WITH {WORD_FREQ}, p AS ({pairs_of("w0")}) SELECT "left", "right", n FROM p {ORDER_PAIRS} LIMIT 1'
    q["top_pairs"] = (
        f'WITH {WORD_FREQ}, p AS ({pairs_of("w0")}) SELECT "left", "right", n FROM p {ORDER_PAIRS} LIMIT {P.TOP_K}'
    )
    q["bpe_merges_8"] = f'WITH {learn(N)} SELECT CAST(rank AS INTEGER) AS rank, "left", "right" FROM merges'
    q["bpe_vocab"] = f"WITH {learn(N)} SELECT token_id, hx AS token FROM vocab"
    q["encode_token_counts"] = f"WITH {DOC_TOKENS} SELECT doc_id, n_tokens, id_sum FROM dstat"
    q["encode_decode_roundtrip"] = "SELECT doc_id, text FROM documents"
    q["decode_join"] = f"""WITH {DOC_TOKENS}
SELECT e.token_id, e.hx AS token, CAST(count(*) AS BIGINT) AS n FROM dw JOIN ewid e USING (w) GROUP BY 1, 2"""
    q["token_count_by_lang"] = f"""WITH {DOC_TOKENS}
SELECT lang, CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n_tokens) AS BIGINT) AS n_tokens FROM dstat GROUP BY ROLLUP (lang)"""

    q["global_offsets"] = f"""WITH {STREAM},
per_doc AS (SELECT doc_id, count(*) AS n_tokens FROM stream GROUP BY doc_id)
SELECT doc_id, CAST(n_tokens AS BIGINT) AS n_tokens,
       CAST(coalesce(sum(n_tokens) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
FROM per_doc"""
    L, S = P.WINDOW_LEN, P.WINDOW_STRIDE
    assert S == L, "the windows oracle groups the stream into consecutive, non-overlapping windows"
    q["lm_windows_all"] = f"""WITH {STREAM},
xs AS (SELECT pos // {S} AS k, string_agg(CAST(id AS VARCHAR), ',' ORDER BY pos) AS x FROM stream GROUP BY 1),
ys AS (SELECT (pos - 1) // {S} AS k, string_agg(CAST(id AS VARCHAR), ',' ORDER BY pos) AS y FROM stream WHERE pos >= 1 GROUP BY 1)
SELECT CAST(k * {S} AS BIGINT) AS start, x, y FROM xs JOIN ys USING (k), total WHERE k * {S} <= total.n - {L} - 1"""
    h = hash62_sql("sample_id", P.SAMPLE_SEED)
    q["lm_windows_sampled"] = f"""WITH {STREAM},
smp AS (SELECT sample_id, {h} % (total.n - {L}) AS start FROM range({P.N_SAMPLES}) r(sample_id), total),
xs AS (SELECT sample_id, start, string_agg(CAST(id AS VARCHAR), ',' ORDER BY pos) AS x FROM smp JOIN stream ON pos >= start AND pos < start + {L} GROUP BY 1, 2),
ys AS (SELECT sample_id, string_agg(CAST(id AS VARCHAR), ',' ORDER BY pos) AS y FROM smp JOIN stream ON pos >= start + 1 AND pos < start + 1 + {L} GROUP BY 1)
SELECT CAST(sample_id AS BIGINT) AS sample_id, CAST(start AS BIGINT) AS start, x, y FROM xs JOIN ys USING (sample_id)"""

    q["softmax"] = f"""WITH {EMB},
ex AS (SELECT vec_id, class_id, exp(x - max(x) OVER (PARTITION BY vec_id)) AS ez FROM e)
SELECT vec_id, class_id, round(ez / sum(ez) OVER (PARTITION BY vec_id), 6) AS p FROM ex"""
    q["logsumexp"] = f"{_lse()} SELECT vec_id, round(lse, 6) AS lse FROM s"
    tgt = f"""{_lse()},
l AS (SELECT s.vec_id, s.lse - e.x AS loss FROM s JOIN e ON e.vec_id = s.vec_id AND e.class_id = e.label)"""
    q["cross_entropy"] = f"{tgt} SELECT CAST(count(*) AS BIGINT) AS n, round(avg(loss), 6) AS loss FROM l"
    q["perplexity"] = f"""{tgt},
b AS (SELECT vec_id // {P.EVAL_BATCH} AS batch_id, avg(loss) AS batch_loss FROM l GROUP BY 1)
SELECT CAST(count(*) AS BIGINT) AS n_batches, round(avg(batch_loss), 6) AS loss, round(exp(avg(batch_loss)), 6) AS perplexity FROM b"""
    q["nucleus"] = f"""{_nucleus_ctes(P.TEMPERATURE, P.TOP_P)}
SELECT vec_id AS row_id, class_id, CAST(rank AS INTEGER) AS rank, round(p, 6) AS p, round(q, 6) AS q FROM k"""
    u = f"(CAST({hash62_sql('vec_id', P.DRAW_SEED)} AS DOUBLE) / 4611686018427387904.0)"
    q["nucleus_long"] = q["nucleus"]
    q["weighted_draw"] = f"""{_nucleus_ctes(P.TEMPERATURE, P.TOP_P)},
c AS (SELECT vec_id, class_id, rank, sum(q) OVER (PARTITION BY vec_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cq, {u} AS u FROM k)
SELECT vec_id AS row_id, coalesce(min_by(CASE WHEN cq > u THEN class_id END, CASE WHEN cq > u THEN rank END), max_by(class_id, rank)) AS class_id
FROM c GROUP BY vec_id"""
    q["rms_normalize"] = f"""WITH {EMB},
r AS (SELECT vec_id, sqrt(sum(x * x) / count(*) + 1e-5) AS rms FROM e GROUP BY vec_id)
SELECT e.vec_id, e.class_id AS dim, round(e.x / r.rms, 6) AS y FROM e JOIN r USING (vec_id)"""
    q["linear_project"] = f"""WITH {EMB},
c AS (SELECT label, class_id, avg(x) AS w FROM e GROUP BY label, class_id)
SELECT e.vec_id, c.label AS out_id, round(sum(e.x * c.w), 6) AS score FROM e JOIN c USING (class_id) GROUP BY e.vec_id, c.label"""
    q["embed_lookup"] = f"""WITH {DOC_TOKENS},
tc AS (SELECT dw.lang, e.token_id, count(*) AS n FROM dw JOIN ewid e USING (w) GROUP BY 1, 2),
ee AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, CAST(unnest(generate_series(0, len(embedding) - 1)) AS INTEGER) AS dim FROM embeddings)
SELECT tc.lang, ee.dim, round(sum(tc.n * ee.x) / sum(tc.n), 6) AS value FROM tc JOIN ee ON ee.vec_id = tc.token_id GROUP BY 1, 2"""

    lr = (
        f"CASE WHEN event_id < {P.WARMUP} THEN {P.LR_MAX!r} * event_id / {float(P.WARMUP)!r} "
        f"WHEN event_id <= {P.CYCLE} THEN {P.LR_MIN!r} + 0.5 * (1 + cos((event_id - {P.WARMUP}) * 3.141592653589793 / "
        f"{float(P.CYCLE - P.WARMUP)!r})) * {P.LR_MAX - P.LR_MIN!r} ELSE {P.LR_MIN!r} END"
    )
    q["lr_schedule"] = f"SELECT event_id AS step, round({lr}, 12) AS learning_rate FROM events"
    q["run_summary"] = f"""WITH {METRICS}
SELECT run_name, CAST(count(*) AS BIGINT) AS n_rows, min(step) AS first_step, max(step) AS last_step,
       round(max_by(train_loss, step), 6) AS final_train_loss,
       round(max_by(val_loss, CASE WHEN val_loss IS NOT NULL THEN step END), 6) AS final_val_loss,
       round(min(val_loss), 6) AS best_val_loss,
       round(max(elapsed_seconds), 6) AS elapsed_seconds,
       round(CASE WHEN max(elapsed_seconds) > 0 THEN max(tokens_seen) / max(elapsed_seconds) END, 3) AS tokens_per_sec
FROM metrics GROUP BY run_name"""
    q["long_series"] = f"""WITH {METRICS}
SELECT run_name, step, round(elapsed_seconds, 6) AS elapsed_seconds, 'train_loss' AS series, train_loss AS loss FROM metrics WHERE train_loss IS NOT NULL
UNION ALL
SELECT run_name, step, round(elapsed_seconds, 6), 'val_loss', val_loss FROM metrics WHERE val_loss IS NOT NULL"""
    q["series_minmax"] = f"""WITH {METRICS},
pts AS (SELECT run_name, step AS x, train_loss AS y FROM metrics WHERE train_loss IS NOT NULL
        UNION ALL SELECT run_name, step, val_loss FROM metrics WHERE val_loss IS NOT NULL),
ext AS (SELECT run_name, min(x) AS x_min, max(x) AS x_max, min(y) AS y_min, max(y) AS y_max FROM pts GROUP BY run_name)
SELECT run_name, x_min, CASE WHEN x_min = x_max THEN x_min + 1 ELSE x_max END AS x_max,
       y_min, CASE WHEN y_min = y_max THEN y_min + 1 ELSE y_max END AS y_max FROM ext"""
    q["run_progress"] = f"""WITH {METRICS}
SELECT run_name, step,
       round(CASE WHEN elapsed_seconds - lag(elapsed_seconds) OVER w > 0
                  THEN (tokens_seen - lag(tokens_seen) OVER w) / (elapsed_seconds - lag(elapsed_seconds) OVER w) END, 3) AS tokens_per_sec,
       round(min(val_loss) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS best_val_loss
FROM metrics WINDOW w AS (PARTITION BY run_name ORDER BY step)"""
    q["run_rows_with_index"] = f"""
WITH idx AS (SELECT 'run_' || CAST(user_id AS VARCHAR) AS run_name, min(event_id) AS registered_step
             FROM events WHERE event_type = '{P.REGISTER_EVENT}' GROUP BY 1)
SELECT m.run_name, m.event_id AS step, idx.registered_step, m.event_id >= idx.registered_step AS after_registration
FROM (SELECT 'run_' || CAST(user_id AS VARCHAR) AS run_name, event_id FROM events) m JOIN idx USING (run_name)"""
    q["runs_without_rows"] = f"""
WITH idx AS (SELECT 'run_' || CAST(user_id AS VARCHAR) AS run_name, max(ts) AS reg FROM events WHERE event_type = '{P.REGISTER_EVENT}' GROUP BY 1),
lg AS (SELECT 'run_' || CAST(user_id AS VARCHAR) AS run_name, max(ts) AS last_row FROM events WHERE event_type = '{P.EVAL_EVENT}' GROUP BY 1)
SELECT run_name FROM idx WHERE NOT EXISTS (SELECT 1 FROM lg WHERE lg.run_name = idx.run_name AND lg.last_row > idx.reg)"""
    q["words_with_best_pair"] = f"""WITH {WORD_FREQ.replace("w0 AS (", "w0 AS MATERIALIZED (")},
p AS ({pairs_of("w0")}),
b AS MATERIALIZED (SELECT '|' || "left" || '||' || "right" || '|' AS pair FROM p {ORDER_PAIRS} LIMIT 1)
SELECT toks, freq FROM b JOIN w0 ON contains(w0.toks, b.pair)"""
    q["loss_curve_points"] = f"""WITH {METRICS},
pts AS (SELECT run_name, step, 'train_loss' AS series, train_loss AS loss FROM metrics WHERE train_loss IS NOT NULL
        UNION ALL SELECT run_name, step, 'val_loss', val_loss FROM metrics WHERE val_loss IS NOT NULL),
e0 AS (SELECT run_name, min(step) AS x_min, max(step) AS x_max, min(loss) AS y_min, max(loss) AS y_max FROM pts GROUP BY run_name),
ext AS (SELECT run_name, x_min, CASE WHEN x_min = x_max THEN x_min + 1 ELSE x_max END AS x_max,
               y_min, CASE WHEN y_min = y_max THEN y_min + 1 ELSE y_max END AS y_max FROM e0)
SELECT p.run_name, p.series, p.step,
       round(80 + (p.step - e.x_min) / (e.x_max - e.x_min) * 790, 3) AS px,
       round(40 + (e.y_max - p.loss) / (e.y_max - e.y_min) * 410, 3) AS py
FROM pts p JOIN ext e USING (run_name)"""
    q["decode_by_join"] = q["encode_decode_roundtrip"]
    q["stream_pretoken_counts"] = q["pretoken_counts"]
    q["stream_encode_token_counts"] = q["tokenize_sql"] = q["encode_token_counts"]
    q["stream_run_status"] = f"""
SELECT 'run_' || CAST(user_id AS VARCHAR) AS run_name, CAST(count(*) AS BIGINT) AS n_rows, max(event_id) AS last_step,
       max_by(value, event_id) AS last_train_loss, min(CASE WHEN event_type = '{P.EVAL_EVENT}' THEN value END) AS best_val_loss
FROM events GROUP BY 1"""
    return q
