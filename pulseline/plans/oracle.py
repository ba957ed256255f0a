"""DuckDB SQL equivalents of the named plans (the correctness oracle).

The sensor plans read device lines rendered from ``events``; the rendering
is simple enough to write straight in SQL, so every oracle works on the
``events`` view itself.  The default filter keeps exactly the ``view``
events.
"""

from __future__ import annotations

# The device-line rendering of an events row, as SQL.
_DATE = "upper(strftime({t}, '%d%b%Y'))"
_TIME = "strftime({t}, '%H%M%S')"
_NEXT = "(ts + INTERVAL 1 DAY)"

LINE_FIELDS_SQL = [
    "'TR-00' || CAST(user_id % 3 AS VARCHAR)",
    "lpad(CAST(user_id AS VARCHAR), 9, '0')",
    "''",
    "CASE WHEN user_id % 2 = 0 THEN 'M' ELSE 'F' END",
    "'S0' || CAST(1 + event_id % 3 AS VARCHAR)",
    _DATE.format(t="ts"), _TIME.format(t="ts"),
    _DATE.format(t=_NEXT), _TIME.format(t=_NEXT),
    "CASE WHEN event_type = 'signup' THEN 'FINDING' ELSE 'MEASUREMENT' END",
    "CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'HR DAILY' "
    "ELSE 'SYSTEM TRIGGERED MEASUREMENT' END",
    "CASE event_type WHEN 'click' THEN 'SUMMARY (MAX) HEART RATE' "
    "WHEN 'purchase' THEN 'SUMMARY (MIN) HEART RATE' WHEN 'signup' THEN 'RHYTHM' "
    "ELSE 'SUMMARY (MEAN) HEART RATE' END",
    "CASE WHEN event_type = 'signup' THEN 'Sinus Rhythm' "
    "ELSE CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) END",
    "CASE WHEN event_type = 'signup' THEN 'SINUS RHYTHM' ELSE '' END",
    "CASE WHEN event_type = 'signup' THEN '' ELSE 'BEATS/MIN' END",
    "'1'",
    "'DEV' || lpad(CAST(user_id % 7 AS VARCHAR), 4, '0')",
    "''", "''", "''", "''", "''",
    "CAST(event_id AS VARCHAR)",
    _DATE.format(t="ts"), _TIME.format(t="ts"),
    "CASE WHEN event_type IN ('view', 'click', 'purchase') THEN "
    + _DATE.format(t=_NEXT) + " ELSE '' END",
    "CASE WHEN event_type IN ('view', 'click', 'purchase') THEN "
    + _TIME.format(t=_NEXT) + " ELSE '' END",
]
LINE_SQL = "concat_ws('|', " + ", ".join(LINE_FIELDS_SQL) + ")"

REC_CTE = f"""
rec AS (
  SELECT
    CAST(floor(value) AS INTEGER) - 50 AS variance,
    CAST(((CAST(floor(value) AS INTEGER) - 50) * 100) // 50 AS FLOAT) AS percentage,
    'TR-00' || CAST(user_id % 3 AS VARCHAR) AS trial_id,
    lpad(CAST(user_id AS VARCHAR), 9, '0') AS patient_id,
    'S0' || CAST(1 + event_id % 3 AS VARCHAR) AS visit_name,
    CAST(floor(value) AS INTEGER) AS value,
    'DEV' || lpad(CAST(user_id % 7 AS VARCHAR), 4, '0') AS device,
    CAST(ts AS DATE) AS start_date,
    CAST(strftime(ts, '%H%M%S') AS INTEGER) AS start_time,
    CAST({_NEXT} AS DATE) AS end_date,
    CAST(strftime({_NEXT}, '%H%M%S') AS INTEGER) AS end_time,
    date_trunc('second', ts) AS start_ts,
    event_id AS seq,
    'TR-00' || CAST(user_id % 3 AS VARCHAR) || '_' || lpad(CAST(user_id AS VARCHAR), 9, '0')
      || '_S0' || CAST(1 + event_id % 3 AS VARCHAR) AS record_key
  FROM events
  WHERE event_type = 'view'
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SUMMARY_SELECT = """
  SELECT record_key, max(trial_id) AS trial_id, max(patient_id) AS patient_id,
         max(visit_name) AS visit_name,
         count(*) AS n_records, CAST(sum(value) AS BIGINT) AS sum_value,
         min(value) AS min_value, max(value) AS max_value,
         CAST(sum(value) // greatest(count(*), 1) AS BIGINT) AS avg_int,
         CAST(sum(value) AS DOUBLE) / count(*) AS avg_value
"""

REPORT_AGGS = """
         count(*) AS n_records, min(value) AS min_value, max(value) AS max_value,
         CAST(sum(value) AS DOUBLE) / count(*) AS avg_value,
         min(variance) AS min_variance, max(variance) AS max_variance,
         CAST(sum(variance) AS DOUBLE) / count(*) AS avg_variance,
         sum(CAST(percentage AS DOUBLE)) / count(*) AS avg_percentage
"""

TRIAL_COLS = ("variance, percentage, trial_id, patient_id, visit_name, value, device, "
              "start_date, start_time, end_date, end_time, start_ts, seq, record_key")

SQL = {
    "filter_lines": f"SELECT {LINE_SQL} AS line FROM events WHERE event_type = 'view'",
    "trial_records": _with(REC_CTE) + f"SELECT {TRIAL_COLS} FROM rec",
    "summary_by_key": _with(REC_CTE) + SUMMARY_SELECT + " FROM rec GROUP BY record_key",
    "patient_report": _with(REC_CTE) + "SELECT patient_id," + REPORT_AGGS
    + " FROM rec GROUP BY patient_id",
    "report_by_visit": _with(REC_CTE) + "SELECT trial_id, visit_name, device," + REPORT_AGGS
    + " FROM rec GROUP BY trial_id, visit_name, device",
    "latest_by_key": _with(REC_CTE) + f"SELECT {TRIAL_COLS} FROM rec "
    "QUALIFY row_number() OVER (PARTITION BY record_key ORDER BY start_ts DESC, seq DESC) = 1",
    "running_summary": _with(REC_CTE) + """
SELECT record_key, trial_id, patient_id, visit_name, value, start_ts, seq,
       run_count, run_sum, run_min, run_max,
       CAST(run_sum // greatest(run_count, 1) AS BIGINT) AS run_avg_int,
       CAST(run_sum AS DOUBLE) / run_count AS run_avg
FROM (
  SELECT *,
    count(*) OVER w AS run_count,
    CAST(sum(value) OVER w AS BIGINT) AS run_sum,
    min(value) OVER w AS run_min,
    max(value) OVER w AS run_max
  FROM rec
  WINDOW w AS (PARTITION BY record_key ORDER BY start_ts, seq
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)""",
    "merge_summaries": _with(REC_CTE) + SUMMARY_SELECT + " FROM rec GROUP BY record_key",
    "record_count": _with(REC_CTE) + "SELECT count(*) AS n_records FROM rec",
    "rejects": f"SELECT {LINE_SQL} AS raw, 'bad_int:result' AS reason FROM events "
    "WHERE event_type = 'signup'",
    "alerts": _with(REC_CTE) + """
SELECT record_key, start_ts, seq, value, variance,
       CASE WHEN variance > 0 THEN 'high' ELSE 'low' END AS alert
FROM rec WHERE abs(variance) > 10""",
}


# The literal fold, step by step, as a recursive CTE (independent of the
# closed form used by the Spark plan).
FOLD_CTES = [REC_CTE, """
seqd AS (
  SELECT *, row_number() OVER (PARTITION BY record_key ORDER BY start_ts, seq) AS n FROM rec
)""", """
fold(record_key, n, trial_id, patient_id, visit_name, value, start_ts, seq,
     max_value, min_value, n_records, sum_value) AS (
  SELECT record_key, n, '', '', '', value, start_ts, seq, 0, 1000, CAST(0 AS BIGINT),
         CAST(0 AS BIGINT)
  FROM seqd WHERE n = 1
  UNION ALL
  SELECT s.record_key, s.n, s.trial_id, s.patient_id, s.visit_name, s.value, s.start_ts, s.seq,
         CASE WHEN s.value > f.max_value THEN s.value ELSE 0 END,
         CASE WHEN s.value < f.min_value THEN s.value ELSE 2147483647 END,
         f.n_records + 1, f.sum_value + s.value
  FROM fold f JOIN seqd s ON s.record_key = f.record_key AND s.n = f.n + 1
)"""]
FOLD_SELECT = """
SELECT record_key, trial_id, patient_id, visit_name, value, start_ts, seq,
       CAST(max_value AS INTEGER) AS max_value, CAST(min_value AS INTEGER) AS min_value,
       n_records, sum_value, CAST(sum_value // greatest(n_records, 1) AS BIGINT) AS avg_int
FROM fold"""

SQL["compat_running"] = "WITH RECURSIVE " + ",\n".join(FOLD_CTES) + FOLD_SELECT
SQL["compat_latest"] = ("WITH RECURSIVE " + ",\n".join(FOLD_CTES) + FOLD_SELECT
                        + " QUALIFY row_number() OVER (PARTITION BY record_key "
                        "ORDER BY start_ts DESC, seq DESC) = 1")


# Tokens of each document with the JVM split(" ") rule (trailing empty
# tokens dropped, an all-space text gives none); pos is 0-based.
TOKENS_CTES = ["""
parts AS (
  SELECT doc_id,
         CASE WHEN regexp_matches(text, '^ +$') THEN CAST([] AS VARCHAR[])
              ELSE string_split(regexp_replace(text, ' +$', ''), ' ') END AS p
  FROM documents
)""", """
tok AS (
  SELECT doc_id, unnest(range(0, len(p))) AS pos, unnest(p) AS word FROM parts
)""", """
seed(word, seed_n) AS (VALUES ('hello', 1), ('world', 1))"""]

SQL["word_totals"] = _with(*TOKENS_CTES) + """
SELECT t.word, CAST(t.n + coalesce(s.seed_n, 0) AS BIGINT) AS n
FROM (SELECT word, count(*) AS n FROM tok GROUP BY word) t LEFT JOIN seed s USING (word)"""
SQL["running_word_count"] = _with(*TOKENS_CTES) + """
SELECT t.doc_id, t.pos, t.word,
       CAST(count(*) OVER (PARTITION BY t.word ORDER BY t.doc_id, t.pos
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            + coalesce(s.seed_n, 0) AS BIGINT) AS n
FROM tok t LEFT JOIN seed s USING (word)"""


PARTS_CTE = """
parts AS (
  SELECT CAST(o_custkey AS VARCHAR) || '_' || o_orderpriority AS target,
         CAST(o_orderkey AS VARCHAR) AS source, o_orderkey AS source_rank,
         o_orderstatus AS content
  FROM orders
)"""
BY_TARGET_CTE = """
agg AS (
  SELECT target, count(*) AS n_sources,
         arg_min(source_rank, source_rank) AS first_rank,
         arg_min(content, source_rank) AS first_content,
         arg_min(source, source_rank) AS first_source,
         arg_max(source, source_rank) AS last_source,
         arg_max(source_rank, source_rank) AS last_rank,
         arg_max(content, source_rank) AS last_content,
         count(DISTINCT sha1(content)) = 1 AS same_content
  FROM parts GROUP BY target
)"""


def _one(strategy, rank, content, where="TRUE"):
    return (f"SELECT target, '{strategy}' AS strategy, {rank} AS source_rank, 0 AS line_no, "
            f"{content} AS content FROM agg WHERE {where}")


def _conf(strategy, where):
    return (f"SELECT target, '{strategy}' AS strategy, n_sources, first_source, last_source "
            f"FROM agg WHERE {where}")


_RC = _with(PARTS_CTE, BY_TARGET_CTE)
SQL["reconcile_first"] = _RC + _one("first", "first_rank", "first_content")
SQL["reconcile_last"] = _RC + _one("last", "last_rank", "last_content")
SQL["reconcile_single"] = _RC + _one("singleOrError", "first_rank", "first_content",
                                     "n_sources = 1")
SQL["reconcile_single_conflicts"] = _RC + _conf("singleOrError", "n_sources > 1")
SQL["reconcile_dedup"] = _RC + _one("deduplicate", "first_rank", "first_content", "same_content")
SQL["reconcile_dedup_conflicts"] = _RC + _conf("deduplicate", "NOT same_content")

CONCAT_SELECT = """SELECT target, 'concat' AS strategy, source_rank, 0 AS line_no,
  CASE WHEN suffix(content, chr(10)) THEN content ELSE content || chr(10) END AS content
FROM parts"""
DISTINCT_SELECT = """SELECT target, 'filterDistinctLines' AS strategy,
  arg_min(source_rank, (source_rank, line_no)) AS source_rank,
  CAST(arg_min(line_no, (source_rank, line_no)) AS INTEGER) AS line_no, line AS content
FROM (
  SELECT target, source_rank, unnest(range(0, len(l))) AS line_no, unnest(l) AS line
  FROM (SELECT target, source_rank,
          CASE WHEN content = '' THEN CAST([] AS VARCHAR[])
               ELSE string_split_regex(regexp_replace(content, '(\r\n|\r|\n)$', ''),
                                       '\r\n|\r|\n') END AS l
        FROM parts))
GROUP BY target, line"""
SQL["reconcile_concat"] = _with(PARTS_CTE) + CONCAT_SELECT
SQL["reconcile_distinct_lines"] = _with(PARTS_CTE) + DISTINCT_SELECT
SQL["reconcile_rename"] = _with(PARTS_CTE) + """
SELECT regexp_replace(target, '([.]\\w+)$', '') || '_'
         || regexp_replace(source, '([.]\\w+)$', '')
         || coalesce(regexp_extract(target, '([.]\\w+)$', 1), '') AS target,
       'rename' AS strategy, source_rank, 0 AS line_no, content
FROM parts"""

RULE_CTE = """
tagged AS (
  SELECT *, CASE WHEN regexp_matches(target, '_1-URGENT$') THEN 'concat'
                 WHEN regexp_matches(target, '_2-HIGH$') THEN 'first'
                 WHEN regexp_matches(target, '_3-MEDIUM$') THEN 'last'
                 WHEN regexp_matches(target, '_4-NOT SPECIFIED$') THEN 'filterDistinctLines'
                 WHEN regexp_matches(target, '_5-LOW$') THEN 'discard'
                 ELSE 'deduplicate' END AS strategy
  FROM parts
)"""


def _sub(strategy):
    return (f"sub_{strategy} AS (SELECT target, source, source_rank, content FROM tagged "
            f"WHERE strategy = '{strategy}')")


def _scoped(sql, strategy):
    return sql.replace("FROM parts", f"FROM sub_{strategy}")


SQL["reconcile_by_rule"] = _with(
    PARTS_CTE, RULE_CTE, *[_sub(s) for s in ("concat", "first", "last", "filterDistinctLines",
                                             "deduplicate")],
    _scoped(BY_TARGET_CTE, "first").replace("agg AS", "agg_first AS"),
    _scoped(BY_TARGET_CTE, "last").replace("agg AS", "agg_last AS"),
    _scoped(BY_TARGET_CTE, "deduplicate").replace("agg AS", "agg_dedup AS"),
) + " UNION ALL ".join([
    _scoped(CONCAT_SELECT, "concat"),
    _one("first", "first_rank", "first_content").replace("FROM agg", "FROM agg_first"),
    _one("last", "last_rank", "last_content").replace("FROM agg", "FROM agg_last"),
    "(" + _scoped(DISTINCT_SELECT, "filterDistinctLines") + ")",
    _one("deduplicate", "first_rank", "first_content", "same_content")
    .replace("FROM agg", "FROM agg_dedup"),
])
SQL["reconcile_counts"] = _with(PARTS_CTE, RULE_CTE) + """
SELECT strategy, count(*) AS n_targets
FROM (SELECT strategy, target, count(*) AS n FROM tagged GROUP BY strategy, target)
WHERE n >= CASE WHEN strategy IN ('rename', 'discard') THEN 1 ELSE 2 END
GROUP BY strategy"""


# Streaming plans produce the batch plans' results.
SQL["stream_running"] = SQL["running_summary"]
SQL["stream_summary"] = SQL["summary_by_key"]
SQL["stream_records_latest"] = SQL["latest_by_key"]
SQL["stream_compat"] = SQL["compat_running"]
SQL["stream_word_count"] = SQL["running_word_count"]
SQL["stream_word_totals"] = SQL["word_totals"]


SQL["documents_json"] = _with(REC_CTE) + """
SELECT record_key AS doc_id,
       CAST(to_json({'variance': variance, 'percentage': percentage, 'trial_id': trial_id,
                     'patient_id': patient_id, 'visit_name': visit_name, 'value': value,
                     'device': device, 'start_date': start_date, 'start_time': start_time,
                     'end_date': end_date, 'end_time': end_time}) AS VARCHAR) AS doc
FROM rec"""


SQL["summary_by_device_key"] = _with(REC_CTE) + SUMMARY_SELECT.replace(
    "SELECT record_key,", "SELECT record_key || '_' || device AS record_key,") + \
    " FROM rec GROUP BY record_key, device"


# Lines with faults: (rest of event_id, spoiled field, its text, reason); the
# value -2147483640 parses, but its difference from the base does not fit.
_FAULTS = [(1, 0, "", "missing_key"), (2, 12, "n/a", "bad_int:result"),
           (3, 12, "99999999999", "bad_int:result"), (4, 23, "31FEB2024", "bad_date:start_date"),
           (5, 24, "256161", "bad_time:start_time"), (6, 25, "yesterday", "bad_date:end_date"),
           (7, 26, "120060", "bad_time:end_time"), (8, 12, "-2147483640", "bad_int:result"),
           (9, 24, "", None)]
_spoiled = list(LINE_FIELDS_SQL)
for _r, _i, _t, _ in _FAULTS:
    _spoiled[_i] = f"CASE WHEN event_id % 17 = {_r} THEN '{_t}' ELSE {_spoiled[_i]} END"
# signup lines have no number, which is checked before dates and times
_REASON = "CASE WHEN event_id % 17 = 0 THEN 'short_line' WHEN event_id % 17 = 1 THEN 'missing_key' " + \
    "WHEN event_type = 'signup' AND event_id % 17 NOT IN (2, 3, 8) THEN 'bad_int:result' " + \
    " ".join(f"WHEN event_id % 17 = {r} THEN '{why}'" for r, _, _, why in _FAULTS if why) + " END"
SQL["rejects_all_reasons"] = f"""
SELECT * FROM (
  SELECT CASE WHEN event_id % 17 = 0 THEN concat_ws('|', {", ".join(_spoiled[:5])})
              ELSE concat_ws('|', {", ".join(_spoiled)}) END AS raw,
         {_REASON} AS reason
  FROM events) WHERE reason IS NOT NULL"""
_REC_FAULTS = REC_CTE.replace("rec AS", "all_rec AS") + """,
rec AS (
  SELECT * REPLACE (CASE WHEN seq % 17 = 9 THEN date_trunc('day', start_ts) ELSE start_ts END AS start_ts)
  FROM all_rec WHERE seq % 17 > 8)"""
_REC_FAULTS_ALL = _REC_FAULTS.replace("ELSE start_ts END AS start_ts)", """ELSE start_ts END AS start_ts,
      CASE WHEN seq % 17 = 9 THEN NULL ELSE start_time END AS start_time)""")
SQL["running_summary_with_faults"] = SQL["running_summary"].replace(REC_CTE, _REC_FAULTS)
SQL["summary_by_patient"] = _with(REC_CTE) + """
  SELECT patient_id AS record_key, arg_max(trial_id, (start_ts, seq)) AS trial_id,
         arg_max(patient_id, (start_ts, seq)) AS patient_id,
         arg_max(visit_name, (start_ts, seq)) AS visit_name,
         count(*) AS n_records, CAST(sum(value) AS BIGINT) AS sum_value,
         min(value) AS min_value, max(value) AS max_value,
         CAST(sum(value) // greatest(count(*), 1) AS BIGINT) AS avg_int,
         CAST(sum(value) AS DOUBLE) / count(*) AS avg_value
  FROM rec GROUP BY patient_id"""


# Document parts: fr targets are renamed (texts/fr7.txt from src3.jar becomes
# texts/fr7_src3.txt), which regroups the parts of one source; then the last wins.
_DOC_PARTS = """
old AS (
  SELECT 'texts/' || lang || CAST(doc_id % 40 AS VARCHAR) || '.txt' AS was,
         source || '.jar' AS source, doc_id AS source_rank, text AS content, lang, source AS stem
  FROM documents),
parts AS (
  SELECT CASE WHEN lang = 'fr' THEN regexp_replace(was, '[.]txt$', '') || '_' || stem || '.txt' ELSE was END
           AS target, was, source, source_rank, content, lang
  FROM old)"""
_DOC_AGG = BY_TARGET_CTE.replace("FROM parts GROUP", "FROM parts WHERE lang IN ('fr', 'es') GROUP").replace(
    "same_content\n", "same_content, any_value(lang) AS lang\n")
SQL["reconcile_documents"] = _with(_DOC_PARTS, _DOC_AGG) + " UNION ALL ".join([
    "(" + DISTINCT_SELECT.replace("FROM parts", "FROM parts WHERE lang = 'en'") + ")",
    CONCAT_SELECT + " WHERE lang = 'de'",
    _one("last", "last_rank", "last_content", "lang = 'fr'"),
    _one("deduplicate", "first_rank", "first_content", "lang = 'es' AND same_content")])
SQL["reconcile_documents_conflicts"] = _with(_DOC_PARTS, _DOC_AGG) + _conf(
    "deduplicate", "lang = 'es' AND NOT same_content")
SQL["reconcile_documents_counts"] = _with(_DOC_PARTS) + """
SELECT strategy, count(*) AS n_targets FROM (
  SELECT CASE lang WHEN 'en' THEN 'filterDistinctLines' WHEN 'fr' THEN 'last' WHEN 'de' THEN 'concat'
              ELSE 'deduplicate' END AS strategy, target, count(*) AS n
  FROM parts GROUP BY ALL
  UNION ALL SELECT 'rename', was, 2 FROM old WHERE lang = 'fr' GROUP BY was)
WHERE n >= 2 GROUP BY strategy"""


# The keyed store holds what the batch plans give.
SQL["store_latest_by_key"] = SQL["latest_by_key"]
SQL["store_summary_by_key"] = SQL["summary_by_key"]


# The one-pass program: only lines with all terms are parsed, which a line cut
# after five fields is not; every other bad line of a view event is a reject.
_BAD = "event_type = 'view' AND event_id % 17 BETWEEN 1 AND 8"
SQL["stream_one_pass_running"] = SQL["running_summary_with_faults"]
SQL["stream_one_pass_rejects"] = f"""
SELECT concat_ws('|', {", ".join(_spoiled)}) AS raw, {_REASON} AS reason FROM events WHERE {_BAD}"""
SQL["stream_replayed_latest"] = SQL["latest_by_key"].replace(REC_CTE, _REC_FAULTS_ALL)
SQL["stream_replayed_summary"] = SQL["summary_by_key"].replace(REC_CTE, _REC_FAULTS)
SQL["stream_replayed_alerts"] = SQL["alerts"].replace(REC_CTE, _REC_FAULTS)
# the replay takes all lines by another separator, under which the others are short
SQL["stream_dead_letters"] = f"""
SELECT CASE WHEN event_id % 13 = 5 THEN concat_ws(',', {", ".join(_spoiled)})
            ELSE concat_ws('|', {", ".join(_spoiled)}) END AS raw,
       CASE WHEN event_id % 13 = 5 THEN {_REASON} ELSE 'short_line' END AS reason, 1 AS attempt
FROM events WHERE {_BAD}"""


SQL["reconcile_documents_conflict_sources"] = _with(_DOC_PARTS) + """
SELECT target, source, source_rank FROM parts WHERE lang = 'es' AND target IN (
  SELECT target FROM parts WHERE lang = 'es' GROUP BY target HAVING count(DISTINCT sha1(content)) > 1)"""
SQL["reconcile_merged_pieces"] = f"""
WITH whole AS (
  SELECT target, hex(encode(string_agg(
    content || CASE WHEN strategy = 'filterDistinctLines' THEN chr(10) ELSE '' END, ''
    ORDER BY source_rank, line_no))) AS h
  FROM ({SQL["reconcile_documents"]}) GROUP BY target),
cut AS (
  SELECT target, piece, substr(h, 1 + 131072 * piece, 131072) AS x
  FROM (SELECT target, h, unnest(range(0, greatest(1, (len(h) + 131071) // 131072))) AS piece FROM whole))
SELECT target, piece, 65536 * piece AS offset, len(x) // 2 AS n_bytes, sha256(unhex(x)) AS content_sha256
FROM cut"""
_ALL_REASONS = ["short_line", "missing_key", "bad_int:result", "bad_date:start_date", "bad_time:start_time",
                "bad_date:end_date", "bad_time:end_time"]
SQL["line_counts"] = f"""
WITH r AS (SELECT {_REASON} AS reason FROM events)
SELECT 'read' AS what, count(*) AS n FROM r
UNION ALL SELECT 'kept', count(*) FROM r WHERE reason IS NULL
UNION ALL SELECT w.what, count(r.reason)
FROM (VALUES {", ".join(f"('{x}')" for x in _ALL_REASONS)}) w(what) LEFT JOIN r ON r.reason = w.what GROUP BY w.what"""
SQL["rejects_counted"] = SQL["rejects_all_reasons"]
SQL["stream_ordered_running"] = SQL["running_summary"]
SQL["stream_ordered_late"] = _with(REC_CTE) + "SELECT 0 AS n_late, count(*) AS n_in_order FROM rec"


# Reports and searches answered by stores.
SQL["rollup_patient_report"] = SQL["patient_report"]
SQL["rollup_report_by_visit"] = SQL["report_by_visit"]
SQL["rollup_filtered_report"] = _with(REC_CTE) + "SELECT device," + REPORT_AGGS + \
    " FROM rec WHERE trial_id = 'TR-001' AND visit_name IN ('S01', 'S03') GROUP BY device"
SQL["search_lines"] = f"""
SELECT {LINE_SQL} AS line FROM events
WHERE event_type = 'view' AND user_id % 3 = 1 AND user_id % 2 = 1"""
