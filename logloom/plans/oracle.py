"""The registered queries in DuckDB's SQL.

The log is derived from events directly, not through text lines, so that the
parser is held against values that never were text.
"""

from __future__ import annotations

SEVERITIES = ("INFO", "WARNING", "ERROR", "SEVERE", "FATAL", "FAILURE")
_COUNTS = ", ".join(f"count(*) FILTER (WHERE severity = '{s}') AS {s.lower()}_count" for s in SEVERITIES)
_BASE = ("event_count", "distinct_nodes", "distinct_templates", *(f"{s.lower()}_count" for s in SEVERITIES), "error_rate")

EVENTS = r"""
log AS (
  SELECT event_id, event_id + 1 AS line_no, floor(epoch(ts))::BIGINT AS epoch, ts, user_id::VARCHAR AS node,
         CASE WHEN event_type = 'view' THEN 'INFO' WHEN event_type = 'click' THEN 'WARNING' WHEN event_type = 'signup' THEN 'ERROR'
              WHEN event_type = 'purchase' THEN 'SEVERE' WHEN value >= 100 THEN 'FAILURE' ELSE 'FATAL' END AS severity,
         event_type = 'error' AND value >= 200 AS is_alert,
         event_type || ' k=' || coalesce(json_extract_string(props, '$.k'), '') || ' user ' || user_id AS message
  FROM events
), masked AS (
  SELECT *, regexp_replace(message, '\b\d+(\.\d+)?\b', '<NUM>', 'g') AS template FROM log
), ev AS (
  SELECT *, substr(sha1(template), 1, 16) AS template_id, CASE WHEN is_alert THEN 'ALERT' ELSE '-' END AS label FROM masked
)"""


def _windows(seconds: int = 3600, where: str = "true") -> str:
    return f"""{EVENTS}, win AS (
  SELECT {seconds} AS window_seconds, epoch // {seconds} * {seconds} AS window_start, count(*) AS event_count,
         count(DISTINCT node) AS distinct_nodes, count(DISTINCT template_id) AS distinct_templates, {_COUNTS},
         (count(*) FILTER (WHERE severity NOT IN ('INFO', 'WARNING')))::DOUBLE / count(*) AS error_rate,
         count(*) FILTER (WHERE is_alert) AS alert_count, bool_or(is_alert) AS is_anomalous
  FROM ev WHERE {where} GROUP BY 2
), tc AS (
  SELECT {seconds} AS window_seconds, epoch // {seconds} * {seconds} AS window_start, template_id, count(*) AS event_count FROM ev WHERE {where} GROUP BY 2, 3
)"""


_PARTS = f"""{_windows()}, sizes AS (
  SELECT count(*) AS n, floor(count(*) * 0.7::DOUBLE)::BIGINT AS n_train, floor(floor(count(*) * 0.7::DOUBLE) * 0.8::DOUBLE)::BIGINT AS n_fit FROM win
), parts AS (
  SELECT w.*, w.position AS pos, CASE WHEN position < n_fit THEN 'fit' WHEN position < n_train THEN 'validation' ELSE 'test' END AS part
  FROM (SELECT *, row_number() OVER (ORDER BY window_start) - 1 AS position FROM win) w, sizes
)"""

_TOP = f"""{_PARTS}, top AS (
  SELECT template_id, sum(event_count)::BIGINT AS total, row_number() OVER (ORDER BY sum(event_count) DESC, template_id) AS rank
  FROM tc WHERE window_start < (SELECT min(window_start) FROM parts WHERE part = 'test') GROUP BY template_id
  ORDER BY total DESC, template_id LIMIT 3
)"""

_TPL = ", ".join(f"coalesce(sum(t.event_count) FILTER (WHERE r.rank = {i}), 0)::DOUBLE AS tpl_{i}" for i in (1, 2, 3))
_MATRIX = f"""{_TOP}, wide AS (
  SELECT t.window_start, {_TPL} FROM tc t JOIN top r ON t.template_id = r.template_id GROUP BY 1
), matrix AS (
  SELECT p.window_start, p.part, p.is_anomalous AS label, {", ".join(f"p.{c}::DOUBLE AS {c}" for c in _BASE)},
         {", ".join(f"coalesce(w.tpl_{i}, 0.0) AS tpl_{i}" for i in (1, 2, 3))}
  FROM parts p LEFT JOIN wide w ON p.window_start = w.window_start
)"""
_FEATURES = (*_BASE, "tpl_1", "tpl_2", "tpl_3")
_FREE = ("event_count", "distinct_nodes", "distinct_templates", "tpl_1", "tpl_2", "tpl_3")


def _score(name: str, features: tuple[str, ...]) -> str:
    """CTEs with the z-score, its threshold and its predictions."""
    stats = ", ".join(f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS s_{c}" for c in features)
    return f"""{name}_stats AS (SELECT {stats} FROM matrix WHERE part <> 'test'
), {name}_scored AS (
  SELECT window_start, part, label, greatest({", ".join(f"abs(({c} - m_{c}) / s_{c})" for c in features)}) AS score FROM matrix, {name}_stats
), {name}_swept AS (
  SELECT score, row_number() OVER w AS rn, sum(label::INT) OVER (w ROWS UNBOUNDED PRECEDING) AS tp, sum(label::INT) OVER () AS pos
  FROM {name}_scored WHERE part <> 'test' WINDOW w AS (ORDER BY score DESC, window_start)
), {name}_best AS (
  SELECT coalesce((SELECT score FROM {name}_swept WHERE pos > 0 ORDER BY 2.0 * tp / (rn + pos) DESC, rn LIMIT 1), 'infinity'::DOUBLE) AS threshold
)"""


_Z = f"{_MATRIX}, {_score('za', _FEATURES)}, {_score('zf', _FREE)}"
_PRED = f"""{_Z}, pred AS (
  SELECT 0 AS ordinal, 'severity rule' AS detector, '-' AS variant, window_start, label, (fatal_count + failure_count) > 0 AS predicted FROM matrix WHERE part = 'test'
  UNION ALL SELECT 1, 'z-score', 'all', window_start, label, score >= threshold FROM za_scored, za_best WHERE part = 'test'
  UNION ALL SELECT 2, 'z-score', 'severity-free', window_start, label, score >= threshold FROM zf_scored, zf_best WHERE part = 'test'
), conf AS (
  SELECT ordinal, detector, variant, count(*) FILTER (WHERE label AND predicted) AS true_positives, count(*) FILTER (WHERE NOT label AND predicted) AS false_positives,
         count(*) FILTER (WHERE label AND NOT predicted) AS false_negatives, count(*) FILTER (WHERE NOT label AND NOT predicted) AS true_negatives
  FROM pred GROUP BY 1, 2, 3
), scored AS (
  SELECT *, CASE WHEN true_positives + false_positives = 0 THEN 0.0 ELSE true_positives::DOUBLE / (true_positives + false_positives) END AS precision,
         CASE WHEN true_positives + false_negatives = 0 THEN 0.0 ELSE true_positives::DOUBLE / (true_positives + false_negatives) END AS recall,
         CASE WHEN 2 * true_positives + false_positives + false_negatives = 0 THEN 0.0
              ELSE 2.0::DOUBLE * true_positives / (2 * true_positives + false_positives + false_negatives) END AS f1
  FROM conf
), flags AS (
  SELECT window_start, '{{' || string_agg('"' || name || '":' || predicted, ',' ORDER BY name) || '}}' AS flags
  FROM (SELECT window_start, predicted, CASE WHEN variant = '-' THEN detector ELSE detector || ' (' || variant || ')' END AS name FROM pred) GROUP BY 1
)"""

#: Which of ten ways a line of the damaged log takes, and what becomes of it.
_DAMAGED = f"""{EVENTS}, ways AS (SELECT *, line_no % 10 AS way FROM ev
), raw AS (
  SELECT *, strftime(ts, '%Y.%m.%d') AS day, strftime(ts, '%Y-%m-%d-%H.%M.%S.') || lpad((epoch_us(ts) % 1000000)::VARCHAR, 6, '0') AS stamp FROM ways
), marked AS (
  SELECT *, CASE way WHEN 1 THEN 'undecodable_bytes' WHEN 2 THEN 'nul_byte' WHEN 3 THEN 'empty_line' WHEN 4 THEN 'too_few_fields' WHEN 5 THEN 'bad_epoch'
                     WHEN 6 THEN 'bad_date' WHEN 7 THEN 'bad_datetime' WHEN 8 THEN 'unknown_severity' WHEN 9 THEN 'bad_epoch' END AS reason,
         label || ' ' || CASE way WHEN 5 THEN '12345' WHEN 9 THEN 'epoch' ELSE epoch::VARCHAR END || ' ' || CASE way WHEN 6 THEN '2024/01/01' ELSE day END || ' ' || node || ' ' ||
         CASE way WHEN 7 THEN '15:42:50' ELSE stamp END AS head,
         ' ' || node || ' RAS APP ' || CASE way WHEN 8 THEN 'NOTICE' ELSE severity END || ' ' || message AS tail
  FROM raw
)"""

_W_COLS = f"window_start, {', '.join(_BASE)}, alert_count, is_anomalous"
_RATES = "round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1"
_CONF = "true_positives, false_positives, false_negatives, true_negatives"
_ISO = "strftime(make_timestamp({0} * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00'"

_DOCS = f"""{_PARTS}, st AS (
  SELECT {", ".join(f"avg({c}::DOUBLE) AS m_{c}, coalesce(nullif(stddev_pop({c}::DOUBLE), 0), 1) AS s_{c}" for c in _BASE)} FROM parts WHERE part <> 'test'
), zs AS (
  SELECT parts.*, greatest({", ".join(f"abs(({c}::DOUBLE - m_{c}) / s_{c})" for c in _BASE)}) AS zscore FROM parts, st
), sw AS (
  SELECT zscore, row_number() OVER w AS rn, sum(is_anomalous::INT) OVER (w ROWS UNBOUNDED PRECEDING) AS tp, sum(is_anomalous::INT) OVER () AS positives
  FROM zs WHERE part <> 'test' WINDOW w AS (ORDER BY zscore DESC, window_start)
), th AS (
  SELECT coalesce((SELECT zscore FROM sw WHERE positives > 0 ORDER BY 2.0 * tp / (rn + positives) DESC, rn LIMIT 1), 'infinity'::DOUBLE) AS threshold
), docs AS (
  SELECT {_ISO.format("window_start")} AS window_id, {_ISO.format("window_start")} AS window_start, {_ISO.format("(window_start + 3600)")} AS window_end, window_seconds,
         {", ".join(c for c in _BASE if c != "error_rate")}, round(error_rate, 6) AS error_rate, alert_count, is_anomalous, 0::BIGINT AS late_events,
         round(zscore, 6) AS zscore, fatal_count + failure_count > 0 AS severity_flag, zscore >= threshold AS zscore_flag,
         fatal_count + failure_count > 0 OR zscore >= threshold AS flagged
  FROM zs, th
)"""

_CLOCKS = f"""{EVENTS}, placed AS (
  SELECT *, (epoch // 86400 % 2)::INT AS "partition", epoch // 3600 * 3600 AS w, line_no % 50 = 0 AS delayed FROM ev
), first_run AS (
  SELECT "partition", coalesce(max(w + 3600) FILTER (WHERE w + 3600 <= latest), 0) AS through
  FROM (SELECT *, max(epoch) OVER (PARTITION BY "partition") AS latest FROM placed WHERE NOT delayed) GROUP BY 1
), arrived AS (
  SELECT p.*, delayed AND w < coalesce(through, 0) AS late FROM placed p LEFT JOIN first_run USING ("partition")
), counted AS (
  SELECT "partition", w AS window_start, count(*) FILTER (WHERE NOT late) AS event_count, count(DISTINCT node) FILTER (WHERE NOT late) AS distinct_nodes,
         count(DISTINCT template_id) FILTER (WHERE NOT late) AS distinct_templates, count(*) FILTER (WHERE NOT late AND is_alert) AS alert_count,
         count(*) FILTER (WHERE late) AS late_events FROM arrived GROUP BY 1, 2
), clock AS (
  SELECT "partition", max(epoch) AS latest, max(epoch) AS watermark FROM placed GROUP BY 1
)"""
_STREAM = f"WITH {_windows()} SELECT {_W_COLS} FROM win"

ORACLE_SQL: dict[str, str] = {
    "parse_roundtrip": f"""WITH {EVENTS} SELECT 'events' AS source_file, line_no, epoch, node, 'RAS' AS event_type, 'APP' AS component, severity, label, is_alert,
        template_id, sha256(message) AS line_sha256, message FROM ev""",
    "quarantine_reasons": f"WITH {_DAMAGED} SELECT reason, count(*) AS n FROM marked WHERE reason IS NOT NULL GROUP BY reason",
    "quarantined_lines": f"""WITH {_DAMAGED} SELECT 'events' AS source_file, line_no, reason,
        CASE way WHEN 3 THEN '   ' WHEN 4 THEN head WHEN 2 THEN head || tail || '\\x00' ELSE head || tail END AS raw_line
        FROM marked WHERE reason IS NOT NULL AND way <> 1""",
    "prefix_limit": f"WITH {_DAMAGED} SELECT count(*) AS lines_read, count(*) FILTER (WHERE reason IS NULL) AS parsed, max(line_no) AS last_line FROM marked WHERE line_no <= 500",
    "mask_templates": r"""
WITH m AS (
  SELECT event_id, CASE event_id % 6
    WHEN 0 THEN 'generating core.' || event_id WHEN 1 THEN 'read 0x' || lower(hex(event_id)) || ' at 10.0.' || (event_id % 256) || '.7'
    WHEN 2 THEN 'node R02-M1-N0-C:J12-U11  lost ' || event_id || '.5 packets' WHEN 3 THEN 'file /p/gb1/job' || event_id || '/input closed '
    WHEN 4 THEN 'word deadbeef' || lpad(event_id::VARCHAR, 8, '0') || ' stored' ELSE event_type || ' ' || event_id END AS message
  FROM events
), t AS (
  SELECT event_id, message, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(message,
    '0x[0-9a-fA-F]+', '<HEX>', 'g'), '\b(?:\d{1,3}\.){3}\d{1,3}\b', '<IP>', 'g'), '\bR\d{2}-M\d-N\d+(?:-[A-Za-z]+)?(?::J\d+-U\d+)?\b', '<NODE>', 'g'),
    '\b[0-9a-fA-F]{8,}\b', '<HEX>', 'g'), '(?:/[\w.\-]+){2,}/?', '<PATH>', 'g'), '\b\d+(?:\.\d+)?\b', '<NUM>', 'g'), '\s+', ' ', 'g')) AS template
  FROM m
)
SELECT event_id, message, template, substr(sha1(template), 1, 16) AS template_id FROM t""",
    "template_catalog": f"WITH {EVENTS} SELECT template_id, min(template) AS template, min(epoch) AS first_seen FROM ev GROUP BY template_id",
    "scalar_functions": f"""WITH {_windows()} SELECT window_start, {_ISO.format("window_start")} AS window_id,
        strftime(make_timestamp(window_start * 1000000), '%Y-%m-%dT%H:%M:%S') || '.250+00:00' AS produced_at, event_count // 10 * 10 AS page,
        printf('%.1f%%', error_rate * 100) AS error_share, strftime(make_timestamp(window_start * 1000000), '%H:%M') AS clock,
        format('{{:,}}', event_count * 1000) AS shown, CASE WHEN is_anomalous THEN 'z-score (all)' ELSE 'z-score' END AS label,
        round(log10(event_count + 0.7::DOUBLE), 6) AS log_count FROM win""",
    "event_time_span": f"WITH {EVENTS} SELECT min(epoch) AS first, max(epoch) AS last, greatest(max(epoch) - min(epoch), 1) AS span FROM ev",
    "orphan_events": f"WITH {EVENTS} SELECT template_id, count(*) AS n FROM ev WHERE template_id NOT IN (SELECT template_id FROM ev WHERE line_no % 1000 = 0) GROUP BY template_id",
    "window_features_60": f"WITH {_windows(60)} SELECT window_seconds, {_W_COLS} FROM win",
    "window_features_3600": f"WITH {_windows()} SELECT window_seconds, {_W_COLS} FROM win",
    "window_template_counts": f"WITH {_windows()} SELECT * FROM tc",
    "last_line_per_window": f"WITH {EVENTS} SELECT epoch // 3600 * 3600 AS window_start, max(line_no) AS last_line, min(line_no) AS first_line FROM ev GROUP BY 1",
    "daily_histogram": f"""WITH {_windows()} SELECT strftime(make_timestamp(window_start * 1000000), '%Y-%m-%d') AS day, count(*) AS windows,
        count(*) FILTER (WHERE is_anomalous) AS flagged FROM win GROUP BY 1""",
    "windows_at_least": f"WITH {_windows()} SELECT count(*) AS n FROM win WHERE event_count >= 15",
    "duplicate_keys": f"WITH {EVENTS} SELECT node, severity, count(*) AS n FROM ev GROUP BY 1, 2 HAVING count(*) >= 2",
    "lag_percentiles": f"""WITH {EVENTS}, l AS (SELECT 3600 - epoch % 3600 AS lag FROM ev), r AS (SELECT lag, row_number() OVER (ORDER BY lag) - 1 AS rn, count(*) OVER () AS n FROM l)
        SELECT max(n) AS n, (min(lag) FILTER (WHERE rn = (n - 1) // 2) + min(lag) FILTER (WHERE rn = n // 2)) / 2.0::DOUBLE AS median,
               (min(lag) FILTER (WHERE rn = least(n - 1, floor(n * 0.95::DOUBLE)::BIGINT)))::DOUBLE AS p95 FROM r""",
    "split_parts": f"WITH {_PARTS} SELECT window_start, pos AS position, CASE WHEN part = 'test' THEN 'test' ELSE 'train' END AS part FROM parts",
    "fit_validation_parts": f"WITH {_PARTS} SELECT part, count(*) AS windows, min(window_start) AS first_window, max(window_start) AS last_window FROM parts GROUP BY part",
    "top_templates_train": f"WITH {_TOP} SELECT template_id, total FROM top",
    "feature_matrix": f"WITH {_MATRIX} SELECT * FROM matrix",
    "severity_free_matrix": f"WITH {_MATRIX} SELECT window_start, part, label, {', '.join(_FREE)} FROM matrix",
    "severity_rule_scores": f"WITH {_PRED} SELECT detector, variant, {_CONF}, precision, recall, f1 FROM scored WHERE ordinal = 0",
    "zscore_stats": f"WITH {_MATRIX}, {_score('za', _FEATURES)} "
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(m_{c}, 6) AS mean, round(s_{c}, 6) AS std FROM za_stats" for c in _FEATURES),
    "zscore_scores": f"WITH {_MATRIX}, {_score('za', _FEATURES)} SELECT window_start, part, round(score, 6) AS score FROM za_scored",
    "zscore_threshold": f"WITH {_Z} SELECT round(a.threshold, 6) AS all_features, round(f.threshold, 6) AS severity_free FROM za_best a, zf_best f",
    "zscore_eval": f"WITH {_PRED} SELECT detector, variant, {_CONF}, precision, recall, f1 FROM scored WHERE ordinal > 0",
    "threshold_sweep": f"""WITH {_PARTS}, s AS (SELECT row_number() OVER w AS position, window_start, event_count::DOUBLE AS score,
        (sum(is_anomalous::INT) OVER (w ROWS UNBOUNDED PRECEDING))::BIGINT AS tp, sum(is_anomalous::INT) OVER () AS pos FROM parts WHERE part <> 'test'
        WINDOW w AS (ORDER BY event_count DESC, window_start))
        SELECT position, window_start, score, tp, round(2.0::DOUBLE * tp / (position + pos), 6) AS f1 FROM s""",
    "rule_zscore_scores_ranked": f"WITH {_PRED} SELECT detector, variant, {_CONF}, {_RATES} FROM scored ORDER BY scored.f1 DESC, detector",
    "rule_zscore_best": f"WITH {_PRED} SELECT detector, variant, round(f1, 6) AS f1 FROM scored ORDER BY scored.f1 DESC, ordinal LIMIT 1",
    "rule_zscore_health": f"WITH {_PRED} SELECT 'ok' AS status, (SELECT count(*) FROM ev) AS events, (SELECT count(*) FROM win) AS windows, (SELECT count(*) FROM scored) AS detector_scores",
    "summary": f"""WITH {_PRED}, ranked AS (SELECT is_anomalous, row_number() OVER (ORDER BY window_start) - 1 AS position FROM win
          WHERE EXISTS (SELECT 1 FROM pred p WHERE p.window_start = win.window_start))
        SELECT count(*) AS windows, count(*) FILTER (WHERE is_anomalous) AS anomalous_windows, min(window_start) AS first_window, max(window_start) AS last_window,
          sum(event_count)::BIGINT AS events, (SELECT min(window_start) FROM pred) AS first_scored, (SELECT max(window_start) FROM pred) AS last_scored,
          (SELECT count(DISTINCT window_start) FROM pred) AS scored_windows, (SELECT min(position) FROM ranked WHERE is_anomalous) AS first_anomalous_index FROM win""",
    "first_anomalous_index": f"""WITH {_PRED}, ranked AS (SELECT is_anomalous, row_number() OVER (ORDER BY window_start) - 1 AS position FROM win
          WHERE EXISTS (SELECT 1 FROM pred p WHERE p.window_start = win.window_start)) SELECT min(position) AS first_anomalous_index FROM ranked WHERE is_anomalous""",
    "rule_zscore_flags": f"WITH {_PRED} SELECT window_start, flags FROM flags",
    "windows_page": f"""WITH {_PRED} SELECT w.window_start, event_count, distinct_nodes, distinct_templates, round(error_rate, 6) AS error_rate, alert_count, is_anomalous,
        coalesce(f.flags, '{{}}') AS detector_flags FROM win w LEFT JOIN flags f ON w.window_start = f.window_start WHERE f.flags IS NOT NULL ORDER BY w.window_start LIMIT 100 OFFSET 20""",
    "window_top_templates": f"""WITH {_windows()}, fullest AS (SELECT window_start FROM tc GROUP BY 1 ORDER BY sum(event_count) DESC, window_start LIMIT 1),
        cat AS (SELECT template_id, min(template) AS template FROM ev GROUP BY 1)
        SELECT tc.template_id, template, event_count FROM tc JOIN cat ON tc.template_id = cat.template_id WHERE window_start = (SELECT window_start FROM fullest)
        ORDER BY event_count DESC, template LIMIT 20""",
    "idempotent_append": f"""WITH {_DAMAGED}, c AS (SELECT count(*) AS n, count(*) FILTER (WHERE reason IS NULL) AS good, count(*) FILTER (WHERE line_no <= 2000) AS n1,
          count(*) FILTER (WHERE reason IS NULL AND line_no <= 2000) AS good1 FROM marked)
        SELECT 1::BIGINT AS run_id, n1 AS lines_read, good1 AS rows_inserted, 0::BIGINT AS rows_duplicate, n1 - good1 AS lines_quarantined FROM c
        UNION ALL SELECT 2, n, good - good1, good1, n - good FROM c""",
    "loaded_events": f"WITH {_DAMAGED} SELECT line_no, epoch, severity, template_id, sha256(message) AS line_sha256 FROM marked WHERE reason IS NULL",
    "replaced_windows": f"""WITH {EVENTS}, f AS (SELECT 3600 AS window_seconds, epoch // 3600 AS w, template_id FROM ev UNION ALL SELECT 300, epoch // 300, template_id FROM ev)
        SELECT 'features' AS tab, window_seconds, count(DISTINCT w) AS n, count(*) AS events FROM f GROUP BY 2
        UNION ALL SELECT 'templates', window_seconds, count(DISTINCT (w, template_id)), count(*) FROM f GROUP BY 2""",
    "constraint_violations": f"""WITH {EVENTS}, c AS (
          SELECT sum(CASE WHEN line_no % 13 = 0 THEN 2 ELSE 1 END * (line_no % 11 = 0)::INT) AS nodes, count(*) FILTER (WHERE line_no % 13 = 0) AS twice,
                 sum(CASE WHEN line_no % 13 = 0 THEN 2 ELSE 1 END * (line_no % 17 = 0)::INT) AS unknown, sum(CASE WHEN line_no % 13 = 0 THEN 2 ELSE 1 END * (line_no % 19 = 0)::INT) AS outside FROM ev
        ), rules("table", rule, n) AS (
          SELECT 'log_events', unnest(['source_file', 'line_no', 'event_time', 'epoch', 'event_type', 'component', 'severity', 'label', 'is_alert', 'template_id', 'line_sha256', 'message']) || '_not_null', 0
          UNION ALL SELECT 'event_templates', unnest(['template_id_not_null', 'template_not_null', 'first_seen_not_null', 'key_is_unique']), 0
          UNION ALL SELECT 'log_events', unnest(['line_no_from_1', 'known_severity', 'digest_of_64']), 0
          UNION ALL SELECT 'log_events', 'node_not_null', nodes FROM c UNION ALL SELECT 'log_events', 'epoch_in_span', outside FROM c
          UNION ALL SELECT 'log_events', 'time_is_epoch', outside FROM c UNION ALL SELECT 'log_events', 'key_is_unique', twice FROM c
          UNION ALL SELECT 'log_events', 'template_id_in_event_templates', unknown FROM c)
        SELECT "table", rule, n::BIGINT AS violations FROM rules""",
    "refreshed_days": f"WITH {_windows()} SELECT {_W_COLS}, strftime(make_timestamp(window_start * 1000000), '%Y-%m-%d') AS day, 1::INT AS refreshed FROM win",
    "text_lines": f"WITH {EVENTS} SELECT line_no, epoch, node, severity, message, is_alert FROM ev",
    "text_load_windows": f"WITH {_windows(where='line_no % 10 = 0')} SELECT {_W_COLS} FROM win",
    "stream_delays": f"WITH {_windows()} SELECT count(*) AS windows, count(*) AS delayed, 0::BIGINT AS ahead FROM win",
    "stream_native_windows": _STREAM,
    "stream_exact_windows": _STREAM,
    "stream_batch_parity": f"WITH {_windows()} SELECT count(*) AS compared, 0::BIGINT AS missing, 0::BIGINT AS unexpected, 0::BIGINT AS different FROM win",
    "late_side_output": f"WITH {EVENTS} SELECT epoch // 3600 * 3600 AS window_start, count(*) AS late_events FROM ev WHERE line_no <= (SELECT max(line_no) // 2 FROM ev) GROUP BY 1",
    "stream_partition_clocks": f"""WITH {_CLOCKS} SELECT counted.* FROM counted JOIN clock USING ("partition") WHERE window_start + 3600 <= latest""",
    "stream_open_windows": f"""WITH {_CLOCKS}, through AS (SELECT "partition", coalesce(max(window_start + 3600) FILTER (WHERE window_start + 3600 <= latest), 0) AS closed_through
          FROM counted JOIN clock USING ("partition") GROUP BY 1)
        SELECT "partition", latest, watermark, closed_through, o.window_start, o.event_count, o.distinct_nodes, o.distinct_templates
        FROM clock JOIN through USING ("partition") LEFT JOIN (SELECT c.* FROM counted c JOIN clock k USING ("partition") WHERE window_start + 3600 > latest AND event_count > 0) o USING ("partition")""",
    "rolled_up_windows": f"""WITH {_windows()} SELECT window_start, event_count, {", ".join(f"{s.lower()}_count" for s in SEVERITIES)}, error_rate, alert_count, is_anomalous,
        true AS nodes_near, true AS templates_near FROM win""",
    "member_totals": f"""WITH {EVENTS}, m AS (SELECT node::BIGINT % 3 AS member, count(*) AS records, count(*) FILTER (WHERE is_alert) AS alerts, min(epoch) AS first, max(epoch) AS last
          FROM ev GROUP BY 1) SELECT count(*) AS members, sum(records)::BIGINT AS records, sum(alerts)::BIGINT AS alerts, max(last) - min(first) AS span,
          median(records)::DOUBLE AS median_records FROM m""",
    "scored_documents": f"WITH {_DOCS} SELECT * FROM docs",
    "flagged_top10": f"WITH {_DOCS} SELECT window_id, event_count, zscore, severity_flag, zscore_flag FROM docs WHERE flagged ORDER BY docs.zscore DESC, window_id LIMIT 10",
}
