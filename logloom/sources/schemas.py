"""Table schemas and the check that a table has its columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Columns and types of the tables.
LOG_EVENTS = (
    "source_file string, line_no bigint, event_time timestamp, epoch bigint, node string, event_type string, component string, "
    "severity string, label string, is_alert boolean, template_id string, line_sha256 string, message string, template string"
)
QUARANTINED = "source_file string, line_no bigint, reason string, raw_line string"
TEMPLATES = "template_id string, template string, first_seen timestamp"
RUNS = (
    "run_id bigint, source_file string, window_seconds int, started_at timestamp, finished_at timestamp, "
    "lines_read bigint, rows_inserted bigint, rows_duplicate bigint, lines_quarantined bigint"
)
WINDOW_COUNTS = (
    "event_count", "distinct_nodes", "distinct_templates", "info_count", "warning_count",
    "error_count", "severe_count", "fatal_count", "failure_count", "error_rate",
)
WINDOWS = ("window_seconds", "window_start", *WINDOW_COUNTS, "alert_count", "is_anomalous")
DOCUMENT = ("window_id", "window_start", "window_end", "window_seconds", *WINDOW_COUNTS, "alert_count", "is_anomalous", "late_events", "zscore", "severity_flag", "zscore_flag", "flagged")

_COUNTED = ", ".join(f"{c} {'double' if c == 'error_rate' else 'bigint'}" for c in WINDOW_COUNTS)
WINDOW_FEATURES = f"window_start bigint, {_COUNTED}, alert_count bigint, is_anomalous boolean, window_seconds int, day string"
TEMPLATE_COUNTS = "window_start bigint, template_id string, event_count bigint, window_seconds int, day string"
REFRESHES = "window_seconds int, through_run bigint, days int, refreshed_at timestamp"
SCORES = (
    "ordinal int, detector string, variant string, true_positives bigint, false_positives bigint, false_negatives bigint, "
    "true_negatives bigint, precision double, recall double, f1 double, window_seconds int"
)
PREDICTIONS = "window_start bigint, detector string, variant string, predicted boolean, window_seconds int"

DELAYS = ("produced_at", "indexed_at", "ingest_lag_ms")


#: Types of the index's rows, by name.
DOCUMENT_TYPES = {
    **dict.fromkeys(("window_id", "window_start", "window_end"), "string"),
    "window_seconds": "int",
    **{c: "double" if c == "error_rate" else "bigint" for c in WINDOW_COUNTS},
    **dict.fromkeys(("alert_count", "late_events"), "bigint"),
    "zscore": "double",
    **dict.fromkeys(("is_anomalous", "severity_flag", "zscore_flag", "flagged"), "boolean"),
    **dict.fromkeys(("produced_at", "indexed_at"), "timestamp"),
    "ingest_lag_ms": "bigint",
}


def require(df: DataFrame, columns: tuple[str, ...] | dict[str, str], exact: bool = False) -> DataFrame:
    """df, if it has the columns (and no others, if exact), of the types that a dict gives."""
    if isinstance(columns, dict):
        found = dict(df.dtypes)
        if wrong := {c: f"{found[c]}, not {t}" for c, t in columns.items() if c in found and found[c] != t}:
            raise ValueError(f"columns of other types: {wrong}")
    missing = [c for c in columns if c not in df.columns]
    extra = [c for c in df.columns if c not in columns] if exact else []
    if missing or extra:
        raise ValueError(f"missing columns {missing}, unknown columns {extra}")
    return df


#: What holds of each table's rows: columns that are never null, the key, conditions, and
#: columns that must occur in another table's.
NOT_NULL = {
    "ingest_runs": ("run_id", "started_at", "lines_read", "rows_inserted", "rows_duplicate", "lines_quarantined"),
    "event_templates": ("template_id", "template", "first_seen"),
    "log_events": (
        "source_file", "line_no", "event_time", "epoch", "node", "event_type", "component", "severity", "label", "is_alert",
        "template_id", "line_sha256", "message",
    ),
    "quarantined_lines": ("source_file", "line_no", "reason", "raw_line"),
    "window_features": ("window_seconds", "window_start", *WINDOW_COUNTS, "alert_count", "is_anomalous"),
    "window_template_counts": ("window_seconds", "window_start", "template_id", "event_count"),
    "detector_scores": ("window_seconds", "detector", "variant", "precision", "recall", "f1", "true_positives", "false_positives", "false_negatives", "true_negatives"),
    "window_predictions": ("window_seconds", "window_start", "detector", "variant", "predicted"),
}
KEYS = {
    "ingest_runs": ("run_id",), "event_templates": ("template_id",), "log_events": ("source_file", "line_no"), "quarantined_lines": ("source_file", "line_no"),
    "window_features": ("window_seconds", "window_start"), "window_template_counts": ("window_seconds", "window_start", "template_id"),
    "detector_scores": ("window_seconds", "detector", "variant"), "window_predictions": ("window_seconds", "window_start", "detector", "variant"),
}
CONDITIONS = {
    "ingest_runs": {"counts_add_up": "finished_at IS NULL OR lines_read = rows_inserted + rows_duplicate + lines_quarantined"},
    "log_events": {
        "line_no_from_1": "line_no >= 1",
        "epoch_in_span": "epoch BETWEEN 946684800 AND 2524608000",
        "time_is_epoch": "unix_timestamp(event_time) = epoch",
        "known_severity": "severity IN ('INFO', 'WARNING', 'ERROR', 'SEVERE', 'FATAL', 'FAILURE')",
        "digest_of_64": "length(line_sha256) = 64",
    },
    "window_features": {
        "on_the_grid": "window_start % window_seconds = 0",
        "some_event": "event_count >= 1",
        "severities_add_up": "event_count = info_count + warning_count + error_count + severe_count + fatal_count + failure_count",
        "rate_is_a_share": "error_rate BETWEEN 0 AND 1",
        "anomalous_by_alerts": "is_anomalous = (alert_count > 0)",
    },
    "window_template_counts": {"some_event": "event_count >= 1"},
    "detector_scores": {"shares": "precision BETWEEN 0 AND 1 AND recall BETWEEN 0 AND 1 AND f1 BETWEEN 0 AND 1"},
}
REFERENCES = {
    "log_events": (("template_id", "event_templates", "template_id"),),
    "window_template_counts": (("template_id", "event_templates", "template_id"),),
    "window_predictions": (("detector", "detector_scores", "detector"),),
}
