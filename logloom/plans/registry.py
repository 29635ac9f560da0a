"""The registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logloom.plans import queries as q
from logloom.plans.oracle import ORACLE_SQL  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "split_parts": q.split_parts_query,
} | {
    f.__name__: f
    for f in (
        q.parse_roundtrip, q.quarantine_reasons, q.quarantined_lines, q.prefix_limit, q.mask_templates, q.template_catalog,
        q.scalar_functions, q.event_time_span, q.orphan_events, q.window_features_60, q.window_features_3600,
        q.window_template_counts, q.last_line_per_window, q.daily_histogram, q.windows_at_least, q.duplicate_keys,
        q.lag_percentiles, q.fit_validation_parts, q.top_templates_train, q.feature_matrix, q.severity_free_matrix,
        q.severity_rule_scores, q.zscore_stats, q.zscore_scores, q.zscore_threshold, q.zscore_eval, q.threshold_sweep,
        q.detector_scores_ranked, q.best_detector, q.logistic_eval, q.gbt_eval, q.iforest_eval, q.health,
        q.rule_zscore_scores_ranked, q.rule_zscore_best, q.rule_zscore_health, q.rule_zscore_flags, q.full_feature_matrix, q.all_detectors_windows_page, q.summary,
        q.first_anomalous_index, q.detector_flags, q.windows_page, q.window_top_templates, q.idempotent_append,
        q.loaded_events, q.replaced_windows, q.refreshed_days, q.constraint_violations, q.text_lines, q.text_load_windows, q.stream_delays, q.stream_native_windows, q.stream_exact_windows, q.stream_batch_parity,
        q.late_side_output, q.stream_partition_clocks, q.stream_open_windows, q.rolled_up_windows, q.member_totals, q.scored_documents, q.flagged_top10,
    )
}
