from strata.operators.aggregate import account_summary, last_by
from strata.operators.dedup import is_unique_key, key_stats, latest_per_key
# ``find`` and ``profile`` are also submodule names, so those two functions
# are not re-exported here (use ``strata.find`` / ``strata.profile``).
from strata.operators.find import (
    compile_filter,
    count_documents,
    find_by_id,
    find_one,
    find_with_optional_filters,
)
from strata.operators.merge import OP, align_to, merge_frames, op_name
from strata.operators.profile import (
    approx_quantiles,
    compare_profiles,
    exact_quantiles,
    profile_boolean,
    profile_date,
    profile_numeric,
    profile_text,
    top_values,
)
from strata.operators.quality import (
    counts_frame,
    dq_record,
    dq_report,
    ensure_monitoring_table,
    reconcile,
    report_counts,
)

__all__ = [
    "OP",
    "account_summary",
    "align_to",
    "approx_quantiles",
    "compare_profiles",
    "compile_filter",
    "count_documents",
    "counts_frame",
    "dq_record",
    "dq_report",
    "ensure_monitoring_table",
    "exact_quantiles",
    "find_by_id",
    "find_one",
    "find_with_optional_filters",
    "is_unique_key",
    "key_stats",
    "last_by",
    "latest_per_key",
    "merge_frames",
    "op_name",
    "profile_boolean",
    "profile_date",
    "profile_numeric",
    "profile_text",
    "reconcile",
    "report_counts",
    "top_values",
]
