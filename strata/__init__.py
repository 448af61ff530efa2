"""strata: layered (bronze / silver / gold) lakehouse loads on Spark.

Sources land raw tables, frames are typed, keyed and de-duplicated, upserted
into date-partitioned clean tables and aggregated tables, and every hop is
profiled and reconciled into a monitoring table. All of it is DataFrame and
SQL work on the executors.

The most used entry points are re-exported here; see the sub-packages for
the rest (``functions``, ``operators``, ``sources``, ``sinks``, ``plans``,
``streaming``).
"""

__version__ = "0.1.0"

from strata.operators.aggregate import account_summary  # noqa: E402
from strata.operators.content import reconcile_contents  # noqa: E402
from strata.operators.dedup import key_stats, latest_per_key  # noqa: E402
from strata.operators.find import count_documents, find, find_by_id, find_one  # noqa: E402
from strata.operators.merge import merge_frames  # noqa: E402
from strata.operators.profile import compare_profiles, exact_quantiles, profile  # noqa: E402
from strata.operators.quality import dq_record, dq_report, reconcile  # noqa: E402
from strata.sinks.bucketed import load_bucketed  # noqa: E402
from strata.sinks.compaction import compact_small  # noqa: E402
from strata.sinks.ledger import land  # noqa: E402
from strata.sinks.located import load_located  # noqa: E402
from strata.sinks.quarantine import load_mended, load_typed  # noqa: E402
from strata.sinks.tables import (  # noqa: E402
    compact_partitions,
    last_load,
    load_partitioned,
    load_table,
    staged_table,
    vacuum_versions,
)

__all__ = [
    "account_summary",
    "compact_partitions",
    "compact_small",
    "compare_profiles",
    "count_documents",
    "dq_record",
    "dq_report",
    "exact_quantiles",
    "find",
    "find_by_id",
    "find_one",
    "key_stats",
    "land",
    "last_load",
    "latest_per_key",
    "load_bucketed",
    "load_located",
    "load_mended",
    "load_partitioned",
    "load_table",
    "load_typed",
    "merge_frames",
    "profile",
    "reconcile",
    "reconcile_contents",
    "staged_table",
    "vacuum_versions",
]
