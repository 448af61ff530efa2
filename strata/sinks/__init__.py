from strata.sinks.bucketed import find_keys, keyed_table, load_bucketed, rebucket, remove_keys
from strata.sinks.compaction import compact_small, file_sizes, small_partitions
from strata.sinks.ledger import land, mark_taken, rows_of, unseen
from strata.sinks.located import load_located
from strata.sinks.maintained import refresh_aggregate
from strata.sinks.quarantine import load_mended, load_typed, open_rows
from strata.sinks.tables import (
    LoadResult,
    append_table,
    compact_partitions,
    create_table,
    evolve_schema,
    last_load,
    load_history,
    load_partitioned,
    load_table,
    merge_into,
    staged_table,
    table_exists,
    vacuum_versions,
    widen_table,
    write_balanced,
)

__all__ = [
    "LoadResult",
    "append_table",
    "compact_partitions",
    "compact_small",
    "create_table",
    "evolve_schema",
    "file_sizes",
    "find_keys",
    "keyed_table",
    "land",
    "last_load",
    "load_bucketed",
    "load_history",
    "load_located",
    "load_mended",
    "load_partitioned",
    "load_table",
    "load_typed",
    "mark_taken",
    "merge_into",
    "open_rows",
    "rebucket",
    "refresh_aggregate",
    "remove_keys",
    "rows_of",
    "small_partitions",
    "staged_table",
    "table_exists",
    "unseen",
    "vacuum_versions",
    "widen_table",
    "write_balanced",
]
