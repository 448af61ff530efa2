from strata.functions.columns import (
    DATE_FORMATS,
    as_text,
    cast_failures,
    clean_columns,
    conform,
    count_status,
    day_stamp,
    file_stem,
    fill_missing_date,
    local_time,
    lower_or_unknown,
    ntz_literal,
    parse_date,
    partition_date,
    quote,
    rename_columns,
    sha256_hex,
    stamp_ingestion,
    strip_chars,
    surrogate_key,
    to_float,
    to_money,
)

__all__ = [
    "DATE_FORMATS",
    "as_text",
    "cast_failures",
    "clean_columns",
    "conform",
    "count_status",
    "day_stamp",
    "file_stem",
    "fill_missing_date",
    "local_time",
    "lower_or_unknown",
    "ntz_literal",
    "parse_date",
    "partition_date",
    "quote",
    "rename_columns",
    "sha256_hex",
    "stamp_ingestion",
    "strip_chars",
    "surrogate_key",
    "to_float",
    "to_money",
]
