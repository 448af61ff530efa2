from strata.sources.databases import (
    ConnectorMissingError,
    MissingCredentialsError,
    check_credentials,
    documents_to_df,
    documents_uri,
    jdbc_spec,
    read_database,
    read_collection,
    read_documents,
    read_jdbc,
)
from strata.sources.files import read_csv, read_sql, read_table, read_txt, write_text
from strata.sources.xlsx import WorkbookError, read_xlsx

__all__ = [
    "WorkbookError",
    "ConnectorMissingError",
    "MissingCredentialsError",
    "check_credentials",
    "documents_to_df",
    "documents_uri",
    "jdbc_spec",
    "read_collection",
    "read_csv",
    "read_database",
    "read_documents",
    "read_jdbc",
    "read_sql",
    "read_table",
    "read_txt",
    "read_xlsx",
    "write_text",
]
