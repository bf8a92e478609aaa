"""Reading, writing, staging and schemas."""

from shopledger.sources.audit import (
    AUDIT_SCHEMA,
    merge_audit_log,
    read_audit_log,
    write_audit_log,
)
from shopledger.sources.quarantine import Sifted, sift
from shopledger.sources.reading import (
    catalog_source,
    directory_source,
    read_footers,
    read_parquet,
    read_path,
    read_table,
    rows,
)
from shopledger.sources.schemas import SCHEMAS, column_types, conform
from shopledger.sources.staging import drop_staged, stage, staging_folder
from shopledger.sources.versions import current_folder, publish
from shopledger.sources.writing import publish_table, write_dataset, write_datasets

__all__ = [
    "AUDIT_SCHEMA",
    "SCHEMAS",
    "Sifted",
    "catalog_source",
    "column_types",
    "conform",
    "current_folder",
    "directory_source",
    "drop_staged",
    "merge_audit_log",
    "publish",
    "publish_table",
    "read_audit_log",
    "read_footers",
    "read_parquet",
    "read_path",
    "read_table",
    "rows",
    "sift",
    "stage",
    "staging_folder",
    "write_audit_log",
    "write_dataset",
    "write_datasets",
]
