"""Scans and sinks: typed / lenient CSV, multi-file scans with provenance,
stage-directory scans, landed JSON pages, Parquet/CSV sinks, run summaries."""

from panelforge.sources.files import (  # noqa: F401
    read_typed_csv, read_lenient_csv, read_with_provenance, list_datasets, scan_stage_dir,
    file_duplicates, dataset_fingerprint, fingerprint_parts, merge_fingerprints,
)
from panelforge.sources.json_pages import flatten_pages  # noqa: F401
from panelforge.sources.sinks import write_table, write_run_summary, sql_over  # noqa: F401
