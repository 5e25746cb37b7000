from stepmark.sources.files import in_reading_tasks, list_files, read_files, scan_files
from stepmark.sources.readers import (
    describe_columns,
    partition_folders,
    scan_image_files,
    scan_images,
    scan_jsonl,
    scan_split,
    scan_table,
)
from stepmark.sources.writers import publish_version, read_manifest, verify_written, write_sharded

__all__ = [
    "describe_columns",
    "in_reading_tasks",
    "list_files",
    "partition_folders",
    "publish_version",
    "read_files",
    "read_manifest",
    "scan_files",
    "scan_image_files",
    "scan_images",
    "scan_jsonl",
    "scan_split",
    "scan_table",
    "verify_written",
    "write_sharded",
]
