from loadsmith.sources.sinks import (
    merge_into, record_watermark, stored_watermark, table_exists, upsert_table,
    upsert_table_buckets, write_full, write_snapshot,
)
from loadsmith.sources.tables import (
    MissingInputError, incremental_scan, read_source, typed_source, watermark_bound,
)

__all__ = [
    "merge_into", "record_watermark", "stored_watermark", "table_exists", "upsert_table", "upsert_table_buckets", "write_full", "write_snapshot",
    "MissingInputError", "incremental_scan", "read_source", "typed_source", "watermark_bound",
]
