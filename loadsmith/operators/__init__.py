from loadsmith.operators.checks import (
    DataCheckError, assert_not_null, assert_relationships, assert_same_schema,
    assert_unique, not_null_violations, relationship_violations, unique_violations,
)
from loadsmith.operators.lookup import change_tag, existence_flag, lookup_join
from loadsmith.operators.upsert import latest_per_key, upsert_frame

__all__ = [
    "DataCheckError", "assert_not_null", "assert_relationships", "assert_same_schema",
    "assert_unique", "not_null_violations", "relationship_violations", "unique_violations",
    "change_tag", "existence_flag", "lookup_join", "latest_per_key", "upsert_frame",
]
