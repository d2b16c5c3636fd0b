"""The event table's schema and the vocabulary its rows are written in."""

from pyspark.sql import types as T

EVENT_FIELDS = (
    T.StructField("received_at", T.TimestampType(), False),
    T.StructField("service", T.StringType()),
    T.StructField("api", T.StringType()),
    T.StructField("content_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_kind", T.StringType()),
    T.StructField("old_status", T.StringType()),
    T.StructField("new_status", T.StringType()),
    T.StructField("old_updated_at", T.TimestampType()),
    T.StructField("new_updated_at", T.TimestampType()),
    T.StructField("draft_created_at", T.TimestampType()),
    T.StructField("content_created_at", T.TimestampType()),
    T.StructField("content_published_at", T.TimestampType()),
    T.StructField("raw_payload", T.StringType(), False),
)
PARTITION_COLUMNS = ("service", "api", "dt")
EVENT_SCHEMA = T.StructType([*EVENT_FIELDS, T.StructField("dt", T.DateType())])
EVENT_COLUMNS = tuple(EVENT_SCHEMA.names)
REQUIRED_COLUMNS = tuple(f.name for f in EVENT_FIELDS if not f.nullable)

RAW_SCHEMA = T.StructType(
    [
        T.StructField("body", T.BinaryType()),
        T.StructField("signature", T.StringType()),
        T.StructField("received_at", T.TimestampType()),
    ]
)

QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("received_at", T.TimestampType(), False),
        T.StructField("dt", T.DateType()),
        T.StructField("signature", T.StringType()),
        T.StructField("body", T.BinaryType()),
        T.StructField("reject_reason", T.StringType()),
        T.StructField("reject_class", T.IntegerType()),
    ]
)

# Stored statuses, event types and event kinds.
DRAFT, PUBLISH, CLOSED = "DRAFT", "PUBLISH", "CLOSED"
NEW, EDIT, DELETE = "new", "edit", "delete"

EVENT_KINDS = (
    "INITIAL_DRAFT",
    "SAVE_DRAFT",
    "PUBLISH_FROM_DRAFT",
    "INITIAL_PUBLISH",
    "UPDATE_PUBLISHED",
    "ADD_DRAFT_TO_PUBLISHED",
    "DISCARD_DRAFT_ON_PUBLISHED",
    "UNPUBLISH_TO_DRAFT",
    "UNPUBLISH_TO_CLOSED",
    "REOPEN_TO_DRAFT",
    "REPUBLISH_FROM_CLOSED",
    "DELETE_DRAFT",
    "DELETE_PUBLISHED",
    "DELETE_CLOSED",
)

# Which kinds each report counts.
PUBLISH_ACTIONS = ("PUBLISH_FROM_DRAFT", "INITIAL_PUBLISH", "REPUBLISH_FROM_CLOSED")
PUBLISHED_STATE = (*PUBLISH_ACTIONS, "UPDATE_PUBLISHED")
STATE_ARRIVALS = (
    *PUBLISHED_STATE,
    "INITIAL_DRAFT",
    "SAVE_DRAFT",
    "UNPUBLISH_TO_DRAFT",
    "UNPUBLISH_TO_CLOSED",
    "REOPEN_TO_DRAFT",
)

# The four operation categories of the activity views.
CATEGORIES = {
    "draft_activity": (
        "INITIAL_DRAFT",
        "SAVE_DRAFT",
        "ADD_DRAFT_TO_PUBLISHED",
        "DISCARD_DRAFT_ON_PUBLISHED",
    ),
    "publish_activity": (
        "PUBLISH_FROM_DRAFT",
        "INITIAL_PUBLISH",
        "UPDATE_PUBLISHED",
        "REPUBLISH_FROM_CLOSED",
    ),
    "unpublish_activity": ("UNPUBLISH_TO_DRAFT", "UNPUBLISH_TO_CLOSED", "REOPEN_TO_DRAFT"),
    "delete_activity": ("DELETE_DRAFT", "DELETE_PUBLISHED", "DELETE_CLOSED"),
}


def count_column(kind: str) -> str:
    """Name of the report column that counts `kind`."""
    return f"{kind.lower()}_count"
