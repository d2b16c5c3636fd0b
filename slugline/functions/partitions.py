"""Values as they may appear in a partition path."""

from pyspark.sql import Column, functions as F

# Characters replaced in a path segment, and the name for an absent one.
UNSAFE = "/=?#[] "
REPLACEMENT = "_"
ABSENT = "unknown"


def escape_segment(value: Column) -> Column:
    return F.translate(value, UNSAFE, REPLACEMENT * len(UNSAFE))


def partition_value(value: Column) -> Column:
    """Escaped text of a partition column; NULL becomes `unknown`."""
    return escape_segment(F.coalesce(value, F.lit(ABSENT)))


def restored_value(value: Column) -> Column:
    """A partition value as read back: Spark stores the empty string as its NULL directory,
    and `partition_value` never yields NULL, so NULL can only mean the empty string."""
    return F.coalesce(value, F.lit(""))
