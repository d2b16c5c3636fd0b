"""Content-operations analytics expressed as Spark DataFrame transformations."""
