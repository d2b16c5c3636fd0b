"""Reports as JSON text."""

from pyspark.sql import Column, DataFrame, functions as F

from slugline.plans.params import MAX_SPAN_DAYS

ROWS = "rows"
# The longest report that is one document: a day for each day of the longest range.
MAX_ROWS = MAX_SPAN_DAYS + 1


def _row_json(report: DataFrame) -> Column:
    return F.to_json(F.struct(*report.columns), {"ignoreNullFields": "false"})


def json_rows(report: DataFrame) -> DataFrame:
    """One JSON object per row, NULL fields written out; stays distributed."""
    return report.select(_row_json(report).alias("json"))


def json_document(report: DataFrame) -> DataFrame:
    """One row holding `{"rows": [...]}` in the report's own order.

    This gathers the report in one place, so it is for reports whose parameters bound their
    length: day series (a range has at most 3,661 days) and the most updated contents (at
    most 1,000 rows). A longer report fails: no more than one row beyond the bound is gathered.
    Use `json_rows` for reports with a row per API.
    """
    placed = report.limit(MAX_ROWS + 1).select(
        F.struct(F.monotonically_increasing_id().alias("place"), _row_json(report).alias("json")).alias("entry")
    )
    entries = F.array_sort(F.collect_list("entry"))
    too_long = F.raise_error(F.lit(f"a document has at most {MAX_ROWS} rows"))
    entries = F.when(F.size(entries) > MAX_ROWS, too_long).otherwise(entries)
    items = F.array_join(F.transform(entries, lambda entry: entry["json"]), ",")
    return placed.agg(F.concat(F.lit(f'{{"{ROWS}":['), items, F.lit("]}")).alias("json"))
