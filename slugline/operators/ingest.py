"""From raw webhooks to normalised events, with every record accounted for.

The steps are narrow: no shuffle, no UDF, each body parsed once. They work the same on a batch
and on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from slugline.functions import payload as P
from slugline.functions.days import business_day
from slugline.functions.lifecycle import event_kind
from slugline.functions.signature import hmac_sha256_hex, readable_signature, signature_matches
from slugline.functions.timestamps import rfc3339_timestamp
from slugline.schema import EVENT_COLUMNS, QUARANTINE_SCHEMA

# Why a record is turned away, in order of precedence, and the class of each reason.
MISSING_SIGNATURE = "missing_signature"
INVALID_SIGNATURE = "invalid_signature"
INVALID_BODY = "invalid_body"
PARSE_ERROR = "parse_error"
REASON_CLASS = {
    MISSING_SIGNATURE: 401,
    INVALID_SIGNATURE: 401,
    INVALID_BODY: 400,
    PARSE_ERROR: 400,
}


def _fenced(column: Column) -> Column:
    """The column unchanged, but opaque to filter push-down.

    A filter on the reject reason would otherwise be moved below every step it is computed
    from, with all of those expressions repeated inside it. A step with a non-deterministic
    part stays where it is.
    """
    return F.when(F.spark_partition_id() >= 0, column)


def verify_signature(raw: DataFrame, secret: bytes) -> DataFrame:
    """Add `signature_ok`: NULL without a readable header, else whether it carries the digest."""
    return (
        raw.withColumns(
            {
                "_digest": hmac_sha256_hex(F.col("body"), secret),
                "_header": readable_signature(F.col("signature")),
            }
        )
        .withColumn("signature_ok", signature_matches(F.col("_digest"), F.col("_header")))
        .drop("_digest", "_header")
    )


def _parse(raw: DataFrame, secret: bytes) -> DataFrame:
    text = F.col("body").cast("string")
    return (
        raw.withColumns(
            {
                "_digest": hmac_sha256_hex(F.col("body"), secret),
                "_header": readable_signature(F.col("signature")),
                "_text": F.when(F.is_valid_utf8(text), text),
            }
        )
        .withColumn("_parsed", P.parse_sealed(F.col("_text"), F.col("_digest")))
        .withColumn("_payload", P.payload_of(F.col("_parsed")))
    )


def _reject_reason() -> Column:
    well_formed = P.sealed_by(F.col("_parsed"), F.col("_digest")) & P.has_envelope_types(
        F.col("_parsed"), F.col("_payload")
    )
    well_formed &= ~P.repeats_envelope_key(F.col("_text"))
    return (
        F.when(F.col("_header").isNull(), MISSING_SIGNATURE)
        .when(~signature_matches(F.col("_digest"), F.col("_header")), INVALID_SIGNATURE)
        .when(F.col("_text").isNull(), INVALID_BODY)
        .when(~F.coalesce(well_formed, F.lit(False)), PARSE_ERROR)
    )


def _time_texts(payload: Column) -> dict[str, Column]:
    new = payload["contents"]["new"]
    return {
        "old_updated_at": P.updated_at_text(payload["contents"]["old"]),
        "new_updated_at": P.updated_at_text(new),
        "draft_created_at": new["draftValue"]["createdAt"].cast("string"),
        "content_created_at": new["publishValue"]["createdAt"].cast("string"),
        "content_published_at": new["publishValue"]["publishedAt"].cast("string"),
    }


def classify_deliveries(raw: DataFrame, secret: bytes) -> DataFrame:
    """Every raw record with the event it holds and, if it is turned away, why.

    Adds the event columns, `reject_reason` and `reject_class`. A rejected record has NULL
    event columns except `received_at` and `dt`, and keeps its `body`; an accepted one keeps
    its text in `raw_payload` instead. No record can fail the job.
    """
    accepted = F.col("reject_reason").isNull()
    payload = F.col("_payload")
    times = _time_texts(payload)
    reasons = F.create_map(*[F.lit(value) for pair in REASON_CLASS.items() for value in pair])
    judged = (
        _parse(raw, secret)
        .withColumn("reject_reason", _fenced(_reject_reason()))
        .withColumn("_payload", F.when(accepted, payload))
    )
    # One lambda over five texts instead of five copies of the expression: the generated code of
    # a step stays below the size at which the JVM stops compiling it.
    pieces = judged.withColumns(
        {
            "event_type": payload["type"].cast("string"),
            "_old_statuses": P.status_list(payload["contents"]["old"]["status"]),
            "_new_statuses": P.status_list(payload["contents"]["new"]["status"]),
            "_instants": F.transform(F.array(*times.values()), rfc3339_timestamp),
        }
    )
    event = {
        "service": payload["service"].cast("string"),
        "api": payload["api"].cast("string"),
        "content_id": payload["id"].cast("string"),
        "event_kind": event_kind(F.col("event_type"), F.col("_old_statuses"), F.col("_new_statuses")),
        "old_status": P.status_csv(F.col("_old_statuses")),
        "new_status": P.status_csv(F.col("_new_statuses")),
        **{name: F.get("_instants", F.lit(index)) for index, name in enumerate(times)},
        "raw_payload": F.when(accepted, F.col("_text")),
        "dt": business_day(F.col("received_at")),
        "body": F.when(~accepted, F.col("body")),
        "reject_class": F.try_element_at(reasons, F.col("reject_reason")),
    }
    kept = dict.fromkeys([*raw.columns, *EVENT_COLUMNS, "reject_reason", "reject_class"])
    return pieces.withColumns(event).select(*kept)


def accepted_events(deliveries: DataFrame) -> DataFrame:
    """The events of the accepted records."""
    return deliveries.where(F.col("reject_reason").isNull()).select(*EVENT_COLUMNS)


def rejected_deliveries(deliveries: DataFrame) -> DataFrame:
    """The turned-away records as they arrived, with the reason."""
    return deliveries.where(F.col("reject_reason").isNotNull()).select(*QUARANTINE_SCHEMA.names)


def normalize_events(raw: DataFrame, secret: bytes) -> DataFrame:
    """Raw webhooks to events, rejected records left out."""
    return accepted_events(classify_deliveries(raw, secret))
