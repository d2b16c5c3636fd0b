"""HMAC-SHA256 of a binary column out of Spark's own hash functions."""

import hashlib

from pyspark.sql import Column, functions as F

# SHA-256 block size, the two pad bytes, and the prefixes a header may carry.
BLOCK_BYTES = 64
INNER_PAD, OUTER_PAD = 0x36, 0x5C
DIGEST_PREFIXES = ("sha256=", "SHA256=")


def _padded_key(secret: bytes, pad: int) -> Column:
    key = hashlib.sha256(secret).digest() if len(secret) > BLOCK_BYTES else secret
    return F.lit(bytearray(byte ^ pad for byte in key.ljust(BLOCK_BYTES, b"\0")))


def hmac_sha256_hex(body: Column, secret: bytes) -> Column:
    """Lower-case hex digest; the padded keys are literals made once on the driver."""
    inner = F.sha2(F.concat(_padded_key(secret, INNER_PAD), body), 256)
    return F.sha2(F.concat(_padded_key(secret, OUTER_PAD), F.unhex(inner)), 256)


def readable_signature(header: Column) -> Column:
    """The header if it is printable ASCII; anything else counts as no header at all."""
    return F.when(header.rlike(r"^[\t\x20-\x7e]*\z"), header)


def bare_digest(header: Column) -> Column:
    """The header without surrounding blanks and without one leading algorithm prefix."""
    trimmed = F.btrim(header, F.lit(" \t"))
    prefixed = F.substring(trimmed, 1, len(DIGEST_PREFIXES[0])).isin(*DIGEST_PREFIXES)
    return F.when(prefixed, F.substr(trimmed, F.lit(len(DIGEST_PREFIXES[0]) + 1))).otherwise(trimmed)


def signature_matches(digest_hex: Column, header: Column) -> Column:
    """Whether the header carries the digest, in hex of any case or in padded Base64."""
    claimed = bare_digest(header)
    return (F.lower(claimed) == digest_hex) | (claimed == F.base64(F.unhex(digest_hex)))
