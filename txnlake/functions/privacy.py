"""Phone privacy as Column expressions (no Python per row).

All four helpers compile to built-in Spark SQL functions, so they stay inside
whole-stage codegen and run on every executor. The HMAC token is written as
the RFC 2104 composition of two ``sha2`` calls over binary values.

Note: the padded key bytes are literals of the plan and therefore appear in
``explain`` output and event logs. Keep those private, or set
``spark.sql.redaction.string.regex`` on the cluster.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values (must equal the source system's behaviour).
COUNTRY_PREFIX = "+221"
KNOWN_PREFIXES = ("77", "78", "76", "70", "75")
MASK_FILL = "XXXXX"
TOKEN_LENGTH = 16

_BLOCK = 64  # SHA-256 block size in bytes


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _canonical_sql(c: str) -> str:
    return (
        f"regexp_replace(replace(replace({c}, '{COUNTRY_PREFIX}', ''), ' ', ''), "
        r"'^\\s+|\\s+$', '')"
    )


def phone_canonical(c: str | Column) -> Column:
    """Drop the country prefix and every space, then strip outer whitespace."""
    if isinstance(c, str):
        return F.expr(_canonical_sql(f"`{c}`"))
    cleaned = F.replace(F.replace(c, F.lit(COUNTRY_PREFIX), F.lit("")), F.lit(" "), F.lit(""))
    return F.regexp_replace(cleaned, r"^\s+|\s+$", "")


def phone_known_prefix(c: str | Column) -> Column:
    """True when the canonical phone starts with a known operator prefix."""
    return F.substring(phone_canonical(c), 1, 2).isin(*KNOWN_PREFIXES)


def _hmac_pads(secret: str | bytes) -> tuple[bytes, bytes]:
    key = secret.encode("utf-8") if isinstance(secret, str) else bytes(secret)
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\x00")
    inner = bytes(b ^ 0x36 for b in key)
    outer = bytes(b ^ 0x5C for b in key)
    return inner, outer


def tokenize(c: str | Column, secret: str | bytes) -> Column:
    """First 16 hex chars of HMAC-SHA256(secret, value); NULL stays NULL."""
    inner, outer = _hmac_pads(secret)
    msg = F.encode(_col(c), "UTF-8")
    inner_hash = F.unhex(F.sha2(F.concat(F.lit(bytearray(inner)), msg), 256))
    outer_hash = F.sha2(F.concat(F.lit(bytearray(outer)), inner_hash), 256)
    return F.substring(outer_hash, 1, TOKEN_LENGTH)


def mask(c: str | Column) -> Column:
    """Display mask: first two + XXXXX + last three when 9+ chars, else XXXXX."""
    clean = phone_canonical(c)
    masked = F.when(
        F.length(clean) >= 9,
        F.concat(F.substring(clean, 1, 2), F.lit(MASK_FILL), F.right(clean, F.lit(3))),
    ).otherwise(F.lit(MASK_FILL))
    return F.when(_col(c).isNull(), F.lit(None).cast("string")).otherwise(masked)


def canonical_phones(
    df: DataFrame, cols: Iterable[str] = ("sender_phone", "recipient_phone")
) -> DataFrame:
    """Canonicalise the phone columns in place."""
    return df.withColumns({c: phone_canonical(c) for c in cols})


def tokenize_phones(
    df: DataFrame,
    secret: str | bytes,
    cols: Iterable[str] = ("sender_phone", "recipient_phone"),
) -> DataFrame:
    """Replace canonical phones by their tokens (pseudonymisation at the edge)."""
    return df.withColumns({c: tokenize(phone_canonical(c), secret) for c in cols})


def mask_phones(
    df: DataFrame, cols: Iterable[str] = ("sender_phone", "recipient_phone")
) -> DataFrame:
    """Add ``<col>_masked`` display columns."""
    return df.withColumns({f"{c}_masked": mask(c) for c in cols})
