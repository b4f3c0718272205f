"""PII masks and pseudonyms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask_prefix(c: Column, keep: int = 2) -> Column:
    """Keep the first ``keep`` characters and append ``***``; NULL stays NULL."""
    return F.concat(F.substring(c, 1, keep), F.lit("***"))


def mask_email(c: Column) -> Column:
    """``jane@example.com`` -> ``j***@example.com`` (first character and domain kept)."""
    return F.regexp_replace(c, r"^(.)[^@]*", "$1***")


def mask_phone(c: Column) -> Column:
    """``+50212345234`` -> ``+502*****234`` (first four and last three kept)."""
    return F.concat(F.substring(c, 1, 4), F.lit("*****"), F.right(c, F.lit(3)))


def pseudonym(c: Column, salt: str) -> Column:
    """Stable token: SHA-256 of salt || value (hex)."""
    return F.sha2(F.concat(F.lit(salt), c.cast("string")), 256)


def column_policy_mask(c: Column, rule: str, salt: str = "") -> Column:
    """Apply one masking rule by name: ``clear``, ``prefix``, ``email``, ``phone``, ``token``, ``drop``."""
    if rule == "clear":
        return c
    if rule == "prefix":
        return mask_prefix(c)
    if rule == "email":
        return mask_email(c)
    if rule == "phone":
        return mask_phone(c)
    if rule == "token":
        return pseudonym(c, salt)
    if rule == "drop":
        return F.lit(None).cast("string")
    raise ValueError(f"unknown masking rule {rule!r}")
