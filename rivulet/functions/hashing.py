"""Hash helpers: surrogate keys and order-free hash totals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*cols: Column | str) -> Column:
    """SHA-256 over the key columns joined with ``~``; a NULL part is a NUL
    character, so that ("a", NULL) and (NULL, "a") are different keys."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("\x00")) for c in cols]
    return F.sha2(F.concat_ws("~", *parts), 256)


def md5_prefix_int(*cols: Column | str) -> Column:
    """First 8 hex digits of md5(concat_ws('~', cols)) as a non-negative long.

    Summed over a table this is an order-free fingerprint used by reconciliation.
    """
    h = F.md5(F.concat_ws("~", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long")
