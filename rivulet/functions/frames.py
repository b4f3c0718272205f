"""Wire framing of log payloads: ``[magic:1][schema_id:4][payload]``.

Built-ins on binary columns only (no Python UDF, so codegen is kept).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FRAME_BYTES = 5


def strip_frame(v: Column) -> Column:
    """Stream rule: payload when the value is longer than the frame, else NULL."""
    return F.when(F.length(v) > FRAME_BYTES, F.substring(v, FRAME_BYTES + 1, 1 << 30))


def strip_frame_lenient(v: Column) -> Column:
    """Notebook rule: drop the frame when at least 5 bytes are present, else keep as is."""
    return F.when(F.length(v) >= FRAME_BYTES, F.substring(v, FRAME_BYTES + 1, 1 << 30)).otherwise(v)


def frame_schema_id(v: Column) -> Column:
    """Schema id from bytes 2..5 (big endian); NULL for values shorter than the frame."""
    return F.when(F.length(v) >= FRAME_BYTES,
                  F.conv(F.hex(F.substring(v, 2, 4)), 16, 10).cast("long"))


def add_frame(payload: Column, schema_id: int) -> Column:
    """Prefix a payload with the 5-byte frame (magic 0 + schema id)."""
    header = F.unhex(F.lit("00" + format(schema_id, "08x")))
    return F.concat(header, payload)
