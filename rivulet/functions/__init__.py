"""Column-level functions (Column in, Column out), all JVM built-ins."""

from rivulet.functions.masks import (
    mask_prefix, mask_email, mask_phone, pseudonym, column_policy_mask,
)
from rivulet.functions.text import preview_chars, first_words, word_count, snake_case
from rivulet.functions.time import epoch_ms_to_ts_seconds, month_key, batch_id_for_date, try_parse_ts
from rivulet.functions.hashing import surrogate_key, md5_prefix_int
from rivulet.functions.frames import strip_frame, strip_frame_lenient, frame_schema_id, add_frame

__all__ = [
    "mask_prefix", "mask_email", "mask_phone", "pseudonym", "column_policy_mask",
    "preview_chars", "first_words", "word_count", "snake_case",
    "epoch_ms_to_ts_seconds", "month_key", "batch_id_for_date", "try_parse_ts",
    "surrogate_key", "md5_prefix_int",
    "strip_frame", "strip_frame_lenient", "frame_schema_id", "add_frame",
]
