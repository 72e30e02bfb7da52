from .columns import (
    AUDIT_TIME_COLUMNS,
    as_double,
    band_label,
    cents_to_dollars,
    day_of_week,
    iso_week,
    keyword_label,
    null_if_token,
    packed_key,
    record_hash,
    row_digest,
    row_fingerprint,
    safe_divide,
    surrogate_key,
    unpacked_key,
)

__all__ = [
    "AUDIT_TIME_COLUMNS",
    "as_double",
    "band_label",
    "cents_to_dollars",
    "day_of_week",
    "iso_week",
    "keyword_label",
    "null_if_token",
    "packed_key",
    "record_hash",
    "row_digest",
    "row_fingerprint",
    "safe_divide",
    "surrogate_key",
    "unpacked_key",
]
