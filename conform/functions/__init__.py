from conform.functions.scalars import (
    clean_header,
    key_normalise,
    lenient_number,
    lenient_ts,
    lookup_key,
    null_tokens,
    wide_to_label,
)

__all__ = ["clean_header", "key_normalise", "lenient_number", "lenient_ts", "lookup_key", "null_tokens", "wide_to_label"]
