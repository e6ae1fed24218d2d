from .coerce import as_int, as_text, int_or_default, text_or_default
from .encoding import base64_text, is_utf8, utf8_text
from .json_fields import has_fields, json_type, open_document
from .timestamps import as_utc_timestamp, is_iso_timestamp

__all__ = [
    "as_int",
    "as_text",
    "as_utc_timestamp",
    "base64_text",
    "has_fields",
    "int_or_default",
    "is_iso_timestamp",
    "is_utf8",
    "json_type",
    "open_document",
    "text_or_default",
    "utf8_text",
]
