"""Bytes to text and text to base64."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utf8_text(data: Column) -> Column:
    """Bytes as text; bytes that are not valid UTF-8 give NULL instead of a damaged text."""
    return F.try_validate_utf8(data.cast("string"))


def is_utf8(data: Column) -> Column:
    return F.is_valid_utf8(data.cast("string"))


def base64_text(data: Column) -> Column:
    """Base64 on one line (Spark's own function breaks lines after 76 characters)."""
    return F.translate(F.base64(data), "\r\n", "")
