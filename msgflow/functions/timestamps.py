"""ISO-8601 text to UTC timestamps, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted forms are a date, or a date and a time with an optional zone.
ISO_FORM = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:\d{2})?)?$"
ISO_ZONE = r"(Z|:.*[+-]\d{2}:\d{2})$"


def as_utc_timestamp(text: Column) -> Column:
    """Timestamp of an ISO text; a text without a zone is taken as UTC. NULL for any other text."""
    # Spark reads a zone only after seconds, so both are filled in where the text leaves them out.
    timed = F.when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00"))).otherwise(text)
    rest = F.substr(timed, F.lit(17))
    seconds = F.when(rest.startswith(":"), rest).otherwise(F.concat(F.lit(":00"), rest))
    zone = F.when(timed.rlike(ISO_ZONE), F.lit("")).otherwise(F.lit("Z"))
    filled = F.concat(timed.substr(1, 16), seconds, zone)
    # The most frequent form is complete as it is.
    complete = F.when(text.endswith("Z") & (text.substr(17, 1) == ":"), text).otherwise(filled)
    return F.when(text.rlike(ISO_FORM), complete).try_cast("timestamp")


def is_iso_timestamp(text: Column) -> Column:
    return as_utc_timestamp(text).isNotNull()


def utc_text(timestamp: Column) -> Column:
    """ISO text of a timestamp in UTC, as in ``2024-03-22T09:05:00Z``, whatever the session's zone."""
    seconds = (F.unix_micros(timestamp) / F.lit(1_000_000).cast("decimal(8,0)")).cast("decimal(18,6)")
    local = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.concat(F.translate(local.cast("string"), " ", "T"), F.lit("Z"))
