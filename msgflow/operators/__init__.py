from .bounded_requests import bounded_request_batches
from .clustering import clustered
from .compaction import compact
from .inference import (
    DEFAULT_SCHEMA,
    batch_schema,
    merge_schemas,
    recursive_schema,
    sample_schema,
    schema_of_sample,
)
from .offsets import offset_account, offset_gaps
from .policies import (
    FALLBACK_EVENT,
    PRODUCT,
    USER,
    array_rows,
    bad_rows,
    captured_rows,
    converted_rows,
    fixed_schema_rows,
    good_rows,
    inferred_rows,
    lenient_records,
    parse_with_capture,
    rejected_rows,
    split_counts,
    strict_records,
)
from .profile import describe_topic, end_offsets, topic_list, topic_profile, topic_totals
from .requests import item_json_bytes, request_batches, request_bodies, room_for_items, score_requests
from .samples import merged_sample, message_sample
from .sketches import merged_sketches, sketched_figures, topic_sketches
from .summaries import merged_summaries, schema_conflicts, schema_summary, summarized_schema

__all__ = [
    "DEFAULT_SCHEMA",
    "FALLBACK_EVENT",
    "PRODUCT",
    "USER",
    "array_rows",
    "bad_rows",
    "batch_schema",
    "bounded_request_batches",
    "captured_rows",
    "clustered",
    "compact",
    "converted_rows",
    "describe_topic",
    "end_offsets",
    "fixed_schema_rows",
    "good_rows",
    "inferred_rows",
    "item_json_bytes",
    "lenient_records",
    "merge_schemas",
    "merged_sample",
    "merged_sketches",
    "merged_summaries",
    "message_sample",
    "offset_account",
    "offset_gaps",
    "parse_with_capture",
    "recursive_schema",
    "rejected_rows",
    "request_batches",
    "request_bodies",
    "room_for_items",
    "sample_schema",
    "schema_conflicts",
    "schema_of_sample",
    "schema_summary",
    "score_requests",
    "sketched_figures",
    "split_counts",
    "strict_records",
    "summarized_schema",
    "topic_list",
    "topic_profile",
    "topic_sketches",
    "topic_totals",
]
