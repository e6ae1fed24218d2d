from .jobs import (
    literal_users,
    per_batch_schema_stream,
    product_stream,
    product_stream_by_value,
    recursive_schema_stream,
    sampled_schema_stream,
    split_stream,
    validated_users_stream,
)

__all__ = [
    "literal_users",
    "per_batch_schema_stream",
    "product_stream",
    "product_stream_by_value",
    "recursive_schema_stream",
    "sampled_schema_stream",
    "split_stream",
    "validated_users_stream",
]
