from .account import KeptTable, OffsetAccounts, profile_stream, read_account, read_kept, upserted
from .batches import (
    ConvertedBatches,
    InferredBatches,
    SplitBatches,
    compact_versions,
    dead_letter_batch,
    read_batches,
    read_versions,
    write_batch,
)
from .failures import is_data_error
from .grouping import grouped_messages
from .metrics import CounterListener
from .published import OutputLog
from .published_compaction import compact_published
from .sinks import AVAILABLE_NOW, every, parquet_stream, run_batches, run_to_end, send, with_peek
from .variants import VariantBatches, variant_field, variant_fields, variant_rows

__all__ = [
    "AVAILABLE_NOW",
    "ConvertedBatches",
    "CounterListener",
    "InferredBatches",
    "KeptTable",
    "OffsetAccounts",
    "OutputLog",
    "SplitBatches",
    "VariantBatches",
    "compact_published",
    "compact_versions",
    "dead_letter_batch",
    "every",
    "grouped_messages",
    "is_data_error",
    "parquet_stream",
    "profile_stream",
    "read_account",
    "read_batches",
    "read_kept",
    "read_versions",
    "run_batches",
    "run_to_end",
    "send",
    "upserted",
    "variant_field",
    "variant_fields",
    "variant_rows",
    "with_peek",
    "write_batch",
]
