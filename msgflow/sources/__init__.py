from .envelope import ENVELOPE, narrow_envelope, to_envelope, to_messages, wide_envelope
from .files import binary_files, bytes_per_batch, literal_messages, replay_batch, replay_stream
from .kafka import kafka_batch, kafka_options, kafka_stream, parse_properties, read_properties
from .sample import first_document

__all__ = [
    "ENVELOPE",
    "binary_files",
    "bytes_per_batch",
    "first_document",
    "kafka_batch",
    "kafka_options",
    "kafka_stream",
    "literal_messages",
    "narrow_envelope",
    "parse_properties",
    "read_properties",
    "replay_batch",
    "replay_stream",
    "to_envelope",
    "to_messages",
    "wide_envelope",
]
