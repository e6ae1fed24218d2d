"""JSON messages in, queryable Parquet out - as plain Spark jobs.

``sources``    envelopes from Kafka, from a replayed directory or from a table
``functions``  column functions: JSON field access, coercion, ISO timestamps, encodings
``operators``  DataFrame -> DataFrame: parse policies, schema inference, topic profile, requests
``streaming``  sinks, idempotent micro-batch writers, triggers, counters
``plans``      whole jobs (source x policy x sink) and the registered queries
"""

__version__ = "0.1.0"
