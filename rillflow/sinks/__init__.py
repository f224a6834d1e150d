from rillflow.sinks.writers import (
    DocumentSink,
    HashSink,
    JdbcInsert,
    KeyedUpsert,
    console,
    fan_out,
    kafka_records,
    latest_per_key,
    show,
    to_documents,
    write_kafka,
)

__all__ = [
    "DocumentSink",
    "HashSink",
    "JdbcInsert",
    "KeyedUpsert",
    "console",
    "fan_out",
    "kafka_records",
    "latest_per_key",
    "show",
    "to_documents",
    "write_kafka",
]
