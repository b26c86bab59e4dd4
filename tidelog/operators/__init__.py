"""DataFrame operators: serde and schemas, keyed state, topic maintenance,
positions and incremental runs."""
