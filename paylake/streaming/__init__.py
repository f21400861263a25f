"""Change stream: CDC messages, validation, routing, quarantine, foreachBatch sinks."""
