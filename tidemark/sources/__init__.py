"""Sources (explicit-schema readers) and sinks."""
