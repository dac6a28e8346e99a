"""Table scans, derived input shapes and sinks."""
