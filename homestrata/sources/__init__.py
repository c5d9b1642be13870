"""Table, page and snapshot sources and sinks."""
