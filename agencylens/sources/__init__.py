"""Source adapters to canonical columns, and sinks."""
