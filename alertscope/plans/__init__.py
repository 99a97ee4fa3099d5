"""End-to-end jobs built from sources, operators and sinks."""
