"""Jobs that chain sources, operators and sinks."""
