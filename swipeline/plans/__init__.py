"""Jobs that join sources, operators and sinks, and the query catalogue."""
