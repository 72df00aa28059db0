"""Reading OTLP JSON and stored documents; writing and reading the tables."""
