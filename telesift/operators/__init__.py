"""Operators over the spans, logs and metrics tables. All take and return DataFrames."""
