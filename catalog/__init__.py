"""Registered queries, the inputs they run on and their DuckDB counterparts."""
