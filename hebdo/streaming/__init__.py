"""The weekly rollup as an incremental Structured Streaming job."""
