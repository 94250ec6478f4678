"""Incremental warehouse tables as DataFrame and Structured Streaming jobs."""
