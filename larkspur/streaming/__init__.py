"""Streaming ingest, lag, retries and the include-set state machine."""
