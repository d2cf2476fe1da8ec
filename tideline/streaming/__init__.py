"""Structured Streaming: snapshot tables, ledgers and the apply stream."""
