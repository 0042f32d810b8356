"""Structured Streaming: incremental refresh of the standings as matches land."""
