"""Structured Streaming: per-topic bronze / silver / quarantine / gold queries."""
