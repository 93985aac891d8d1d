"""Structured Streaming: the stateful fold and idempotent sinks."""
