"""Structured Streaming helpers: event time, watermarks, progress listener, stateful tails."""
