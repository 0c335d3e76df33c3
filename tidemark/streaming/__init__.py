"""Sinks, replays and stateful operators for Structured Streaming."""
