"""Structured Streaming: runners, sinks, stateful operators."""
