"""Structured Streaming sources, sinks, state and application."""
