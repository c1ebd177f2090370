"""Structured Streaming forms of the formatter, scoreboard, call validation and state."""
