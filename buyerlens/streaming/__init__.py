"""Event time and custom stateful operators for Structured Streaming."""
