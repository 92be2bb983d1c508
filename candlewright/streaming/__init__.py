"""Live minute bars with Structured Streaming."""
