"""File feeds as Structured Streaming queries."""
