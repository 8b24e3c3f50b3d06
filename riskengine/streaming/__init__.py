"""The batch scoring operators run incrementally with Structured Streaming."""
