"""The projection as a Structured Streaming job."""
