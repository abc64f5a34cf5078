"""Structured Streaming: runner, versioned sinks and the streaming jobs."""
