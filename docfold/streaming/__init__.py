"""Structured Streaming form of the engine: state, pipeline and sink."""
