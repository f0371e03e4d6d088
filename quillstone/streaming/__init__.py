"""Structured Streaming: file-changed events that start a reprocessing."""
