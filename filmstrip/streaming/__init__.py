"""Structured Streaming: windowed rates, sessions, quota state, and micro-batches for the batch operators."""
