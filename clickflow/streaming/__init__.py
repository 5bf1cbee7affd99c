"""Structured Streaming forms: sources, keyed state, jobs and runners."""
