"""Batch/stream operators, one module per analytics family."""
