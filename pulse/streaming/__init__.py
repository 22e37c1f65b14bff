"""Structured Streaming forms of the jobs: file replay in, row logs out."""
